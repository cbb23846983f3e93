"""Declared schemas of the source, cleansed and warehouse tables.

Readers are given these instead of inferring types: inference costs a full pass
over every file and guesses anew at each hop.
"""

from __future__ import annotations

from pyspark.sql import types as T

UNKNOWN = "n/a"


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _DOUBLE = T.LongType(), T.DoubleType()
_TEXT, _DATE = T.StringType(), T.DateType()

# Source tables. The column names. Ids, dates and quantities may have any
# whole number, amounts and prices may be fractional.
CRM_CUSTOMER = _table(
    cst_id=_LONG,
    cst_key=_TEXT,
    cst_firstname=_TEXT,
    cst_lastname=_TEXT,
    cst_marital_status=_TEXT,
    cst_gndr=_TEXT,
    cst_create_date=_DATE,
)
CRM_PRODUCT = _table(
    prd_id=_LONG,
    prd_key=_TEXT,
    prd_nm=_TEXT,
    prd_cost=_DOUBLE,
    prd_line=_TEXT,
    prd_start_dt=_DATE,
    prd_end_dt=_DATE,
)
CRM_SALES = _table(
    sls_ord_num=_TEXT,
    sls_prd_key=_TEXT,
    sls_cust_id=_LONG,
    sls_order_dt=_LONG,
    sls_ship_dt=_LONG,
    sls_due_dt=_LONG,
    sls_sales=_DOUBLE,
    sls_quantity=_LONG,
    sls_price=_DOUBLE,
)
ERP_CUSTOMER = _table(
    cid=_TEXT,
    bdate=_TEXT,
    gen=_TEXT,
)
ERP_LOCATION = _table(
    cid=_TEXT,
    cntry=_TEXT,
)
ERP_CATEGORY = _table(
    id=_TEXT,
    cat=_TEXT,
    subcat=_TEXT,
    maintenance=_TEXT,
)

SOURCES = {
    "cust_info": CRM_CUSTOMER,
    "prd_info": CRM_PRODUCT,
    "sales_details": CRM_SALES,
    "customers": ERP_CUSTOMER,
    "customer_locations": ERP_LOCATION,
    "product_categories": ERP_CATEGORY,
}

# Cleansed tables. Those that keep their source schema reuse it.
CLEAN_PRODUCT = _table(
    prd_id=_LONG,
    cat_id=_TEXT,
    prd_key=_TEXT,
    prd_nm=_TEXT,
    prd_cost=_DOUBLE,
    prd_line=_TEXT,
    prd_start_dt=_DATE,
    prd_end_dt=_DATE,
)
CLEAN_SALES = _table(
    sls_ord_num=_TEXT,
    sls_prd_key=_TEXT,
    sls_cust_id=_LONG,
    sls_order_dt=_DATE,
    sls_ship_dt=_DATE,
    sls_due_dt=_DATE,
    sls_sales=_DOUBLE,
    sls_quantity=_LONG,
    sls_price=_DOUBLE,
)

CLEANSED = {
    "cust_info": CRM_CUSTOMER,
    "prd_info": CLEAN_PRODUCT,
    "sales_details": CLEAN_SALES,
    "customers": ERP_CUSTOMER,
    "customer_locations": ERP_LOCATION,
    "product_categories": ERP_CATEGORY,
}

# Warehouse tables.
DIM_CUSTOMER = _table(
    customer_key=_LONG,
    customer_id=_LONG,
    customer_number=_TEXT,
    first_name=_TEXT,
    last_name=_TEXT,
    country=_TEXT,
    marital_status=_TEXT,
    gender=_TEXT,
    birthdate=_TEXT,
    create_date=_DATE,
)
DIM_PRODUCT = _table(
    product_key=_LONG,
    product_id=_LONG,
    product_number=_TEXT,
    product_name=_TEXT,
    category_id=_TEXT,
    category=_TEXT,
    subcategory=_TEXT,
    maintenance=_TEXT,
    cost=_DOUBLE,
    product_line=_TEXT,
    start_date=_DATE,
)
FACT_SALES = _table(
    order_number=_TEXT,
    product_key=_LONG,
    customer_key=_LONG,
    order_date=_DATE,
    shipping_date=_DATE,
    due_date=_DATE,
    sales_amount=_DOUBLE,
    quantity=_LONG,
    price=_DOUBLE,
)

WAREHOUSE = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "fact_sales": FACT_SALES,
}
