"""From cleansed tables to the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.functions import prefer
from starweir.jobs import at_once
from starweir.operators import current_version, dense_key, lookup
from starweir.operators.lookups import MAX_BROADCAST_BYTES, fits_in_memory
from starweir.schemas import DIM_CUSTOMER, DIM_PRODUCT, FACT_SALES


def build_dim_customer(crm: DataFrame, erp: DataFrame, locations: DataFrame) -> DataFrame:
    """CRM customers with their ERP data, keyed in the order of their ids.

    The location hangs on the ERP customer: a customer without ERP data has no
    country. Repeated ERP ids repeat the customer, each under its own key.
    """
    # Joining the two ERP tables first gives the same rows as hanging the location
    # on the joined customer, and lets the second join reuse their partitioning.
    known = erp.where("cid IS NOT NULL")
    limit = MAX_BROADCAST_BYTES if fits_in_memory(known) else 0
    located = lookup(known, locations, ("cid", "cid"), {"cntry": "country"})
    joined = lookup(
        crm,
        located,
        ("cst_key", "cid"),
        {"bdate": "birthdate", "gen": "erp_gender", "country": "country"},
        max_broadcast_bytes=limit,
        right_sample_from=known,
    )
    customers = joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        "country",
        F.col("cst_marital_status").alias("marital_status"),
        prefer(F.col("cst_gndr"), F.col("erp_gender")).alias("gender"),
        "birthdate",
        F.col("cst_create_date").alias("create_date"),
    )
    return dense_key(customers, ["customer_id"], "customer_key").select(*DIM_CUSTOMER.names)


def build_dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Current products with their category, keyed by start date and product."""
    with_category = lookup(
        current_version(products, "prd_end_dt"),
        categories,
        ("cat_id", "id"),
        {"cat": "category", "subcat": "subcategory", "maintenance": "maintenance"},
    )
    current = with_category.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        "category",
        "subcategory",
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_date"),
    )
    return dense_key(current, ["start_date", "product_number"], "product_key").select(
        *DIM_PRODUCT.names
    )


def build_fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with the keys of product and customer, NULL where there is none.

    The dimensions must be written tables, so that the keys are the same here
    and there.
    """
    keyed = lookup(
        sales, products, ("sls_prd_key", "product_number"), {"product_key": "product_key"}
    )
    keyed = lookup(
        keyed,
        customers,
        ("sls_cust_id", "customer_id"),
        {"customer_key": "customer_key"},
        sample_from=sales,
    )
    return keyed.select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    ).select(*FACT_SALES.names)


def build_star(cleansed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Both dimensions and the fact, from the cleansed tables by name."""
    customers, products = at_once(
        [
            lambda: build_dim_customer(
                cleansed["cust_info"], cleansed["customers"], cleansed["customer_locations"]
            ),
            lambda: build_dim_product(cleansed["prd_info"], cleansed["product_categories"]),
        ]
    )
    facts = build_fact_sales(cleansed["sales_details"], products, customers)
    return {"dim_customer": customers, "dim_product": products, "fact_sales": facts}
