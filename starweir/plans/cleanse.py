"""From source tables to cleansed tables, one function per table.

A cleansed table must not be cleansed again: labels are no longer codes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweir.functions import (
    fold_codes,
    null_future,
    parse_int_date,
    recode,
    recode_shadowed,
    remove_chars,
    split_key,
    strip_prefix,
)
from starweir.operators import latest_per_key, repair_amounts, validity_ranges
from starweir.schemas import CLEAN_PRODUCT, CLEAN_SALES, CRM_CUSTOMER, ERP_CATEGORY, UNKNOWN

# The code lists of the source systems, label to codes.
MARITAL_STATUS = {"Single": ["S"], "Married": ["M"]}
GENDER = {"Female": ["F"], "Male": ["M"]}
ERP_GENDER = {"Female": ["F", "FEMALE"], "Male": ["M", "MALE"]}
PRODUCT_LINE = {"Mountain": ["M"], "Road": ["R"], "Other Sales": ["S"], "Touring": ["T"]}
COUNTRY = {"Germany": ["DE"], "United States": ["US", "USA"]}
CATEGORY_WIDTH = 5
ERP_ID_PREFIX = "NAS"

#: Tables whose transform looks at each row by itself, without a shuffle.
ROW_BY_ROW = {"sales_details", "customers", "customer_locations", "product_categories"}


def cleanse_crm_customer(df: DataFrame) -> DataFrame:
    """The latest record of each customer, names trimmed, codes as labels."""
    latest = latest_per_key(df.where("cst_id IS NOT NULL"), ["cst_id"], "cst_create_date")
    return latest.withColumns(
        {
            "cst_firstname": F.trim("cst_firstname"),
            "cst_lastname": F.trim("cst_lastname"),
            "cst_marital_status": recode(F.col("cst_marital_status"), MARITAL_STATUS),
            "cst_gndr": recode(F.col("cst_gndr"), GENDER),
        }
    ).select(*CRM_CUSTOMER.names)


def cleanse_crm_product(df: DataFrame) -> DataFrame:
    """Category and product key apart, cost and line filled, validity recomputed.

    The source's end date is not used: each version ends the day before the next
    version of the same product key starts.
    """
    category, product = split_key(F.col("prd_key"), CATEGORY_WIDTH)
    prepared = df.select(
        "prd_id",
        category.alias("cat_id"),
        product.alias("prd_key"),
        "prd_nm",
        F.coalesce("prd_cost", F.lit(0.0)).alias("prd_cost"),
        recode(F.col("prd_line"), PRODUCT_LINE).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
    )
    return validity_ranges(prepared, ["prd_key"], "prd_start_dt", "prd_end_dt").select(
        *CLEAN_PRODUCT.names
    )


def cleanse_crm_sales(df: DataFrame) -> DataFrame:
    """Integer dates as dates, amounts repaired."""
    dates = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]
    repaired = repair_amounts(df, "sls_sales", "sls_quantity", "sls_price")
    return repaired.withColumns({c: parse_int_date(F.col(c)) for c in dates}).select(
        *CLEAN_SALES.names
    )


def cleanse_erp_customer(
    df: DataFrame, as_of: Column | None = None, labelled_gender: bool = True
) -> DataFrame:
    """Ids without prefix, birth dates not after ``as_of`` (today by default).

    Gender codes become Female, Male or n/a. Without ``labelled_gender`` they are
    only trimmed and put in upper case, n/a standing for NULL.
    """
    gender = F.col("gen")
    return df.select(
        strip_prefix(F.col("cid"), ERP_ID_PREFIX).alias("cid"),
        null_future(F.col("bdate"), as_of).alias("bdate"),
        (recode(gender, ERP_GENDER) if labelled_gender else recode_shadowed(gender)).alias("gen"),
    )


def cleanse_erp_location(df: DataFrame) -> DataFrame:
    """Ids without dashes; country codes as names, other names trimmed."""
    name = fold_codes(F.col("cntry"), fold_case=False)
    unlisted = F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN))
    return df.select(
        remove_chars(F.col("cid"), "-").alias("cid"),
        recode(F.col("cntry"), COUNTRY, default=unlisted, fold_case=False).alias("cntry"),
    )


def cleanse_erp_category(df: DataFrame) -> DataFrame:
    """The declared columns as they are."""
    return df.select(*ERP_CATEGORY.names)


def cleansers(
    as_of: Column | None = None, labelled_gender: bool = True
) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The transform of each source table, by table name."""
    return {
        "cust_info": cleanse_crm_customer,
        "prd_info": cleanse_crm_product,
        "sales_details": cleanse_crm_sales,
        "customers": partial(
            cleanse_erp_customer, as_of=as_of, labelled_gender=labelled_gender
        ),
        "customer_locations": cleanse_erp_location,
        "product_categories": cleanse_erp_category,
    }
