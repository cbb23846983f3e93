"""CRM and ERP source tables derived, whole, from the test tables.

The derivations put in what the cleansing rules are about: NULLs, blanks, code
variants, invalid dates, wrong amounts, several records per key, lookup misses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starweir.schemas import (
    CRM_CUSTOMER,
    CRM_PRODUCT,
    CRM_SALES,
    ERP_CATEGORY,
    ERP_CUSTOMER,
    ERP_LOCATION,
)
from starweir.sources import conform


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is looked up in the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _int_date(date: str) -> str:
    return f"year({date}) * 10000 + month({date}) * 100 + day({date})"


def crm_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a record of its customer at that date."""
    return conform(
        table(spark, sf_dir, "orders").selectExpr(
            "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_orderstatus <> 'P' "
            "THEN o_custkey END AS cst_id",
            "'AW' || lpad(o_custkey, 12, '0') AS cst_key",
            "'  ' || o_orderpriority || ' ' AS cst_firstname",
            "' Order ' || o_orderkey AS cst_lastname",
            "CASE o_orderstatus WHEN 'F' THEN ' s' WHEN 'O' THEN 'M ' END AS cst_marital_status",
            "CASE left(o_orderpriority, 1) WHEN '1' THEN 'f ' WHEN '2' THEN ' M' "
            "WHEN '3' THEN 'x' WHEN '4' THEN '' END AS cst_gndr",
            "CASE WHEN o_totalprice >= 20000 THEN o_orderdate END AS cst_create_date",
        ),
        CRM_CUSTOMER,
    )


def crm_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as product versions, three to a product key."""
    return conform(
        table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS prd_id",
            "left(p_type, 2) || '-' || upper(left(p_name, 2)) || '-P' || "
            "lpad(p_partkey DIV 3, 12, '0') AS prd_key",
            "p_name AS prd_nm",
            "CASE WHEN p_size <> 7 THEN floor(p_retailprice) END AS prd_cost",
            "CASE p_type WHEN 'ECONOMY' THEN 'R ' WHEN 'LARGE' THEN 'M ' WHEN 'MEDIUM' THEN 's' "
            "WHEN 'PROMO' THEN ' t' WHEN 'STANDARD' THEN 'x' END AS prd_line",
            "date_add(DATE'2003-07-01', p_size) AS prd_start_dt",
            "DATE'2000-01-01' AS prd_end_dt",
        ),
        CRM_PRODUCT,
    )


def crm_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the customer and date of their order."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS l_orderkey", "o_custkey", "CAST(o_orderdate AS DATE) AS o_orderdate"
    )
    # What is shuffled are days and whole units rather than instants and cents.
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "CAST(l_shipdate AS DATE) AS l_shipdate",
        "CAST(l_quantity AS BIGINT) AS q",
        "floor(l_extendedprice / 100) + IF(l_linenumber = 4, 0.5D, 0D) AS unit",
    )
    lines = lines.join(orders, "l_orderkey", "left")
    return conform(
        lines.selectExpr(
            "'SO' || l_orderkey AS sls_ord_num",
            "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'UNKNOWN' "
            "ELSE 'P' || lpad(l_partkey DIV 3, 12, '0') END AS sls_prd_key",
            "CASE WHEN l_returnflag <> 'R' OR l_linenumber <> 6 THEN o_custkey END AS sls_cust_id",
            "CASE q WHEN 1 THEN 0 WHEN 2 THEN 5489 WHEN 3 THEN 20101345 WHEN 4 THEN NULL "
            f"ELSE {_int_date('o_orderdate')} END AS sls_order_dt",
            f"{_int_date('l_shipdate')} AS sls_ship_dt",
            f"{_int_date('date_add(l_shipdate, 7)')} AS sls_due_dt",
            "CASE l_returnflag || l_linestatus WHEN 'AF' THEN NULL WHEN 'RF' THEN -q * unit "
            "WHEN 'NO' THEN 999 ELSE q * unit END AS sls_sales",
            "CASE WHEN l_linenumber = 5 AND l_linestatus = 'O' THEN 0 ELSE q END AS sls_quantity",
            "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 0 "
            "WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN -unit ELSE unit END AS sls_price",
        ),
        CRM_SALES,
    )


def erp_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; ids of those in debt match no CRM customer."""
    return conform(
        table(spark, sf_dir, "customer").selectExpr(
            "CASE WHEN c_acctbal < 0 THEN 'ZZ' WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') "
            "THEN 'NASAW' ELSE 'AW' END || lpad(c_custkey, 12, '0') AS cid",
            "CASE WHEN c_acctbal > 9000 THEN '9999-11-20' WHEN c_acctbal > 8000 THEN NULL "
            "WHEN c_acctbal > 7000 THEN 'unknown' "
            "ELSE CAST(date_add(DATE'1950-01-01', c_nationkey * 300) AS STRING) END AS bdate",
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'F' WHEN 'BUILDING' THEN 'Female' "
            "WHEN 'FURNITURE' THEN ' m ' WHEN 'HOUSEHOLD' THEN '' END AS gen",
        ),
        ERP_CUSTOMER,
    )


def erp_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' countries, under ids with dashes."""
    return conform(
        table(spark, sf_dir, "customer").selectExpr(
            "'A-W-' || lpad(c_custkey, 12, '0') AS cid",
            "CASE c_nationkey WHEN 0 THEN ' DE ' WHEN 1 THEN 'USA' WHEN 2 THEN 'US' WHEN 3 THEN '' "
            "WHEN 4 THEN '  ' WHEN 5 THEN 'us' WHEN 6 THEN NULL "
            "ELSE ' Nation ' || c_nationkey || ' ' END AS cntry",
        ),
        ERP_LOCATION,
    )


def erp_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of parts; those of promotion parts match no product."""
    return conform(
        table(spark, sf_dir, "part")
        .selectExpr(
            "replace(left(p_type, 2), 'PR', 'PX') || '_' || upper(left(p_name, 2)) AS id",
            "p_type",
            "split_part(p_name, ' ', 1) AS word",
            "p_size",
        )
        .groupBy("id")
        .agg({"p_type": "min", "word": "min", "p_size": "max"})
        .selectExpr(
            "id",
            "`min(p_type)` AS cat",
            "`min(word)` AS subcat",
            "CASE WHEN `max(p_size)` > 25 THEN 'Yes' ELSE 'No' END AS maintenance",
        ),
        ERP_CATEGORY,
    )


SOURCE_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cust_info": crm_customer,
    "prd_info": crm_product,
    "sales_details": crm_sales,
    "customers": erp_customer,
    "customer_locations": erp_location,
    "product_categories": erp_category,
}
