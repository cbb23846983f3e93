"""One query per operator, over the whole test tables.

Results are put in types that every engine prints alike: whole numbers as
BIGINT, dates as text, quotients rounded.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweir.catalog.derived import SOURCE_TABLES, table
from starweir.functions import (
    null_future,
    parse_int_date,
    prefer,
    recode,
    recode_shadowed,
    remove_chars,
    split_key,
    strip_prefix,
)
from starweir.jobs import at_once
from starweir.operators import (
    current_version,
    dense_key,
    latest_per_key,
    lookup,
    repair_amounts,
    validity_ranges,
)
from starweir.operators.quality import (
    Constraints,
    compare_contents,
    compare_counts,
    constraint_report,
    date_rejects,
    readiness,
    reject_report,
    row_counts,
)
from starweir.plans.cleanse import cleansers
from starweir.plans.run import CRM_TABLES, ERP_TABLES, Layers, RunResult, cleanse, run_checked
from starweir.plans.star import build_dim_customer, build_dim_product, build_fact_sales, build_star
from starweir.plans.warehouse import FolderWarehouse, load_warehouse
from starweir.sources import (
    Dialect,
    import_delimited,
    ingest_summary,
    ingest_tables,
    land_csv_folder,
    read_csv,
    read_table,
    write_table,
)
from starweir.staging import scratch_path, stage

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
# Today, for the rules that compare with today.
AS_OF = datetime.date(2000, 1, 1)
CLEANSE_AS_OF = datetime.date(2025, 1, 1)
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# Compressed files are not divided when they are read, so they are kept small.
PACKED = {"compression": "gzip", "maxRecordsPerFile": "1000000"}

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _queries[function.__name__.removesuffix("_query")] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_queries)


def _plain(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = column.cast("date").cast("string")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _twentieth(df: DataFrame) -> int:
    """A limit on rows per key low enough for the biggest keys to exceed it."""
    return max(1, df.count() // 20)


def _cleansed(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Cleansed tables, written first, as the star schema expects them."""
    transforms = cleansers(F.lit(CLEANSE_AS_OF))

    def job(name: str) -> DataFrame:
        return stage(transforms[name](SOURCE_TABLES[name](spark, sf_dir)), name)

    return at_once([partial(job, name) for name in names])


# Counts and checks.


@_query
def validate_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = at_once([partial(table, spark, sf_dir, name) for name in TABLES])
    return row_counts(dict(zip(TABLES, tables)))


@_query
def compare_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = row_counts({name: table(spark, sf_dir, name) for name in ("nation", "orders")})
    customers = table(spark, sf_dir, "customer").count()
    return compare_counts(counts, {"nation": 25, "orders": customers, "customer": customers})


@_query
def compare_contents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with a copy: in another order, with one value changed, with a row twice for
    another, without one row."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers, parts = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    mktsegment = F.when(F.col("c_custkey") == 7, "OTHER").otherwise(F.col("c_mktsegment"))
    first, second = parts.where("p_partkey = 1"), parts.where("p_partkey <> 2")
    return compare_contents(
        {
            "orders": (orders, orders.repartition("o_custkey")),
            "customer": (customers, customers.withColumn("c_mktsegment", mktsegment)),
            "part": (parts, second.unionByName(first)),
            "lineitem": (lines, lines.where("NOT (l_orderkey = 1 AND l_linenumber = 1)")),
        }
    )


@_query
def constraint_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "l_suppkey", F.nullif("l_suppkey", F.lit(3))
    )
    promised = Constraints(
        ("l_orderkey", "l_linenumber"), ("l_suppkey",), {"l_returnflag": 1, "l_linestatus": 0}
    )
    declared = T.StructType.fromDDL("l_orderkey BIGINT, l_quantity INT, l_absent STRING")
    return constraint_report(lines, promised, declared)


@_query
def readiness_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = {name: f"{sf_dir}/{name}.parquet" for name in [*TABLES, "absent"]}
    return readiness(spark, paths, spark.read.parquet).select("name", "present", "rows")


# Versions, keys, lookups.


@_query
def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return _plain(
        latest_per_key(orders, ["o_custkey"], "o_orderdate", [F.desc("o_orderkey")])
    )


@_query
def scd2_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_orderdate")
    return _plain(
        validity_ranges(orders, ["o_custkey"], "o_orderdate", "end_date", ["o_orderkey"])
    )


@_query
def scd2_validity_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("o_orderstatus", "o_orderkey", "o_orderdate")
    return _plain(
        validity_ranges(
            orders, ["o_orderstatus"], "o_orderdate", "end_date", ["o_orderkey"], partitions=20
        )
    )


@_query
def current_version_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_version(scd2_validity(spark, sf_dir), "end_date")


@_query
def dense_key_scalable(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("o_orderdate", "o_orderkey", "o_totalprice")
    orders = orders.withColumn(
        "o_orderdate", F.when(F.col("o_totalprice") >= 20000, F.col("o_orderdate"))
    )
    return _plain(dense_key(orders, [F.desc("o_orderdate"), "o_orderkey"], "order_number"))


@_query
def left_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("c_nationkey"),
    )
    regions = table(spark, sf_dir, "region").withColumn(
        "r_regionkey",
        F.when(F.col("r_name") == "ASIA", 99).otherwise(F.col("r_regionkey")),
    )
    nations = table(spark, sf_dir, "nation")
    joined = lookup(
        customers,
        nations,
        ("c_nationkey", "n_nationkey"),
        {"n_name": "nation", "n_regionkey": "n_regionkey"},
    )
    joined = lookup(joined, regions, ("n_regionkey", "r_regionkey"), {"r_name": "region"})
    return _plain(joined.select("c_custkey", "nation", "region"))


@_query
def lookup_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return _plain(
        lookup(
            orders,
            lines,
            ("o_orderkey", "l_orderkey"),
            {"l_partkey": "l_partkey", "l_linenumber": "l_linenumber"},
            max_broadcast_bytes=0,
        )
    )


@_query
def lookup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    one_key = orders.withColumn(
        "o_custkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(7))
        .when(F.col("o_orderstatus") == "O", F.lit(None))
        .otherwise(F.col("o_custkey")),
    )
    return _plain(
        lookup(
            one_key,
            table(spark, sf_dir, "customer"),
            ("o_custkey", "c_custkey"),
            {"c_name": "c_name"},
            max_broadcast_bytes=0,
            max_key_rows=_twentieth(orders),
        )
    )


# Column rules.


@_query
def recode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit(" "), F.lower("o_orderstatus")).alias("code")
    )
    return orders.select(
        "o_orderkey", recode(F.col("code"), {"Filled": ["F"], "Open": ["O"]}).alias("status")
    )


@_query
def recode_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.concat(F.col("c_mktsegment"), F.lit("  "))
    labels = {"Home": ["HOUSEHOLD", "FURNITURE"], "Works": ["MACHINERY", "building"]}
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        recode(segment, labels, default=F.trim(segment), fold_case=False).alias("segment"),
    )


@_query
def recode_shadowed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("P"))
    code = F.concat(F.lit(" "), F.lower(status))
    return table(spark, sf_dir, "orders").select("o_orderkey", recode_shadowed(code).alias("status"))


@_query
def key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    head, tail = split_key(F.col("c_name"), 9, separator="#")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", head.alias("name_part"), tail.alias("number_part")
    )


@_query
def regex_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        remove_chars(priority, "-").alias("without_dash"),
        strip_prefix(priority, "1-").alias("without_prefix"),
    )


def _int_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    spoiled = (
        F.when(F.col("o_orderpriority") == "1-URGENT", 0)
        .when(F.col("o_orderpriority") == "2-HIGH", 5489)
        .when((F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "F"), 20101345)
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(day)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", spoiled.alias("day"))


@_query
def int_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _int_dates(spark, sf_dir)
    return _plain(orders.select("o_orderkey", parse_int_date(F.col("day")).alias("day")))


@_query
def rejected_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_rejects(_int_dates(spark, sf_dir), ["day"])


@_query
def sales_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = SOURCE_TABLES["sales_details"](spark, sf_dir).select(
        "sls_ord_num", "sls_prd_key", "sls_sales", "sls_quantity", "sls_price"
    )
    repaired = repair_amounts(sales, "sls_sales", "sls_quantity", "sls_price")
    return _plain(repaired.withColumn("sls_price", F.round("sls_price", 4)))


@_query
def future_date_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("string")
    orders = _orders(spark, sf_dir)
    return orders.select("o_orderkey", null_future(day, F.lit(AS_OF)).alias("order_day"))


@_query
def null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.nullif("p_size", F.lit(1)), F.lit(0))
    return _plain(table(spark, sf_dir, "part").select("p_partkey", size.alias("size")))


@_query
def coalesce_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        recode(F.col("c_mktsegment"), {"Auto": ["AUTOMOBILE"], "Build": ["BUILDING"]}).alias("kind"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("c_nationkey"),
    )
    named = lookup(
        customers,
        table(spark, sf_dir, "nation"),
        ("c_nationkey", "n_nationkey"),
        {"n_name": "nation"},
    )
    return named.select("c_custkey", prefer(F.col("kind"), F.col("nation")).alias("kind"))


@_query
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_custkey")
    return _plain(orders.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(3))


@_query
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.createDataFrame([("F", "Filled"), ("O", "Open")], "code string, label string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return lookup(orders, labels, ("o_orderstatus", "code"), {"label": "label"})


# Whole transforms.


def _clean_query(name: str, source: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleansed = cleansers(F.lit(CLEANSE_AS_OF))[source](SOURCE_TABLES[source](spark, sf_dir))
        if "sls_price" in cleansed.columns:
            cleansed = cleansed.withColumn("sls_price", F.round("sls_price", 4))
        return _plain(cleansed)

    _queries[name] = query


_clean_query("clean_crm_customer", "cust_info")
_clean_query("clean_crm_product", "prd_info")
_clean_query("clean_crm_sales", "sales_details")
_clean_query("clean_erp_customer", "customers")
_clean_query("clean_erp_location", "customer_locations")
_clean_query("clean_erp_category", "product_categories")


@_query
def clean_erp_customer_as_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    transform = cleansers(F.lit(CLEANSE_AS_OF), labelled_gender=False)["customers"]
    return transform(SOURCE_TABLES["customers"](spark, sf_dir))


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_customer(
        *_cleansed(spark, sf_dir, "cust_info", "customers", "customer_locations")
    )


def _dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_product(*_cleansed(spark, sf_dir, "prd_info", "product_categories"))


@_query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_dim_customer(spark, sf_dir))


@_query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_dim_product(spark, sf_dir))


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema, the dimensions being built while the sales are cleansed."""
    products, customers, (sales,) = at_once(
        [
            partial(_dim_product, spark, sf_dir),
            partial(_dim_customer, spark, sf_dir),
            partial(_cleansed, spark, sf_dir, "sales_details"),
        ]
    )
    facts = build_fact_sales(sales, products, customers)
    return {"dim_customer": customers, "dim_product": products, "fact_sales": facts}


@_query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_star(spark, sf_dir)["fact_sales"].withColumn("price", F.round("price", 4)))


@_query
def star_schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleansed = dict(zip(SOURCE_TABLES, _cleansed(spark, sf_dir, *SOURCE_TABLES)))
    return row_counts(build_star(cleansed))


# Sources and sinks.


@_query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    path = scratch_path(spark, "csv")
    write_table(orders, path, "csv")
    again = read_table(spark, path, orders.schema, "csv")
    return _plain(again.withColumn("o_totalprice", F.round("o_totalprice", 2)))


@_query
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_table(_orders(spark, sf_dir), path, "csv")
    inferred = read_csv(spark, path, infer=True)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": "date"}
    typed = inferred.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    return _plain(typed.withColumn("o_totalprice", F.round("o_totalprice", 2)))


@_query
def csv_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_table(table(spark, sf_dir, "part"), path, "csv")
    price = F.col("p_retailprice").cast("decimal(18,4)").cast("string")
    return read_csv(spark, path).withColumn("p_retailprice", price)


@_query
def csv_declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_table(table(spark, sf_dir, "part"), path, "csv")
    names = ["id", "name", "brand", "type", "size", "price"]
    assigned = {
        "part_id": "CAST(id AS BIGINT)",
        "label": "brand || ' ' || type",
        "name": "name",
        "price": "round(CAST(price AS DOUBLE), 2)",
    }
    return import_delimited(spark, path, names, assigned)


#: Quotes in quoted values are doubled.
DOUBLED = Dialect(escape='"')


def _landed(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> tuple[DataFrame, str]:
    """The named tables as CSV, landed: the report, and the raw layer."""
    root = scratch_path(spark, "land")

    def export(name: str) -> None:
        source = table(spark, sf_dir, name)
        arrays = [f.name for f in source.schema if isinstance(f.dataType, T.ArrayType)]
        texts = source.withColumns({c: F.col(c).cast("string") for c in arrays})
        write_table(texts, f"{root}/source/{name}.csv", "csv", **KEEP_BLANKS, **PACKED, **DOUBLED.options())

    at_once([partial(export, name) for name in names])
    return land_csv_folder(spark, f"{root}/source", f"{root}/raw", dialect=DOUBLED), f"{root}/raw"


@_query
def csv_land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, TABLES)[0].drop("message")


@_query
def csv_land_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was landed of the tables whose texts have line breaks, quotes and commas."""
    keys = {
        "documents": "doc_id",
        "pages": "page_id",
        "benchmark": "item_id",
        "conversations": "concat(conv_id, ':', turn)",
    }
    _, raw = _landed(spark, sf_dir, list(keys))
    texts = {"pages": "html"}
    parts = [
        read_table(spark, f"{raw}/{name}").selectExpr(
            f"'{name}' AS table_name", f"{key} AS key", f"md5({texts.get(name, 'text')}) AS text_md5"
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "ingest")
    result = ingest_tables(spark, TABLES, lambda name: table(spark, sf_dir, name), root)
    return result.drop("message")


@_query
def ingest_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_summary(ingest_all(spark, sf_dir))


@_query
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text versions of the sources with ids and amounts that are no numbers, and with
    fractions and numbers beyond 2^31, which are."""
    spoilt = {
        "cust_info": {"cst_id": "CASE WHEN CAST(cst_id AS BIGINT) % 10 = 3 THEN 'A' || cst_id ELSE cst_id END"},
        "prd_info": {"prd_cost": "CASE WHEN CAST(prd_id AS BIGINT) % 7 = 0 THEN 'free' || prd_cost ELSE prd_cost END"},
        "sales_details": {
            "sls_cust_id": "CASE WHEN sls_quantity = '7' THEN '?' || sls_cust_id ELSE sls_cust_id END",
            "sls_price": "CASE WHEN sls_quantity = '4' THEN 'x' || sls_price "
            "WHEN sls_quantity = '5' THEN '10.5' ELSE sls_price END",
            "sls_sales": "CASE WHEN sls_quantity = '6' THEN '3000000000' ELSE sls_sales END",
        },
    }
    layers = Layers(spark, scratch_path(spark, "rejects"))

    def export(name: str) -> None:
        source = SOURCE_TABLES[name](spark, sf_dir)
        rules = spoilt.get(name, {})
        texts = source.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in source.columns])
        spoils = [f"{rules.get(c, c)} AS {c}" for c in source.columns]
        layers.write("raw", name, texts.selectExpr(*spoils))

    at_once([partial(export, name) for name in SOURCE_TABLES])
    return reject_report(cleanse(layers, F.lit(CLEANSE_AS_OF)).rejects, spark)


@_query
def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = FolderWarehouse(spark, scratch_path(spark, "warehouse"))
    load_warehouse(_star(spark, sf_dir), warehouse)
    facts = warehouse.read("fact_sales")
    return _plain(facts.withColumn("price", F.round("price", 4)))


def _whole_run(spark: SparkSession, sf_dir: str) -> tuple[RunResult, FolderWarehouse]:
    root = scratch_path(spark, "run")

    def export(name: str) -> None:
        source = SOURCE_TABLES[name](spark, sf_dir)
        write_table(source, f"{root}/crm/{name}.csv", "csv", **KEEP_BLANKS, **PACKED)

    at_once([partial(export, name) for name in CRM_TABLES])
    warehouse = FolderWarehouse(spark, f"{root}/warehouse")
    result = run_checked(
        Layers(spark, root),
        f"{root}/crm",
        ERP_TABLES,
        lambda name: SOURCE_TABLES[name](spark, sf_dir),
        warehouse,
        F.lit(CLEANSE_AS_OF),
    )
    return result, warehouse


@_query
def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_run(spark, sf_dir)[0].counts


@_query
def run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole_run(spark, sf_dir)[0].checks


@_query
def whole_run_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded fact with what the loaded dimensions say about it."""
    warehouse = _whole_run(spark, sf_dir)[1]
    facts = warehouse.read("fact_sales").withColumn("price", F.round("price", 4))
    products = {c: c for c in ("product_number", "product_name", "category", "cost")}
    customers = {c: c for c in ("customer_number", "country", "gender", "birthdate")}
    for name, key, columns in (
        ("dim_product", "product_key", products),
        ("dim_customer", "customer_key", customers),
    ):
        dimension = warehouse.read(name).withColumn(key, F.col(key).cast("int"))
        facts = lookup(facts, dimension, (key, key), columns)
    return _plain(facts.drop("product_key", "customer_key", "shipping_date", "due_date"))
