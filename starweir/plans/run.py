"""The whole job in order: raw, cleansed, star schema, warehouse, validation."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweir.jobs import at_once
from starweir.operators.quality import (
    ERP_CONSTRAINTS,
    Constraints,
    compare_counts,
    constraint_report,
    reject_report,
    require_ready,
)
from starweir.plans.cleanse import ROW_BY_ROW, cleansers
from starweir.plans.star import build_dim_customer, build_dim_product, build_fact_sales
from starweir.plans.warehouse import Warehouse, load_warehouse
from starweir.schemas import CLEANSED, SOURCES, WAREHOUSE
from starweir.sources import (
    conform,
    ingest_summary,
    ingest_tables,
    land_csv_folder,
    misfits,
    read_table,
    write_table,
)
from starweir.staging import stage, temporary

CRM_TABLES = ("cust_info", "prd_info", "sales_details")
ERP_TABLES = ("customers", "customer_locations", "product_categories")


@dataclass
class Layers:
    """Folders of the layers below one root.

    ``format`` is Parquet unless the layers must be CSV, in which blanks around
    values and the difference between NULL and an empty text are lost at each hop.
    """

    spark: SparkSession
    root: str
    format: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def write(self, layer: str, table: str, df: DataFrame) -> int:
        return write_table(df, self.path(layer, table), self.format)

    def read(self, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        return read_table(self.spark, self.path(layer, table), schema, self.format)


def ingest(
    layers: Layers,
    crm_folder: str,
    erp_tables: Iterable[str],
    read_erp: Callable[[str], DataFrame],
) -> DataFrame:
    """Fill the raw layer from the CRM's CSV files and the ERP's tables."""
    root, spark = f"{layers.root}/raw", layers.spark
    landed, copied = at_once(
        [
            partial(land_csv_folder, spark, crm_folder, root, layers.format),
            partial(ingest_tables, spark, erp_tables, read_erp, root, layers.format),
        ]
    )
    return landed.unionByName(copied, allowMissingColumns=True)


@dataclass
class Cleansed:
    """Rows written by table, and by table and column the values that did not fit."""

    rows: dict[str, int]
    rejects: dict[str, dict[str, int]]


def cleanse(
    layers: Layers,
    as_of: Column | None = None,
    labelled_gender: bool = True,
    tables: Sequence[str] = (*CRM_TABLES, *ERP_TABLES),
) -> Cleansed:
    """Raw to cleansed. The tables do not depend on each other.

    A raw value that does not fit its declared type becomes NULL. It is counted while
    the typed table is written, and the raw rows that have one are kept, whole, in the
    layer ``rejected``: also those that no transform keeps, as their key is NULL now.
    Where the transform shuffles nothing, the typed table is not written by itself: the
    tasks that write the cleansed one count.
    """
    require_ready(layers.spark, {t: layers.path("raw", t) for t in tables})
    transforms = cleansers(as_of, labelled_gender)

    def job(table: str) -> tuple[int, dict[str, int]]:
        raw, seen = layers.read("raw", table), Observation()
        bad = misfits(raw, SOURCES[table])
        with temporary(layers.spark):
            if not bad:
                return layers.write("cleansed", table, transforms[table](raw)), {}
            counts = [F.count_if(is_bad).alias(column) for column, is_bad in bad.items()]
            typed = conform(raw.observe(seen, *counts), SOURCES[table])
            if table not in ROW_BY_ROW:
                typed = stage(typed, "typed")
            written = layers.write("cleansed", table, transforms[table](typed))
            rejects = {column: n for column, n in seen.get.items() if n}
            if rejects:
                rows = reduce(Column.__or__, (bad[column] for column in rejects))
                layers.write("rejected", table, raw.where(rows))
            return written, rejects

    done = dict(zip(tables, at_once([partial(job, t) for t in tables])))
    return Cleansed({t: n for t, (n, _) in done.items()}, {t: r for t, (_, r) in done.items()})


def model(layers: Layers) -> dict[str, int]:
    """Cleansed to star schema, returning the rows of each table. The fact reads
    the dimensions that were written."""

    def cleansed(table: str) -> DataFrame:
        return layers.read("cleansed", table, CLEANSED[table])

    def customers() -> DataFrame:
        return build_dim_customer(
            cleansed("cust_info"), cleansed("customers"), cleansed("customer_locations")
        )

    def products() -> DataFrame:
        return build_dim_product(cleansed("prd_info"), cleansed("product_categories"))

    def facts() -> DataFrame:
        dimensions = [star_table(layers, t) for t in ("dim_product", "dim_customer")]
        return build_fact_sales(cleansed("sales_details"), *dimensions)

    def job(table: str, build: Callable[[], DataFrame]) -> int:
        with temporary(layers.spark):
            return layers.write("star", table, build())

    dimensions = {"dim_customer": customers, "dim_product": products}
    rows = at_once([partial(job, table, build) for table, build in dimensions.items()])
    return dict(zip(dimensions, rows)) | {"fact_sales": job("fact_sales", facts)}


def star_table(layers: Layers, table: str) -> DataFrame:
    """A table of the star schema as it was written."""
    return layers.read("star", table, WAREHOUSE[table])


def load(layers: Layers, warehouse: Warehouse) -> DataFrame:
    """Star schema to warehouse."""
    return load_warehouse({t: star_table(layers, t) for t in WAREHOUSE}, warehouse)


def validate(layers: Layers, tables: Sequence[str] = ERP_TABLES) -> DataFrame:
    """What the written layers break of what is promised: layer, table_name, check_name,
    column_name, violations. The ERP sources' keys, NOT NULLs and lengths in the raw
    layer, the declared columns and the surrogate keys in the star schema."""
    keys = {"dim_customer": ("customer_key",), "dim_product": ("product_key",), "fact_sales": ()}

    def raw(name: str) -> DataFrame:
        return constraint_report(layers.read("raw", name), ERP_CONSTRAINTS[name])

    def star(name: str) -> DataFrame:
        written = layers.read("star", name, WAREHOUSE[name] if layers.format == "csv" else None)
        return constraint_report(written, Constraints(keys[name]), WAREHOUSE[name])

    checks = [("raw", t, raw) for t in tables] + [("star", t, star) for t in WAREHOUSE]
    reports = at_once([partial(check, t) for _, t, check in checks])
    named = [
        report.select(F.lit(layer).alias("layer"), F.lit(t).alias("table_name"), "*")
        for (layer, t, _), report in zip(checks, reports)
    ]
    return reduce(DataFrame.unionByName, named)


@dataclass
class RunResult:
    """What each step of a run says about itself, as small tables."""

    ingested: DataFrame
    rejects: DataFrame
    checks: DataFrame
    counts: DataFrame


def run_checked(
    layers: Layers,
    crm_folder: str,
    erp_tables: Iterable[str],
    read_erp: Callable[[str], DataFrame],
    warehouse: Warehouse,
    as_of: Column | None = None,
    labelled_gender: bool = True,
) -> RunResult:
    """Everything, in order, then the checks. Any failed step raises; violations and
    rejects are reported."""
    arrived = ingest(layers, crm_folder, erp_tables, read_erp)
    cleansed = cleanse(layers, as_of, labelled_gender)
    written = model(layers)
    loaded = load(layers, warehouse).select("table_name", "row_count")
    return RunResult(
        ingest_summary(arrived),
        reject_report(cleansed.rejects, layers.spark),
        validate(layers),
        compare_counts(loaded, written),
    )


def run(
    layers: Layers,
    crm_folder: str,
    erp_tables: Iterable[str],
    read_erp: Callable[[str], DataFrame],
    warehouse: Warehouse,
    as_of: Column | None = None,
    labelled_gender: bool = True,
) -> DataFrame:
    """Everything, in order. Any failed step raises; the result compares the rows
    in the warehouse with the rows of the star schema."""
    return run_checked(
        layers, crm_folder, erp_tables, read_erp, warehouse, as_of, labelled_gender
    ).counts
