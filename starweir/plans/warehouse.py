"""Loading the star schema into a warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweir.jobs import at_once
from starweir.operators.quality import ContentObservation, Contents, contents
from starweir.sources import read_table, write_table

# Column types the warehouse wants, where they differ from ours.
CASTS = {"fact_sales": {"product_key": "int", "customer_key": "int"}}
DIMENSIONS = ("dim_customer", "dim_product")
FACTS = ("fact_sales",)

RESULT = "table_name string, row_count bigint, status string, message string"


class Warehouse(Protocol):
    """Where tables are loaded; :class:`~starweir.sources.JdbcDatabase` is one."""

    def replace(self, df: DataFrame, table: str) -> int:
        """Replace a table and return the number of rows sent."""

    def count(self, table: str) -> int:
        """The number of rows the table holds."""


@dataclass
class FolderWarehouse:
    """A warehouse kept as files, one folder per table."""

    spark: SparkSession
    root: str
    format: str = "parquet"

    def replace(self, df: DataFrame, table: str) -> int:
        return write_table(df, f"{self.root}/{table}", self.format)

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/{table}", format=self.format)

    def count(self, table: str) -> int:
        return self.read(table).count()

    def contents(self, table: str) -> Contents:
        return contents(self.read(table))


class LoadError(RuntimeError):
    """A table could not be loaded. ``result`` tells how far the load came."""

    def __init__(self, result: DataFrame, table: str):
        super().__init__(f"not loaded: {table}")
        self.result = result


def load_table(
    df: DataFrame,
    warehouse: Warehouse,
    table: str,
    casts: Mapping[str, str] | None = None,
    attempts: int = 2,
) -> int:
    """Replace ``table`` and return its number of rows.

    A task that is run again after it has sent rows sends them twice, so the
    warehouse's own count must agree; if not, the table is replaced once more. Where the
    warehouse can tell its ``contents``, all values must agree with those sent, which are
    summed up while they are sent.
    """
    casts = CASTS.get(table, {}) if casts is None else casts
    typed = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()}) if casts else df
    told = getattr(warehouse, "contents", None)
    for _ in range(attempts):
        watched = ContentObservation()
        sent = warehouse.replace(watched.watch(typed) if told else typed, table)
        if told:
            found = told(table)
            held = found.rows
            if found == watched.get():
                return held
            if sent == held:
                raise ValueError(f"{table} does not hold the values that were sent")
        else:
            held = warehouse.count(table)
            if sent == held:
                return held
    raise ValueError(f"{table} holds {held} rows after {sent} were sent")


def load_warehouse(tables: Mapping[str, DataFrame], warehouse: Warehouse) -> DataFrame:
    """Load the dimensions, then the facts if all dimensions arrived.

    One row per table with status ``loaded``; a failure raises :class:`LoadError`,
    in whose result the facts are ``skipped`` if a dimension failed.
    """

    def load(table: str) -> tuple[str, int | None, str, str | None]:
        try:
            return table, load_table(tables[table], warehouse, table), "loaded", None
        except Exception as error:  # noqa: BLE001 - reported in the result
            return table, None, "failed", str(error)

    outcomes: list[tuple[str, int | None, str, str | None]] = []
    failed = None
    for group in (DIMENSIONS, FACTS):
        if failed:
            outcomes += [(table, None, "skipped", None) for table in group]
            continue
        done = at_once([partial(load, table) for table in group])
        outcomes += done
        failed = next((table for table, _, status, _ in done if status == "failed"), None)
    spark = next(iter(tables.values())).sparkSession
    result = spark.createDataFrame(outcomes, RESULT)
    if failed:
        raise LoadError(result, failed)
    return result
