"""Checks of tables and layers. Each returns a small table of findings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial, reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweir.functions import parse_int_date
from starweir.jobs import at_once


@dataclass(frozen=True)
class Constraints:
    """What a table promises: a primary key, columns without NULL, longest texts."""

    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)


# The constraints of the ERP source tables.
ERP_CONSTRAINTS = {
    "product_categories": Constraints(
        ("id",), ("cat", "subcat"), {"id": 10, "cat": 50, "subcat": 50, "maintenance": 5}
    ),
    "customer_locations": Constraints(("cid",), ("cntry",), {"cid": 20, "cntry": 50}),
    "customers": Constraints(("cid",), (), {"cid": 20, "bdate": 50, "gen": 10}),
}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, row_count. All tables are counted in one
    aggregation, of which only partial counts are shuffled."""
    marks = [df.select(F.lit(name).alias("table_name"), F.lit(1).alias("n")) for name, df in tables.items()]
    spark = next(iter(tables.values())).sparkSession
    # Makes tables without rows appear.
    none = pa.table({"table_name": list(tables), "n": pa.array([0] * len(tables), pa.int32())})
    marks.append(spark.createDataFrame(none))
    rows = reduce(DataFrame.unionByName, marks)
    return rows.groupBy("table_name").agg(F.sum("n").alias("row_count"))


def compare_counts(counts: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Row counts next to those expected; ``matches`` is false for a missing table."""
    wanted = counts.sparkSession.createDataFrame(
        list(expected.items()), "table_name string, expected bigint"
    )
    return wanted.join(counts, "table_name", "left").select(
        "table_name",
        "row_count",
        "expected",
        F.col("row_count").eqNullSafe(F.col("expected")).alias("matches"),
    )


@dataclass(frozen=True)
class Contents:
    """What a table holds, whatever the order of its rows: how many, and two sums over
    hashes of all rows."""

    rows: int
    sums: tuple[int, int]


def _content_columns(df: DataFrame) -> list[Column]:
    """The aggregates of :class:`Contents`. Values count as the text they are printed as,
    so that a column may come back as a wider type; NULL and empty text differ."""
    texts = [F.col(f"`{f.name}`").cast("string") for f in df.schema]
    hidden = [c.isNull() for c in texts]

    def total(salt: int) -> Column:
        return F.sum(F.xxhash64(F.lit(salt), *texts, *hidden).cast("decimal(38,0)"))

    none = F.lit(0).cast("decimal(38,0)")
    sums = [F.coalesce(total(salt), none).alias(f"sum{salt}") for salt in (0, 1)]
    return [F.count(F.lit(1)).alias("rows"), *sums]


class ContentObservation:
    """Learns the :class:`Contents` of a table while something else reads it."""

    def __init__(self) -> None:
        self._seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *_content_columns(df))

    def get(self) -> Contents:
        seen = self._seen.get
        return Contents(seen["rows"], (int(seen["sum0"]), int(seen["sum1"])))


def contents(df: DataFrame) -> Contents:
    """One pass, whose partial sums are all that is shuffled."""
    rows, one, two = df.agg(*_content_columns(df)).first()
    return Contents(rows, (int(one), int(two)))


def compare_contents(tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """For each pair of tables: table_name, rows, other_rows, and ``same``, whether the
    rows of both are the same, each as often, in any order."""
    pairs = at_once([partial(contents, df) for both in tables.values() for df in both])
    found = [
        (name, one.rows, two.rows, one == two)
        for name, one, two in zip(tables, pairs[::2], pairs[1::2])
    ]
    spark = next(iter(tables.values()))[0].sparkSession
    return spark.createDataFrame(
        found, "table_name string, rows bigint, other_rows bigint, same boolean"
    )


def duplicate_keys(df: DataFrame, key: Iterable[str]) -> DataFrame:
    """Keys without NULL that occur more than once, with their number of rows."""
    key = list(key)
    return df.dropna(subset=key).groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


_PRINT, _TIMES = "_fingerprint", "_times"


def constraint_report(
    df: DataFrame, constraints: Constraints, schema: T.StructType | None = None
) -> DataFrame:
    """Violations per check and column: check_name, column_name, violations.

    ``unique`` counts the keys that occur more than once, ``not_null`` and
    ``length`` count rows, ``schema`` counts declared columns that are missing or
    of another type. One scan serves all: rows are counted by a 64-bit fingerprint of their
    key, NULLs and lengths along with them. Only if a fingerprint occurs twice is
    the table read again, and of its keys only those are shuffled that have one of them.
    """
    rules = [
        ("not_null", c, F.col(c).isNull())
        for c in dict.fromkeys((*constraints.key, *constraints.not_null))
    ]
    rules += [("length", c, F.length(c) > n) for c, n in constraints.max_length.items()]
    counters = [F.count_if(rule).alias(f"r{i}") for i, (*_, rule) in enumerate(rules)]
    findings = []
    if constraints.key:
        key = list(constraints.key)
        whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in key))
        marked = df.withColumn(_PRINT, F.when(whole, F.xxhash64(*key)))
        by_print = marked.groupBy(_PRINT).agg(F.count(F.lit(1)).alias(_TIMES), *counters)
        again = F.col(_PRINT).isNotNull() & (F.col(_TIMES) > 1)
        sums = [F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(rules))]
        seen = by_print.agg(F.count_if(again).alias("again"), *sums).first()
        repeated = 0
        if seen["again"]:
            prints = by_print.where(again).select(_PRINT)
            repeated = duplicate_keys(marked.join(prints, _PRINT, "left_semi"), key).count()
        findings.append(("unique", ",".join(key), repeated))
    elif rules:
        seen = df.agg(*counters).first()
    findings += [(check, column, seen[f"r{i}"]) for i, (check, column, _) in enumerate(rules)]
    report = df.sparkSession.createDataFrame(findings, _FINDING)
    return report if schema is None else report.unionByName(schema_report(df, schema))


_FINDING = "check_name string, column_name string, violations bigint"


def schema_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per declared column; a violation if it is missing or of another type."""
    actual = {f.name: f.dataType for f in df.schema}
    rows = [("schema", f.name, int(actual.get(f.name) != f.dataType)) for f in schema]
    return df.sparkSession.createDataFrame(rows, _FINDING)


def reject_report(counts: Mapping[str, Mapping[str, int]], spark: SparkSession) -> DataFrame:
    """One row per table and column with values that became NULL: how many."""
    rows = [(t, c, n) for t, columns in counts.items() for c, n in columns.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, rejects bigint")


def date_rejects(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Per integer-date column, the values that have eight digits but name no day."""
    columns = list(columns)

    def reject(name: str):
        eight = F.length(F.col(name).cast("string")) == 8
        return eight & parse_int_date(F.col(name)).isNull()

    counted = df.agg(*[F.count_if(reject(c)).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "rejects")


def readiness(
    spark: SparkSession,
    paths: Mapping[str, str],
    read: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """Whether each named path holds data: name, present, files, bytes, rows.

    Without ``read`` only the listing is looked at and rows are NULL. With it, which
    turns a path into a table, the tables' rows are counted as well, and a path with
    files but without rows is not present. Nothing is created.
    """
    # Makes paths without files appear.
    none = pa.table({"name": list(paths), "length": pa.nulls(len(paths), pa.int64())})
    listings = [spark.createDataFrame(none)]
    found: dict[str, str] = {}
    for name, path in paths.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        try:
            listings.append(files.load(path).select(F.lit(name).alias("name"), "length"))
            found[name] = path
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    listed = (
        reduce(DataFrame.unionByName, listings)
        .groupBy("name")
        .agg(F.count("length").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    )
    if read is None or not found:
        rows = listed.withColumn("rows", F.lit(None).cast("bigint"))
    else:
        counts = row_counts({name: read(path) for name, path in found.items()})
        rows = listed.join(counts.toDF("name", "rows"), "name", "left")
    present = (F.col("files") > 0) & (F.coalesce("rows", F.lit(1)) > 0)
    return rows.select("name", present.alias("present"), "files", "bytes", "rows")


def require_ready(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Raise if a path is missing or empty."""
    missing = [row.name for row in readiness(spark, paths).where("NOT present").collect()]
    if missing:
        raise FileNotFoundError(f"no data for: {', '.join(sorted(missing))}")
