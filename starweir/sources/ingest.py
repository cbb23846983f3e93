"""Filling the raw layer. Each table is one distributed read and write; a few
tables are in flight at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweir.jobs import at_once
from starweir.sources.files import read_csv, write_table
from starweir.sources.records import Dialect, csv_records, has_open_lines, parse_records

MALFORMED = "_malformed"
RESULT = "table_name string, row_count bigint, status string, message string"


class IngestError(RuntimeError):
    """Some tables did not arrive. ``result`` tells which."""

    def __init__(self, result: DataFrame, failed: list[str]):
        super().__init__(f"not ingested: {', '.join(failed) or 'no tables found'}")
        self.result = result


def ingest_tables(
    spark: SparkSession,
    names: Iterable[str],
    read: Callable[[str], DataFrame],
    root: str,
    format: str = "parquet",
) -> DataFrame:
    """Write each table to ``root/<name>`` and return one row per table.

    ``read`` turns a name into a DataFrame: ``JdbcDatabase.read``,
    ``spark.table``, or a reader of files. The status is ``loaded``, ``empty``
    (written with its columns, without rows) or ``failed``. Every table is tried;
    any failure, or finding none to ingest, then raises :class:`IngestError`.
    """

    def ingest(name: str) -> tuple[str, int | None, str, str | None]:
        try:
            rows = write_table(read(name), f"{root}/{name}", format)
        except Exception as error:  # noqa: BLE001 - reported in the result
            return name, None, "failed", str(error)
        return name, rows, "loaded" if rows else "empty", None

    outcomes = at_once([partial(ingest, name) for name in names])
    result = spark.createDataFrame(outcomes, RESULT)
    failed = [name for name, _, status, _ in outcomes if status == "failed"]
    if failed or not outcomes:
        raise IngestError(result, failed)
    return result


def ingest_summary(result: DataFrame) -> DataFrame:
    """How many tables arrived, out of how many, and their rows."""
    return result.agg(
        F.count_if(F.col("status") != "failed").alias("succeeded"),
        F.count(F.lit(1)).alias("total"),
        F.sum("row_count").alias("row_count"),
    )


def land_csv_folder(
    spark: SparkSession,
    folder: str,
    root: str,
    format: str = "parquet",
    dialect: Dialect = Dialect(),
) -> DataFrame:
    """Copy every ``*.csv`` of ``folder``, a file or a folder of part files, to
    the raw layer, one table each, named by what precedes ``.csv``.

    Values stay the text they are, with line breaks and quotes of ``dialect`` in them. A
    record with more or fewer fields than the header keeps those that it has, and its whole
    text goes to ``<root>_malformed/<name>``. Returns what ingest_tables returns and the
    number of such records, ``malformed``.

    Tables without line breaks in values are read line by line. The others are cut into
    records first, with the text written and shuffled once.
    """
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.csv")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    entries = [entry.getPath() for entry in files.globStatus(pattern) or []]
    paths = {path.getName().removesuffix(".csv"): path.toString() for path in entries}
    names = sorted(paths)
    seen = {name: Observation() for name in names}
    broken: dict[str, DataFrame] = {}

    def rows(name: str, file: str | None = None) -> DataFrame:
        columns = read_csv(spark, paths[name], **dialect.options()).columns
        if name not in broken and has_open_lines(spark, paths[name], dialect):
            broken[name] = csv_records(spark, paths[name], dialect)
        if name in broken:
            return parse_records(broken[name], columns, MALFORMED, dialect, file)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, MALFORMED]])
        lines = read_csv(
            spark, paths[name], schema, columnNameOfCorruptRecord=MALFORMED, **dialect.options()
        )
        return lines.withColumn(file, F.input_file_name()) if file else lines

    def table(name: str) -> DataFrame:
        odd = F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed")
        return rows(name).observe(seen[name], odd).drop(MALFORMED)

    result = ingest_tables(spark, names, table, root, format)
    counts = {name: seen[name].get["malformed"] for name in names}
    for name in (n for n in names if counts[n]):
        bad = rows(name, "file").where(F.col(MALFORMED).isNotNull())
        write_table(bad, f"{root}_malformed/{name}", "parquet")
    found = spark.createDataFrame(list(counts.items()), "table_name string, malformed bigint")
    return result.join(F.broadcast(found), "table_name")
