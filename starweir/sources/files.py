"""Tables kept as files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header line: a file, a folder of part files, or several.

    With ``schema`` the columns are bound by position and nothing is scanned
    before the query runs. If the schema has a string column ``_corrupt_record``,
    it gets the text of a line that does not fit; otherwise such a line is an error
    with ``mode="FAILFAST"`` and loses what does not fit without. ``infer`` costs a
    pass over the data. With neither, every column is a string.
    """
    reader = spark.read.options(header=True, **options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def import_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    assignments: Mapping[str, str] | None = None,
    separator: str = ",",
    quote: str = '"',
) -> DataFrame:
    """Delimited text whose first line is skipped and whose columns are named here.

    ``assignments`` maps result columns to SQL expressions over ``columns``; by
    default the columns are taken as they are.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = read_csv(spark, path, schema, sep=separator, quote=quote)
    if assignments is None:
        return df
    return df.select(*[F.expr(sql).alias(name) for name, sql in assignments.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in the declared types; values that do not fit are NULL.

    :func:`misfits` tells which those are.
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def misfits(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """For each declared column of another type in ``df``: whether a row's value, not
    blank, becomes NULL in :func:`conform`."""
    return {
        f.name: (F.trim(F.col(f.name).cast("string")) != "")
        & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema
        if df.schema[f.name].dataType != f.dataType
    }


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, format: str = "parquet"
) -> DataFrame:
    """A table written by :func:`write_table`, with its declared schema."""
    if format == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(format).load(path)


def write_table(df: DataFrame, path: str, format: str = "parquet", **options: str) -> int:
    """Replace the table at ``path`` and return the number of rows written.

    The table is written beside the old one and takes its place when it is whole, so a
    failed write, or a driver lost before the end, leaves the old table as it was, and
    ``df`` may itself read from ``path``. The rows are counted while they are written. CSV
    gets a header line in each part, and like every CSV that Spark writes loses blanks
    around values unless ``ignoreLeadingWhiteSpace`` and ``ignoreTrailingWhiteSpace`` are
    set to False. Parquet is compressed by zstd unless ``compression`` says otherwise.
    """
    counted = Observation()
    beside = _beside(path, "new")
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if format == "csv":
        writer = writer.option("header", True)
    elif format == "parquet":
        writer = writer.option("compression", "zstd")
    try:
        writer.options(**options).format(format).save(beside)
    except BaseException:
        _delete(df.sparkSession, beside)
        raise
    publish(df.sparkSession, beside, path)
    return counted.get["rows"]


def _beside(path: str, kind: str) -> str:
    """A name in the same folder that readers of the folder pass over."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{name}-{uuid.uuid4().hex}.{kind}"


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Let the folder ``written`` take the place of ``path``, by renames.

    Only names change, which a file system does at once. Should the second rename fail,
    the old table gets its name back.
    """
    files, new = _file_system(spark, written)
    _, target = _file_system(spark, path)
    _, old = _file_system(spark, _beside(path, "old"))
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"{path} could not be moved away")
    if not files.rename(new, target):
        if replaced:
            files.rename(old, target)
        raise OSError(f"{written} could not be renamed to {path}")
    if replaced:
        files.delete(old, True)
