"""Versions of a record over time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweir.staging import stage

_ORIGIN, _PART, _FIRST, _LAST = "_origin", "_part", "_first", "_last"


def _rest(df: DataFrame, *used: str) -> list[str]:
    """The other columns, as far as they have an order."""
    unordered = (T.MapType, T.VariantType)
    return [f.name for f in df.schema if f.name not in used and not isinstance(f.dataType, unordered)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    recency: str,
    tie_break: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The row with the greatest ``recency`` of each key; NULL counts as oldest.

    Ties are decided by ``tie_break``, by default all other columns, so the
    result does not depend on row order. Rows whose key is NULL form a group of
    their own. Spark keeps one row per key and task before it shuffles, so a key
    with very many rows does not burden the task that receives it.
    """
    if tie_break is None:
        tie_break = _rest(df, *keys, recency)
        if len(tie_break) + len({*keys, recency}) < len(df.columns):
            raise TypeError("columns without an order: say what breaks ties")
    newest = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(recency), *tie_break)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def validity_ranges(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    tie_break: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Set ``end`` to the day before the key's next ``start``; NULL on the last.

    Versions of a key are ordered by ``start`` and then ``tie_break``, by default
    all other columns. Rows are range partitioned and sorted by key and version, so a
    row's successor is the next row of its partition, and for the last one the first row
    of the partition after. A key may have any number of rows: partitions do not care
    where a key ends. Rows are shuffled and written once, and one row per partition
    reaches the driver. ``partitions`` is the session's number of shuffle partitions
    unless it is given.
    """
    if tie_break is None:
        tie_break = _rest(df, *keys, start, end)
    columns = df.columns if end in df.columns else [*df.columns, end]
    looked_at = [*keys, start]
    following = [f"_next_{i}" for i in range(len(looked_at))]
    total = [*looked_at, *tie_break, *_rest(df, *looked_at, *tie_break), _ORIGIN]
    # Copies of a row are told apart by input partition, so that they need not stay together.
    ordered = (
        df.withColumn(_ORIGIN, F.spark_partition_id())
        .repartitionByRange(*([partitions] if partitions else []), *total)
        .sortWithinPartitions(*total)
        .drop(_ORIGIN)
        .withColumn(_PART, F.spark_partition_id())
    )
    fields = [T.StructField(n, df.schema[c].dataType) for n, c in zip(following, looked_at)]
    fields += [T.StructField(_FIRST, T.BooleanType()), T.StructField(_LAST, T.BooleanType())]
    schema = T.StructType([*ordered.schema.fields, *fields])
    seen = stage(ordered.mapInArrow(_with_next(looked_at, following), schema), "versions")

    heads = seen.where(_FIRST).select(_PART, *looked_at).toArrow().sort_by(_PART)
    if heads.num_rows > 1:
        after = {_PART: heads[_PART].slice(0, heads.num_rows - 1)}
        after |= {f"_head_{i}": heads[c].slice(1) for i, c in enumerate(looked_at)}
        kinds = [T.StructField(_PART, T.IntegerType())]
        kinds += [T.StructField(f"_head_{i}", f.dataType) for i, f in enumerate(fields[:-2])]
        halo = df.sparkSession.createDataFrame(pa.table(after), T.StructType(kinds))
        seen = seen.join(halo.withColumn(_LAST, F.lit(True)), [_PART, _LAST], "left")
        following = [
            F.when(F.col(_LAST), F.col(f"_head_{i}")).otherwise(F.col(name))
            for i, name in enumerate(following)
        ]
    else:
        following = [F.col(name) for name in following]
    *next_key, next_start = following
    same_key = [after_key.eqNullSafe(F.col(k)) for after_key, k in zip(next_key, keys)]
    until = F.when(reduce(Column.__and__, same_key), F.date_sub(next_start, 1))
    return seen.withColumn(end, until).select(*columns)


def _with_next(names: Sequence[str], following: Sequence[str]):
    """Rows with the next row's values of ``names``, NULL on a partition's last row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True

        def out(after: pa.RecordBatch | None) -> pa.RecordBatch:
            n = held.num_rows
            columns = list(held.columns)
            for name in names:
                own = held.column(name)
                last = pa.nulls(1, own.type) if after is None else after.column(name).slice(0, 1)
                columns.append(pa.concat_arrays([own.slice(1), last]))
            columns.append(pa.array([first] + [False] * (n - 1)))
            columns.append(pa.array([False] * (n - 1) + [after is None]))
            return pa.RecordBatch.from_arrays(
                columns, [*held.schema.names, *following, "_first", "_last"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield out(batch)
                first = False
            held = batch
        if held is not None:
            yield out(None)

    return run


def current_version(df: DataFrame, end: str) -> DataFrame:
    """Only rows whose validity has not ended."""
    return df.where(F.col(end).isNull())
