"""Surrogate keys 1..n in a declared order, without one task that sorts all."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweir.staging import stage

_PLACE = "_place"
_BLOCK = "_block"
_ORIGIN = "_origin"
# monotonically_increasing_id() holds the partition above the row's number in it.
_ROW_BITS = 33


def dense_key(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Add ``name``: the row's number, from 1, in ``order`` over the whole table.

    The table is range partitioned and sorted by ``order``, each row is written
    with its partition and its place there, and the number of rows in earlier
    partitions is added. Ties are broken by the remaining columns, so that the
    result is repeatable, and among copies of one row by input partition, so that
    they need not all go to one task. Keys are final once written: every reader
    of the result sees the same ones.
    """
    rest = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    total = [*order, *rest, _ORIGIN]
    placed = (
        df.withColumn(_ORIGIN, F.spark_partition_id())
        .repartitionByRange(*total)
        .sortWithinPartitions(*total)
        .drop(_ORIGIN)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    written = stage(placed, "dense-key").withColumn(_BLOCK, F.shiftright(_PLACE, _ROW_BITS))

    # One row per range partition.
    sizes = written.groupBy(_BLOCK).agg(F.count(F.lit(1)).alias("rows")).toArrow().sort_by(_BLOCK)
    before = pc.subtract(pc.cumulative_sum(sizes["rows"]), sizes["rows"])
    offsets = df.sparkSession.createDataFrame(
        pa.table({_BLOCK: sizes[_BLOCK], "_before": before})
    )

    in_block = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return written.join(F.broadcast(offsets), _BLOCK).select(
        (F.col("_before") + in_block + 1).alias(name), *df.columns
    )
