"""Left outer equi-joins that add columns of a second table."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starweir.operators.skew import MAX_KEY_ROWS, hot_keys, summary, with_hot

# Measured bytes of a table up to which every executor may hold a copy.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NARROW = (
    *_INTEGRAL,
    T.BooleanType,
    T.FractionalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.NullType,
)
_KEY = "_lookup_key"


def row_bytes(df: DataFrame) -> Column | None:
    """What a row takes in memory; None if a column's size cannot be told."""
    width = F.lit(16)
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(8)
        elif isinstance(field.dataType, _NARROW):
            width = width + F.lit(16)
        else:
            return None
    return width.cast("bigint")


def fits_in_memory(df: DataFrame, limit: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the actual contents of ``df`` are known to stay within ``limit`` bytes."""
    width = row_bytes(df)
    if limit <= 0 or width is None:
        return False
    size = df.agg(F.sum(width).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit


def lookup(
    df: DataFrame,
    other: DataFrame,
    on: tuple[str, str],
    columns: Mapping[str, str],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    max_key_rows: int = MAX_KEY_ROWS,
    sample_from: DataFrame | None = None,
    right_sample_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``columns`` of ``other`` (source name to new name) where ``on`` matches.

    Every row of ``df`` is kept, with NULLs on a miss; a key that occurs more
    than once in ``other`` repeats the row. ``other`` is broadcast if its needed
    columns are measured to be small. Otherwise both sides are shuffled, after
    the keys with more than ``max_key_rows`` rows on one side are cut into slices
    there, and their partners copied to each slice.

    ``sample_from`` is a table in which the key is distributed much as in ``df``
    but that is cheaper to read, if ``df`` is itself a join; ``right_sample_from`` is the
    same for ``other``.
    """
    left_key, right_key = on
    right = other.select(
        F.col(right_key).alias(_KEY), *[F.col(old).alias(new) for old, new in columns.items()]
    ).where(F.col(_KEY).isNotNull())
    kind = _common_type(df.schema[left_key].dataType, right.schema[_KEY].dataType)
    left_on, right_on = F.col(left_key).cast(kind), F.col(_KEY).cast(kind)
    same_key = left_on == right_on
    result = [*df.columns, *columns.values()]
    # The right side is read twice: here, and for the join.
    width = row_bytes(right) if max_broadcast_bytes > 0 else None
    if width is not None:
        size, repeated = summary(right, right_on, width, _KEY, max_key_rows)
    else:
        sampled = other if right_sample_from is None else right_sample_from
        sampled = sampled.where(F.col(right_key).isNotNull())
        keys = sampled.select(F.col(right_key).cast(kind).alias(_KEY))
        size, repeated = None, hot_keys(keys, [_KEY], max_key_rows)
    if size is not None and size <= max_broadcast_bytes:
        return df.join(F.broadcast(right), same_key, "left").select(*result)

    left_keys = (df if sample_from is None else sample_from).select(left_on.alias(_KEY))
    many = hot_keys(left_keys, [_KEY], max_key_rows).rename_columns([_KEY, "_left_parts"])
    repeated = repeated.rename_columns([_KEY, "_right_parts"])
    if not many.num_rows and not repeated.num_rows:
        return df.join(right, same_key, "left").select(*result)

    hot = many.join(repeated, _KEY, join_type="full outer")
    left = _divided(df, left_on, hot, "_left_parts", "_left_slice")
    if repeated.num_rows:
        left = _copied(left, "_right_parts", "_copy")
    else:
        left = left.withColumn("_copy", F.lit(0))
    right = _divided(right, right_on, hot, "_right_parts", "_right_slice")
    right = _copied(right, "_left_parts", "_right_copy").withColumn("_matched", F.lit(True))
    joined = left.join(
        right.drop("_left_parts", "_right_parts"),
        [
            same_key,
            F.col("_left_slice") == F.col("_right_copy"),
            F.col("_copy") == F.col("_right_slice"),
        ],
        "left",
    )
    # A row whose partners are divided certainly has one, if not in every slice.
    divided = F.coalesce(F.col("_right_parts"), F.lit(1)) > 1
    return joined.where(~divided | F.col("_matched").isNotNull()).select(*result)


def _divided(df: DataFrame, key: Column, hot: pa.Table, parts: str, name: str) -> DataFrame:
    """Spread the rows of each hot key over its ``parts``.

    The slice must not change when a lost task is run again: it depends on the
    row and on the input partition, which also divides copies of one row. Columns
    that cannot be hashed are left out.
    """
    hashed = [f.name for f in df.schema if not _holds(f.dataType, (T.MapType, T.VariantType))]
    spread = F.xxhash64(*[F.col(c) for c in hashed], F.spark_partition_id())
    part = F.coalesce(F.pmod(spread, F.col(parts)).cast("int"), F.lit(0))
    return with_hot(df, [key], hot).withColumn(name, part)


def _holds(kind: T.DataType, wanted: tuple) -> bool:
    """Whether ``kind`` is, or has inside, one of the ``wanted`` types."""
    if isinstance(kind, wanted):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds(kind.elementType, wanted)
    return isinstance(kind, T.StructType) and any(_holds(f.dataType, wanted) for f in kind)


def _copied(df: DataFrame, parts: str, name: str) -> DataFrame:
    """One copy of each row for every slice of its partners."""
    slices = F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1)
    return df.withColumn(name, F.explode(slices))


def _common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type in which both keys are hashed and compared."""
    if left == right:
        return left
    if isinstance(left, _INTEGRAL) and isinstance(right, _INTEGRAL):
        return T.LongType()
    raise TypeError(f"a {left.simpleString()} key cannot match a {right.simpleString()} key")
