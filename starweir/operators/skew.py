"""Finding the keys that hold too many rows for one task.

Hash partitioning puts all rows of a key into one task. The operators that need
it ask here first, and divide only the keys that are too big; with none, they
keep the plain plan. The answers are estimates: they decide how work is spread,
never what the result is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of one key that a single task may take.
MAX_KEY_ROWS = 20_000_000
# Sampled rows that stand for MAX_KEY_ROWS rows.
SAMPLE_PER_PART = 50


def _sample(df: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """A sample, and the number of its rows that stand for ``max_rows``."""
    rate = min(1.0, SAMPLE_PER_PART / max_rows)
    return (df.sample(rate, seed=7) if rate < 1.0 else df), max(1, int(max_rows * rate))


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_KEY_ROWS) -> pa.Table:
    """The keys estimated to hold more than ``max_rows`` rows, NULL among them,
    and into how many ``parts`` to divide each.

    One pass over the key columns, of which a sample is shuffled that shrinks as
    ``max_rows`` grows. There is at most about one hot key per ``max_rows`` rows.
    """
    sampled, per_part = _sample(df.select(*keys), max_rows)
    parts = F.ceil(F.col("seen") / F.lit(per_part)).cast("int").alias("parts")
    return (
        sampled.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("seen"))
        .where(F.col("seen") > per_part)
        .select(*keys, parts)
        .toArrow()
    )


def summary(
    df: DataFrame, key: Column, width: Column | None, name: str, max_rows: int = MAX_KEY_ROWS
) -> tuple[int | None, pa.Table]:
    """The sum of ``width`` over all rows, and what :func:`hot_keys` tells of ``key``, in
    one pass. Partial sums and a sample of the keys are shuffled."""
    rate = min(1.0, SAMPLE_PER_PART / max_rows)
    per_part = max(1, int(max_rows * rate))
    # Rows outside the sample are one group, which every task sums up by itself.
    chosen = F.rand(7) < rate if rate < 1.0 else F.lit(True)
    marked = df.select(
        key.alias(name), (F.lit(None) if width is None else width).cast("bigint").alias("w"), chosen.alias("chosen")
    )
    groups = marked.groupBy("chosen", F.when(F.col("chosen"), F.col(name)).alias(name)).agg(
        F.count(F.lit(1)).alias("seen"), F.sum("w").alias("w")
    )
    parts = F.ceil(F.col("seen") / F.lit(per_part)).cast("int").alias("parts")
    hot = F.when(F.col("chosen") & (F.col("seen") > per_part), F.struct(name, parts))
    found = groups.agg(F.sum("w").alias("w"), F.collect_list(hot).alias("hot")).toArrow()
    total = found["w"][0].as_py()
    rows = found["hot"].combine_chunks().flatten()
    kinds = rows.type
    keys = pa.table([rows.field(i) for i in range(kinds.num_fields)], names=[name, "parts"])
    return (None if width is None else total or 0), keys


def with_hot(
    df: DataFrame,
    keys: Sequence[str | Column],
    hot: pa.Table,
    how: str = "left",
    types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Join the ``hot`` table, whose leading columns are the keys, and add its
    remaining columns, integers unless ``types`` says otherwise. The table is as
    small as the answers of this module are."""
    count = len(keys)
    kinds = [f.dataType for f in df.select(*keys).schema]
    kinds += [(types or {}).get(name, T.IntegerType()) for name in hot.column_names[count:]]
    names = [f"_hot_{i}" for i in range(count)] + hot.column_names[count:]
    # Arrow alone would not tell timestamps with and without time zone apart.
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    small = df.sparkSession.createDataFrame(hot.rename_columns(names), schema)
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    same = [column.eqNullSafe(F.col(name)) for column, name in zip(columns, names)]
    joined = df.join(F.broadcast(small), reduce(Column.__and__, same), how)
    return joined.drop(*names[:count])
