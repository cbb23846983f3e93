"""Reproducible shuffling into shards by a keyed permutation of row numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweir.llm.text import mix
from starweir.operators import dense_key

ROUNDS = 6


def permute(numbers: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """The place of each row number (0 to n - 1) in the shuffled order.

    A Feistel network permutes the numbers of 2k bits, k as small as possible. What
    leaves the range 0 to n - 1 is permuted again until it is back in it (cycle
    walking), which keeps the whole a permutation of that range.
    """
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(ROUNDS, dtype=np.uint64) + np.uint64((seed * 1000003 + 1) % 2**64))

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for key in keys:
            left, right = right, left ^ (mix(right ^ key) & mask)
        return (left << shift) | right

    places = network(numbers.astype(np.uint64))
    while len(outside := np.flatnonzero(places >= np.uint64(n))):
        places[outside] = network(places[outside])
    return places.astype(np.int64)


def shuffle_shards(
    df: DataFrame, shards: int, order: Sequence[str | Column], seed: int = 0
) -> DataFrame:
    """Add ``shard`` and ``slot``: where each row of ``df`` goes after a shuffle.

    Rows are numbered in ``order`` over the whole table (ties by the other columns,
    copies in any order), a keyed permutation moves number i to place p, and p gives
    shard p % shards and slot p // shards. So shards differ by one row at most, slots
    have no gaps, and anyone who knows a row's number, the number of rows and the seed
    can compute its place. Columns of these names are replaced. NULLs in the order come
    first. An empty table stays empty.
    """
    names = [c for c in df.columns if c not in ("shard", "slot")]
    # Other columns are held aside, so that none can clash.
    keys = [o if isinstance(o, Column) else F.col(o) for o in order]
    held = df.select(
        *(key.alias(f"k{i}") for i, key in enumerate(keys)), F.struct(*names).alias("held")
    )
    numbered = dense_key(held, [f"k{i}" for i in range(len(keys))], "number")
    n = numbered.count()

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy() - 1, n, seed))

    return numbered.select("held", place("number").alias("at")).select(
        "held.*",
        F.expr(f"CAST(at % {int(shards)} AS INT)").alias("shard"),
        F.expr(f"at div {int(shards)}").alias("slot"),
    )
