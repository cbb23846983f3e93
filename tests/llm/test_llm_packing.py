"""Exchanges between partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweir.llm import packing


@pytest.mark.parametrize("seed", [1, 2])
def test_exchanges_between_partitions(spark, seed):
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(26, 60, 240), rng.integers(1, 100, 80)]).tolist()
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, packing.PIECE)
    packed = packing.pack_pieces(pieces, 100, partition_pieces=40)
    out = packed.collect()
    assert sorted((r.doc_id, r.length) for r in out) == [(i, n) for i, n in enumerate(lengths)]
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == ends[:-1].tolist() and ends[-1] <= 100
    numbered = pieces.withColumn("uid", F.monotonically_increasing_id())
    once = packing._pack_once(numbered, 8, 0, 100)
    assert packing.lower_bound(np.array(lengths), 100) <= len(sequences) <= packing._sequences(once)
