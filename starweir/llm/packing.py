"""Documents packed into sequences of a fixed number of tokens, few of them.

Partitions are packed by best fit decreasing, each by itself. A lower bound from dual
feasible functions certifies a partition that cannot be packed better. The others put
what stands in sequences that are not full together and deal it out anew.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm.text import batches
from starweir.llm.tokens import encoder
from starweir.staging import stage

_log = logging.getLogger(__name__)

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces in a partition, about.
PARTITION_PIECES = 200_000
#: Exchanges go on until so many after each other save no sequence.
PATIENCE = 2


def cut_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece: the ids of a text and ``end_id``, cut only if longer than
    ``capacity``, then into pieces of that length of which the first may be shorter.

    A NULL text is empty and has the end id only. Rows with the same doc_id, NULL
    included, are each cut.
    """

    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches(parts, size=4 << 20):
            ids, bounds = encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
            bounds = bounds + np.arange(len(bounds))
            n = np.diff(bounds)
            number = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            head = n - (number - 1) * capacity
            start = np.where(piece, head[row] + (piece - 1) * capacity, 0)
            length = np.where(piece, capacity, head[row])
            raw = memoryview(ids).cast("B")
            at = 4 * (bounds[row] + start)
            crcs = [
                zlib.crc32(raw[s:e]) for s, e in zip(at.tolist(), (at + 4 * length).tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECE)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece, numbered from 0, and its place there."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: some sequence has room for r more
    used = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = mask >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            at = with_room[room].pop()
            if not with_room[room]:
                mask ^= 1 << room
        else:
            room, at, used = capacity, used, used + 1
        bins[i], offsets[i] = at, capacity - room
        if room > n:
            with_room[room - n].append(at)
            mask |= 1 << (room - n)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer sequences.

    A dual feasible function maps the lengths that fit into one sequence to at most 1 in
    sum, so that the sum over all pieces is a bound. Tried are the identity, thresholds
    (what leaves less than a threshold counts whole, what is below it not), and
    roundings down to multiples of 1 / k.
    """
    if not len(lengths):
        return 0
    size, count = np.unique(lengths, return_counts=True)
    best = -(-int((size * count).sum()) // capacity)
    # Thresholds: large pieces count whole, those from the threshold on by their length.
    total = np.concatenate([[0], np.cumsum(size * count)])
    number = np.concatenate([[0], np.cumsum(count)])
    edge = size[2 * size <= capacity]
    low = np.searchsorted(size, edge)
    high = np.searchsorted(size, capacity - edge, "right")
    whole = number[-1] - number[high]
    part = total[high] - total[low]
    if len(edge):
        best = max(best, int((whole + -(-part // capacity)).max()))
    for k in range(1, 33):
        scaled = (k + 1) * size
        exact = scaled % capacity == 0
        # In units of 1 / (k * capacity).
        value = np.where(exact, k * size, scaled // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


_PACKED = PIECE + ", uid long, bin long, offset long, block long, settled boolean"


def _pack_once(pieces: DataFrame, partitions: int, salt: int, capacity: int) -> DataFrame:
    """Pack every partition; ``settled``: certified, or in a sequence without room."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid", ignore_index=True)
        lengths = group["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(bins, lengths)
        certified = len(filled) <= lower_bound(lengths, capacity)
        return group.assign(
            bin=bins, offset=offsets, settled=certified | (filled[bins] >= capacity)
        )

    columns = [c.split()[0] for c in _PACKED.split(", ")]
    block = F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(partitions))
    return (
        pieces.select(*columns[:6])
        .withColumn("block", block)
        .groupBy("block")
        .applyInPandas(lambda group: pack(group)[columns], _PACKED)
    )


def pack_pieces(
    pieces: DataFrame, capacity: int, partition_pieces: int = PARTITION_PIECES
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    Pieces are dealt to partitions by hash, so that no doc_id makes one large. After each
    round the pieces of partitions with a gap to their bound, except those in full
    sequences, are dealt anew, by another hash, to partitions of the same size and packed
    again; the new packing is taken where it needs fewer sequences. This ends when no
    partition has a gap, when one partition holds all that is left, or when exchanges save
    nothing any more. An empty table stays empty.
    """
    numbered = stage(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    partitions = max(1, -(-numbered.count() // partition_pieces))
    best, done = stage(_pack_once(numbered, partitions, 0, capacity), "packed"), []
    # The exchange that made ``best``, how many there were, and how many since.
    made = exchange = idle = 0
    while True:
        done.append(_numbered(best.where("settled"), made))
        left = best.where("NOT settled")
        n = left.count()
        if not n:
            break
        needed = _sequences(left)
        again = None
        while partitions > 1 and idle < PATIENCE:
            partitions, exchange = max(1, -(-n // partition_pieces)), exchange + 1
            again = stage(_pack_once(left, partitions, exchange, capacity), "packed")
            if _sequences(again) < needed:
                break
            again, idle = None, idle + 1
        if again is None:
            _log.info("%d sequences are not certified to be the fewest", needed)
            done.append(_numbered(left, made))
            break
        best, made, idle = again, exchange, 0
    return reduce(DataFrame.unionAll, done)


def _sequences(packed: DataFrame) -> int:
    return packed.select("block", "bin").distinct().count()


def _numbered(packed: DataFrame, exchange: int) -> DataFrame:
    """Sequences told apart by the exchange, the partition and the number in it."""
    sequence = F.lit(exchange << 48) + F.shiftleft(F.col("block"), 24) + F.col("bin")
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset"
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int
) -> DataFrame:
    """The pieces of all texts, each with its sequence and its place there."""
    return pack_pieces(cut_pieces(docs, vocabulary, end_id, capacity), capacity)
