"""Which tokens of two vocabularies share bytes, over a whole corpus.

Both vocabularies cut the same bytes. Two tokens are linked where their bytes overlap; an
id pair's count is how many links of the corpus hold it. The different pairs get the places
0 to n - 1 by a minimal perfect hash, so counts are plain vectors, summed as a tree; a
second pass aligns the documents again and looks the counts up.

The hash is built for buckets of keys by themselves. In a bucket every key tries a bit of a
first level; keys alone at their bit keep it, the others try the next level. A key's place
is the number of kept bits before its own.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm.text import batches, chunks, mix, ranges, utf8
from starweir.llm.tokens import Encoder, vocabulary_path
from starweir.staging import stage

_NONE = np.zeros(0, np.int64)


@dataclass(frozen=True)
class AlignmentRules:
    #: Keys hashed together; the hash of a bucket is built by one task.
    bucket_keys: int = 32_768
    #: Bits of a level for each key left.
    spread: float = 2.0
    #: Pairs whose hash and counts are sent to every task at once (about 20 bytes each);
    #: more pairs take more second passes, each over the pairs of some ids of B.
    sent_pairs: int = 4_000_000
    #: Counts in a piece of a vector, as it is summed.
    piece_counts: int = 65_536
    #: Vectors summed by one task in the first step.
    fan_in: int = 16


class PieceEncoder(Encoder):
    """The same as :class:`Encoder` for a sentencepiece model that puts a blank before
    every text. No piece has a blank after another character, so words do not meet."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_file=path)
        names = [self.pieces.id_to_piece(i) for i in range(len(self.pieces))]
        self.apart = not any("▁" in name.lstrip("▁") for name in names)
        self.special: list[str] = []
        self.word_ends, self.blank_before = False, True
        self.hashes = np.zeros(0, np.uint64)
        self._forget()

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, pieces: list[tuple[str, bool]]) -> None:
        self._remember(hashes, checks, self.pieces.encode([p for p, _ in pieces], num_threads=1))

    def _encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(i, np.uint32) for i in self.pieces.encode(texts, num_threads=1)]

    def encode(self, column: pa.Array):
        if self.apart:
            return super().encode(column)
        found = self._encode_whole([t or "" for t in column.to_pylist()])
        bounds = np.cumsum([0, *map(len, found)])
        return np.concatenate([_NONE.astype(np.uint32), *found]), bounds

    def token_bytes(self) -> list[bytes]:
        sp = self.pieces
        out = []
        for i in range(len(sp)):
            if sp.is_byte(i):
                out.append(bytes([int(sp.id_to_piece(i)[1:-1], 16)]))
            else:
                out.append(sp.id_to_piece(i).replace("▁", " ").encode())
        return out


class ByteEncoder(Encoder):
    """A byte-level vocabulary, for texts with a blank before them; special strings are text."""

    def __init__(self, path: str) -> None:
        super().__init__(path, plain=True, blank_before=True)

    def token_bytes(self) -> list[bytes]:
        value = {c: b for b, c in byte_characters().items()}
        tokenizer = self.tokenizer
        names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        return [
            bytes(value[c] for c in name) if all(c in value for c in name) else name.encode()
            for name in names
        ]


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is
    a visible one, else the next free one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Side:
    """A vocabulary with the bytes and the decimal form of its ids."""

    def __init__(self, kind: type[Encoder], path: str) -> None:
        self.encoder = kind(path)
        own = self.encoder.token_bytes()
        self.lengths = np.array([len(b) for b in own], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(own), np.uint8)
        # Each id with each separator, and with none.
        self.marked = pa.array([f"{i}{mark}" for i in range(len(own)) for mark in _MARKS])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ranges(self.at[ids], self.lengths[ids])]


_MARKS = (",", "|", ";", "")


@cache
def sides(a: str, b: str) -> tuple[Side, Side]:
    """Both vocabularies, kept by the worker for its later tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Side(ByteEncoder, vocabulary_path(a)), Side(PieceEncoder, vocabulary_path(b))


@dataclass
class Aligned:
    """The tokens of some texts, one after the other, and where they share bytes.

    ``a`` and ``b`` are ids with the bounds of each text's; ``end_a`` and ``end_b`` say at
    which byte each ends, ``before_a`` and ``before_b`` how many end before each byte.
    ``link_a`` and ``link_b`` are the tokens of each link, with the
    bounds of each text's links; ``cuts`` are the bytes at which groups end.
    """

    a: np.ndarray
    a_bounds: np.ndarray
    b: np.ndarray
    b_bounds: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    before_a: np.ndarray
    before_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_bounds: np.ndarray
    cuts: np.ndarray
    cut_bounds: np.ndarray

    def keys(self) -> np.ndarray:
        """The id pair of every link: B's id, then A's."""
        return (self.b[self.link_b].astype(np.int64) << 32) | self.a[self.link_a]


def _chosen(ids: np.ndarray, bounds: np.ndarray, good: np.ndarray):
    keep = np.repeat(good, np.diff(bounds))
    return ids[keep], np.concatenate([[0], np.cumsum(np.diff(bounds) * good)])


def align(column: pa.Array, a: str, b: str) -> Aligned:
    """Encode texts by both vocabularies and link the tokens that share bytes.

    Texts that are NULL, empty, or not kept byte by byte by both have no tokens.
    """
    left, right = sides(a, b)
    data, edges = utf8(column)
    ids_a, bounds_a = left.encoder.encode(column)
    ids_b, bounds_b = right.encoder.encode(column)
    size = np.diff(edges)

    def lost(side: Side, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts whose joined tokens are not a blank and the text."""
        total = np.concatenate([[0], np.cumsum(side.lengths[ids])])[bounds]
        same = np.diff(total) == size + 1
        own, own_bounds = _chosen(ids, bounds, same)
        found = side.joined(own)
        wanted = np.insert(data[np.repeat(same, size)], _starts(size[same]), 0x20)
        wrong = np.concatenate([[0], np.cumsum(found != wanted)])
        width = np.where(same, size + 1, 0)
        ends = np.cumsum(width)
        return ~same | (wrong[ends] > wrong[ends - width])

    good = (size > 0) & ~lost(left, ids_a, bounds_a) & ~lost(right, ids_b, bounds_b)
    ids_a, bounds_a = _chosen(ids_a, bounds_a, good)
    ids_b, bounds_b = _chosen(ids_b, bounds_b, good)
    # Tokens without bytes would overlap nothing; these vocabularies have none in a text.
    end_a, end_b = np.cumsum(left.lengths[ids_a]), np.cumsum(right.lengths[ids_b])
    n = int(end_a[-1]) if len(end_a) else 0
    is_a, is_b = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    is_a[end_a], is_b[end_b] = True, True
    # Between two neighbouring ends lies one overlap of one token of each.
    ends = np.flatnonzero(is_a | is_b)
    before_a, before_b = _before(is_a), _before(is_b)
    text_ends = np.concatenate([[0], np.cumsum(np.where(good, size + 1, 0))])
    cuts = np.flatnonzero(is_a & is_b)
    return Aligned(
        ids_a,
        bounds_a,
        ids_b,
        bounds_b,
        end_a,
        end_b,
        before_a,
        before_b,
        before_a[ends],
        before_b[ends],
        np.searchsorted(ends, text_ends, "right"),
        cuts,
        np.searchsorted(cuts, text_ends, "right"),
    )


def _before(marks: np.ndarray) -> np.ndarray:
    """How many marks come before each place."""
    out = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=out[1:])
    return out


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def group_strings(found: Aligned, a: str, b: str) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` for each text: the ids of its groups."""
    left, right = sides(a, b)
    is_cut = np.zeros(len(found.before_a), bool)
    is_cut[found.cuts] = True
    group = _before(is_cut)
    group_a, group_b = group[found.end_a], group[found.end_b]
    last_a = np.ones(len(found.a), bool)
    last_a[:-1] = group_a[1:] != group_a[:-1]
    last_b = np.ones(len(found.b), bool)
    last_b[:-1] = group_b[1:] != group_b[:-1]
    final = np.zeros(len(found.b) + 1, bool)
    final[found.b_bounds[1:] - 1] = True
    mark_a = np.where(last_a, 1, 0)
    mark_b = np.where(final[:-1], 3, np.where(last_b, 2, 0))
    # An A token comes after the B tokens of earlier groups, a B token after all of its group's A.
    until_a, until_b = found.before_a[found.cuts + 1], found.before_b[found.cuts + 1]
    place_a = np.arange(len(found.a)) + np.concatenate([[0], until_b])[group_a]
    place_b = np.arange(len(found.b)) + until_a[group_b]
    which = np.empty(len(found.a) + len(found.b), np.int64)
    which[place_a] = 4 * found.a.astype(np.int64) + mark_a
    which[place_b] = 4 * found.b.astype(np.int64) + mark_b + len(left.marked)
    words = _marked(a, b).take(pa.array(which))
    lists = pa.LargeListArray.from_arrays(pa.array(found.a_bounds + found.b_bounds), words)
    return pc.binary_join(lists, "")


@cache
def _marked(a: str, b: str) -> pa.Array:
    return pa.concat_arrays([side.marked for side in sides(a, b)])


# The hash ------------------------------------------------------------------------------


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)


def _bit(keys: np.ndarray, level: int, size) -> np.ndarray:
    seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    return (mix(keys.astype(np.uint64) + seed) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def build_levels(keys: np.ndarray, spread: float) -> list[np.ndarray]:
    """Kept bits, level by level, for different keys. Levels differ in their hash, which
    maps keys one to one before it is cut to size, so keys are parted in the end."""
    levels = []
    while len(keys):
        size = max(64, -(-int(spread * len(keys)) // 64) * 64)
        at = _bit(keys, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
    return levels


class PerfectHash:
    """Places of all keys, from the bits of every bucket, and the keys themselves."""

    def __init__(self, buckets: list[list[np.ndarray]], keys_of: list[np.ndarray]) -> None:
        self.buckets = len(buckets)
        depth = max((len(levels) for levels in buckets), default=0)
        self.sizes = np.zeros((depth, self.buckets), np.int64)
        self.at = np.zeros((depth, self.buckets), np.int64)
        bits, at = [], 0
        for number, levels in enumerate(buckets):
            for level, alone in enumerate(levels):
                self.sizes[level, number], self.at[level, number] = len(alone), at
                bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
                at += len(alone)
        self.words = np.concatenate([np.zeros(0, np.uint64), *bits])
        kept = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(kept) - kept
        keys = np.concatenate([_NONE, *keys_of])
        self.keys = np.empty_like(keys)
        self.keys[self._places(keys)] = keys

    def _places(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1)
        bucket = bucket_of(keys, max(self.buckets, 1))
        left = np.arange(len(keys))
        for level in range(len(self.sizes)):
            size = self.sizes[level][bucket[left]]
            left, size = left[size > 0], size[size > 0]
            bit = self.at[level][bucket[left]] + _bit(keys[left], level, size)
            word, shift = self.words[bit >> 6], (bit & 63).astype(np.uint64)
            kept = (word >> shift) & np.uint64(1) == 1
            lower = word[kept] & ((np.uint64(1) << shift[kept]) - np.uint64(1))
            out[left[kept]] = self.before[bit[kept] >> 6] + np.bitwise_count(lower)
            left = left[~kept]
        return out

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 for one that was not among the keys."""
        out = self._places(keys)
        found = out >= 0
        found[found] = self.keys[out[found]] == keys[found]
        return np.where(found, out, -1)


# The corpus ----------------------------------------------------------------------------


def _aligned(parts: Iterable[pa.RecordBatch], a: str, b: str):
    for batch in batches(parts):
        _, edges = utf8(batch.column("text"))
        for at, end in chunks(edges):
            few = batch.slice(at, end - at)
            yield few, align(few.column("text"), a, b)


def _count(a: str, b: str):
    """The pairs of a task with their counts, each once, in pieces of a row."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = _NONE, _NONE
        for _, found in _aligned(parts, a, b):
            own, number = np.unique(found.keys(), return_counts=True)
            both = np.concatenate([keys, own])
            codes, keys = pd.factorize(both)
            counts = np.bincount(codes, np.concatenate([counts, number])).astype(np.int64)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        for at in range(0, len(keys), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int32()),
                    pa.array([keys[part].tobytes()], pa.binary()),
                    pa.array([counts[part].tobytes()], pa.binary()),
                ],
                ["task", "keys", "counts"],
            )

    return run


def _key_rows(shards: int, shard: int, buckets: int | None):
    """The keys of a shard, once a task; with their buckets if there are any yet."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for held in batch.column("keys").to_pylist():
                keys = np.frombuffer(held, np.int64)
                keys = keys[shard_of(keys, shards) == shard]
                bucket = bucket_of(keys, buckets or 1)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(keys)], ["bucket", "key"])

    return run


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """All pairs of one id of B are in one shard."""
    return (mix((keys >> 32).astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _built(spread: float):
    """The hash of each bucket; a bucket's keys are together, in one partition."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def built(bucket: int, held: list[np.ndarray]) -> pa.RecordBatch:
            keys = np.concatenate(held)
            levels = [np.packbits(x, bitorder="little").tobytes() for x in build_levels(keys, spread)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket], pa.int64()),
                    pa.array([levels], pa.list_(pa.binary())),
                    pa.array([keys.tobytes()], pa.binary()),
                ],
                ["bucket", "levels", "keys"],
            )

        current, held = None, []
        for batch in parts:
            bucket = batch.column("bucket").to_numpy()
            keys = batch.column("key").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if high == low:
                    continue
                if bucket[low] != current and held:
                    yield built(current, held)
                    held = []
                current = int(bucket[low])
                held.append(keys[low:high])
        if held:
            yield built(current, held)

    return run


def _collected(rows: pa.Table, buckets: int) -> PerfectHash:
    levels: list[list[np.ndarray]] = [[] for _ in range(buckets)]
    keys = [_NONE] * buckets
    for row in rows.to_pylist():
        levels[row["bucket"]] = [
            np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little").astype(bool) for x in row["levels"]
        ]
        keys[row["bucket"]] = np.frombuffer(row["keys"], np.int64)
    return PerfectHash(levels, keys)


def _vectors(sent, shards: int, shard: int, size: int):
    """The counts of each task as a dense vector, in pieces."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value.keys), np.int64)
        task = 0
        for batch in parts:
            for held, counts, task in zip(*(batch.column(c).to_pylist() for c in ("keys", "counts", "task"))):
                keys = np.frombuffer(held, np.int64)
                own = shard_of(keys, shards) == shard
                total[sent.value.places(keys[own])] += np.frombuffer(counts, np.int64)[own]
        for piece, at in enumerate(range(0, len(total), size)):
            own = total[at : at + size]
            if own.any():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece], pa.int32()),
                        pa.array([TaskContext.get().partitionId()], pa.int32()),
                        pa.array([own.tobytes()], pa.binary()),
                    ],
                    ["piece", "node", "counts"],
                )

    return run


def _summed(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each (piece, node), which come one after the other."""
    current, total = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([current[0]], pa.int32()),
                pa.array([current[1]], pa.int32()),
                pa.array([total.tobytes()], pa.binary()),
            ],
            ["piece", "node", "counts"],
        )

    for batch in parts:
        for piece, node, held in zip(*(batch.column(c).to_pylist() for c in ("piece", "node", "counts"))):
            own = np.frombuffer(held, np.int64)
            if (piece, node) == current:
                total += own
                continue
            if current is not None:
                yield out()
            current, total = (piece, node), own.copy()
    if current is not None:
        yield out()


def _tree_sum(vectors: DataFrame, tasks: int, fan_in: int) -> DataFrame:
    """Sum the vectors of ``fan_in`` nodes at a time, until one node is left."""
    schema = "piece int, node int, counts binary"
    while tasks > 1:
        tasks = -(-tasks // fan_in)
        vectors = (
            vectors.withColumn("node", (F.col("node") / fan_in).cast("int"))
            .repartition("piece", "node")
            .sortWithinPartitions("piece", "node")
            .mapInArrow(_summed, schema)
        )
    return vectors


@dataclass
class PairCounts:
    hash: PerfectHash
    counts: np.ndarray

    def __post_init__(self) -> None:
        # The highest count of any pair of the same B id, for every pair.
        ids, code = np.unique(self.hash.keys >> 32, return_inverse=True)
        highest = np.zeros(len(ids), np.int64)
        np.maximum.at(highest, code, self.counts)
        self.best = self.counts == highest[code]


def _looked_up(sent, a: str, b: str, shards: int, shard: int):
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: PairCounts = sent.value
        for batch, found in _aligned(parts, a, b):
            keys = found.keys()
            own = shard_of(keys, shards) == shard
            places = known.hash.places(keys[own])
            if (places < 0).any():
                raise RuntimeError("a pair of the second pass was not met in the first one")
            counts, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            counts[own], best[own] = known.counts[places], known.best[places]

            def sums(values: np.ndarray) -> pa.Array:
                total = np.concatenate([[0], np.cumsum(values)])
                return pa.array(np.diff(total[found.link_bounds]))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(found.a_bounds)),
                    pa.array(np.diff(found.b_bounds)),
                    pa.array(np.diff(found.cut_bounds)),
                    pa.array(np.diff(found.link_bounds)),
                    sums(best),
                    sums(counts),
                    group_strings(found, a, b).cast(pa.string()),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )

    return run


_RESULT = """doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,
    count_sum long, groups string"""


def _pair_counts(
    held: DataFrame, tasks: int, shards: int, shard: int, pairs: int, rules: AlignmentRules
) -> PairCounts:
    spark = held.sparkSession
    buckets = max(1, -(-pairs // (shards * rules.bucket_keys)))
    rows = (
        held.select("keys")
        .mapInArrow(_key_rows(shards, shard, buckets), "bucket long, key long")
        .distinct()
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_built(rules.spread), "bucket long, levels array<binary>, keys binary")
        .toArrow()
    )
    known = _collected(rows, buckets)
    sent = spark.sparkContext.broadcast(known)
    schema = "piece int, node int, counts binary"
    vectors = held.mapInArrow(_vectors(sent, shards, shard, rules.piece_counts), schema)
    summed = _tree_sum(vectors, tasks, rules.fan_in)
    counts = np.zeros(len(known.keys), np.int64)
    for piece, own in summed.groupBy("piece").agg(F.collect_list("counts").alias("all")).collect():
        for part in own:
            at = piece * rules.piece_counts
            counts[at : at + len(part) // 8] += np.frombuffer(part, np.int64)
    return PairCounts(known, counts)


def align_documents(
    docs: DataFrame, a: str, b: str, rules: AlignmentRules = AlignmentRules()
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    ``a`` is a byte-level vocabulary, ``b`` a sentencepiece model that puts a blank before
    every text; both encode a blank and the text. ``groups`` has the ids of the shortest
    pieces at whose ends both have a token's end. ``n_best`` counts the links whose pair is
    the most frequent one of its B id in the corpus, ties included, ``count_sum`` adds the
    corpus-wide counts of the links' pairs.

    A text that is NULL, empty or not kept byte by byte by both has no tokens, zeros and the
    groups ''. NULL doc_ids and repeated rows stay; every row counts. Other columns are not
    read. An empty table gives an empty one.
    """
    texts = docs.select("doc_id", "text")
    spark = docs.sparkSession
    held = stage(texts.mapInArrow(_count(a, b), "task int, keys binary, counts binary"), "pairs")
    pairs = held.select("keys").mapInArrow(_key_rows(1, 0, None), "bucket long, key long")
    pairs = pairs.select("key").distinct().count()
    tasks = held.rdd.getNumPartitions()
    shards = max(1, -(-pairs // rules.sent_pairs))
    parts = []
    for shard in range(shards):
        known = _pair_counts(held, tasks, shards, shard, pairs, rules)
        sent = spark.sparkContext.broadcast(known)
        parts.append(texts.mapInArrow(_looked_up(sent, a, b, shards, shard), _RESULT))
    if shards == 1:
        return parts[0]
    # Equal rows have equal results: one of each shard is added up, and repeated.
    alike = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    sums = ["n_best", "count_sum"]
    every = parts[0].withColumn("shard", F.lit(0))
    for shard, part in enumerate(parts[1:], 1):
        every = every.unionAll(part.withColumn("shard", F.lit(shard)))
    each = every.groupBy(*alike, "shard").agg(
        *(F.max(c).alias(c) for c in sums), F.count(F.lit(1)).alias("copies")
    )
    return (
        each.groupBy(*alike)
        .agg(*(F.sum(c).alias(c) for c in sums), F.max("copies").alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", *sums, "groups")
    )
