"""Token ids by content-defined chunks: text that many documents share is encoded once.

A rolling hash over the bytes cuts texts where their own content says so, so a passage is
cut alike wherever it stands. A chunk's ids are kept from its first to its last white
space, where any text around it gives the same ids. What lies between, at the joins of
chunks, is encoded anew: from the last white space before a join to the first one after it,
over as many chunks as it takes, for only there the encodings of all sides agree for sure.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm.text import _SPACE, batches, byte_values, chunks, ranges, utf8
from starweir.llm.tokens import encoder
from starweir.staging import stage

#: Bytes that decide whether a chunk ends.
ROLLING = 32


@dataclass(frozen=True)
class ReuseRules:
    #: A chunk ends where so many bits of the rolling hash are 0: once in 1,024 bytes.
    bits: int = 10
    least_bytes: int = 256
    most_bytes: int = 16_384
    #: Chunks encoded once for all tasks, those that save most. Further shared chunks are
    #: encoded once by each worker that meets them; the ids are the same.
    dictionary_chunks: int = 8_192
    #: Ids of chunks that a worker remembers; beyond, it starts anew.
    remembered_ids: int = 2_000_000


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``ROLLING`` bytes that end at each byte."""
    hashes = byte_values(data)
    step = 1
    while step < ROLLING:
        longer = hashes.copy()
        longer[step:] += hashes[:-step] << np.uint64(step)
        hashes, step = longer, 2 * step
    return hashes


def cut(data: np.ndarray, bounds: np.ndarray, rules: ReuseRules):
    """Starts and ends of the chunks of the texts data[bounds[i]:bounds[i + 1]], and each
    text's first chunk. Chunks begin and end between characters; an empty text has none."""
    zero = rolling_hashes(data) >> np.uint64(64 - rules.bits) == 0
    inside = (data & 0xC0) == 0x80
    zero[:-1] &= ~inside[1:]
    places = (np.flatnonzero(zero) + 1).tolist()
    starts: list[int] = []
    ends: list[int] = []
    first = [0]
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        at = low
        while at < high:
            place = bisect_left(places, at + rules.least_bytes)
            end = places[place] if place < len(places) else high
            if end - at > rules.most_bytes:
                end = at + rules.most_bytes
                while end < high and inside[end]:
                    end -= 1
            end = min(end, high)
            starts.append(at)
            ends.append(end)
            at = end
        first.append(len(starts))
    return np.array(starts, np.int64), np.array(ends, np.int64), np.array(first, np.int64)


def digests_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [
        blake2b(data[s:e], digest_size=16).digest() for s, e in zip(starts.tolist(), ends.tolist())
    ]


def white(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each chunk: whether it has white space, where the first is, and where the last."""
    spaces = np.append(np.flatnonzero(_SPACE[data]), len(data))
    low, high = np.searchsorted(spaces, starts), np.searchsorted(spaces, ends)
    return high > low, spaces[low], spaces[np.maximum(high - 1, 0)]


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts data[starts[i]:ends[i]]."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    taken = np.ascontiguousarray(data[ranges(starts, lengths)])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(taken)
    )


class Memory:
    """The ids of known chunks, in one array."""

    def __init__(self, vocabulary: str, rules: ReuseRules, held: tuple[list[bytes], list[bytes]]):
        self.encoder, self.rules, self.held = encoder(vocabulary), rules, held
        self._forget()

    def _forget(self) -> None:
        # What was encoded for all tasks stays.
        digests, ids = self.held
        arrays = [np.frombuffer(i, np.uint32) for i in ids]
        self.known = {digest: i for i, digest in enumerate(digests)}
        self.pool = np.concatenate([np.zeros(0, np.uint32), *arrays])
        self.lengths = np.array([len(a) for a in arrays], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.kept = len(self.pool)

    def _learn(self, digests: list[bytes], texts: pa.Array) -> None:
        ids, bounds = self.encoder.encode(texts)
        for digest in digests:
            self.known[digest] = len(self.known)
        self.at = np.concatenate([self.at, bounds[:-1] + len(self.pool)])
        self.lengths = np.concatenate([self.lengths, np.diff(bounds)])
        self.pool = np.concatenate([self.pool, ids.astype(np.uint32)])

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts data[bounds[i]:bounds[i + 1]], and the bounds of each text's."""
        if len(self.pool) - self.kept > self.rules.remembered_ids:
            self._forget()
        starts, ends, first = cut(data, bounds, self.rules)
        broken, head, tail = white(data, starts, ends)
        document = np.repeat(np.arange(len(bounds) - 1), np.diff(first))[broken]
        digests = digests_of(data, starts[broken], ends[broken])
        head, tail = head[broken], tail[broken]
        new = {d: i for i, d in reversed(list(enumerate(digests))) if d not in self.known}
        if new:
            at = np.array(list(new.values()))
            self._learn(list(new), strings(data, head[at], tail[at]))
        codes = np.array([self.known[d] for d in digests], np.int64)
        # Text by text: what comes before the first core, a core, a join, a core, ..., the rest.
        own = np.searchsorted(document, np.arange(len(bounds)))
        join_starts = np.insert(tail, own[:-1], bounds[:-1])
        join_ends = np.insert(head, own[1:], bounds[1:])
        joined, edges = self.encoder.encode(strings(data, join_starts, join_ends))
        core = np.arange(len(codes))
        place = np.empty(len(codes) + len(join_starts), bool)
        place[:] = False
        place[2 * core + document + 1] = True
        length = np.empty(len(place), np.int64)
        length[place], length[~place] = self.lengths[codes], np.diff(edges)
        out_bounds = np.zeros(len(place) + 1, np.int64)
        np.cumsum(length, out=out_bounds[1:])
        reused = np.repeat(place, length)
        ids = np.empty(len(reused), np.uint32)
        ids[reused] = self.pool[ranges(self.at[codes], self.lengths[codes])]
        ids[~reused] = joined
        return ids, out_bounds[2 * own + np.arange(len(bounds))]


def _count(rules: ReuseRules):
    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            seen: Counter[bytes] = Counter()
            size: dict[bytes, int] = {}
            data, edges = utf8(batch.column("text"))
            for at, end in chunks(edges):
                low = edges[at]
                piece = data[low : edges[end]]
                starts, ends, _ = cut(piece, edges[at : end + 1] - low, rules)
                own = digests_of(piece, starts, ends)
                seen.update(own)
                size.update(zip(own, (ends - starts).tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(seen), pa.binary()),
                    pa.array(list(seen.values()), pa.int64()),
                    pa.array([size[d] for d in seen], pa.int64()),
                ],
                ["digest", "n", "bytes"],
            )

    return count


def _texts(wanted, rules: ReuseRules):
    def find(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = set(wanted.value)
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            for at, end in chunks(edges):
                low = edges[at]
                piece = data[low : edges[end]]
                starts, ends, _ = cut(piece, edges[at : end + 1] - low, rules)
                broken, head, tail = white(piece, starts, ends)
                own = digests_of(piece, starts, ends)
                found = [i for i, d in enumerate(own) if d in left and broken[i]]
                found = list({own[i]: i for i in found}.values())
                left.difference_update(own)
                which = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own[i] for i in found], pa.binary()),
                        strings(piece, head[which], tail[which]).cast(pa.string()),
                    ],
                    ["digest", "core"],
                )

    return find


def _encoded(vocabulary: str):
    def encode(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts, text="core"):
            ids, bounds = encoder(vocabulary).encode(batch.column("core"))
            ids = ids.astype(np.uint32)
            own = [ids[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(own, pa.binary())], ["digest", "ids"]
            )

    return encode


def shared_chunks(docs: DataFrame, vocabulary: str, rules: ReuseRules) -> DataFrame:
    """(digest, ids): the chunks found twice or more that save most, each encoded once.

    All chunks of all texts are counted; no text is shuffled but that of the chosen ones.
    """
    texts = docs.select("text")
    counted = (
        texts.mapInArrow(_count(rules), "digest binary, n long, bytes long")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"), F.max("bytes").alias("bytes"))
        .where("n > 1")
    )
    saved = (F.col("n") - 1) * F.col("bytes")
    chosen = counted.orderBy(saved.desc(), "digest").limit(rules.dictionary_chunks)
    wanted = frozenset(chosen.select("digest").toArrow()["digest"].to_pylist())
    sent = docs.sparkSession.sparkContext.broadcast(wanted)
    found = (
        texts.mapInArrow(_texts(sent, rules), "digest binary, core string")
        .groupBy("digest")
        .agg(F.min("core").alias("core"))
    )
    return stage(found.mapInArrow(_encoded(vocabulary), "digest binary, ids binary"), "chunks")


@cache
def token_strings(vocabulary: str) -> pa.Array:
    """The text of every id."""
    tokenizer = encoder(vocabulary).tokenizer
    return pa.array([tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())])


def decode(ids: np.ndarray, bounds: np.ndarray, vocabulary: str) -> pa.Array:
    """The texts of ids, as a tokenizer without a decoder gives them: tokens and blanks."""
    tokens = token_strings(vocabulary).take(pa.array(ids.astype(np.int64)))
    lists = pa.LargeListArray.from_arrays(pa.array(bounds), tokens)
    return pc.binary_join(lists, " ")


def encode_documents(
    docs: DataFrame, vocabulary: str, decoded: bool = False, rules: ReuseRules = ReuseRules()
) -> DataFrame:
    """(doc_id, ids, and with ``decoded`` the text made of them) of every row of ``docs``.

    ``ids`` is what the vocabulary's tokenizer gives for the whole text without special
    tokens. The vocabulary must keep words apart at white space and drop it
    (``Encoder.word_ends``); others raise ValueError. A NULL or empty text has no ids and
    the decoded text ''. NULL doc_ids and repeated rows stay as they are, other columns are
    not read, and an empty table gives an empty one.
    """
    if not encoder(vocabulary).word_ends:
        raise ValueError("chunks are joined at white space, which this vocabulary keeps")
    if decoded and encoder(vocabulary).tokenizer.decoder is not None:
        raise ValueError("this vocabulary has a decoder of its own")
    known = shared_chunks(docs, vocabulary, rules).toArrow()
    held = (known["digest"].to_pylist(), known["ids"].to_pylist())
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(vocabulary, rules, sent.value)
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            for at, end in chunks(edges):
                low = edges[at]
                ids, bounds = memory.encode(data[low : edges[end]], edges[at : end + 1] - low)
                columns = [
                    batch.column("doc_id").slice(at, end - at),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))),
                ]
                if decoded:
                    columns.append(decode(ids, bounds, vocabulary).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    schema = "doc_id long, ids array<int>" + (", decoded string" if decoded else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
