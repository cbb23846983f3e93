"""Repeated passages: windows of words that start earlier in the corpus, by Rabin-Karp
hashes of every window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweir.llm.housekeeping import release
from starweir.llm.text import (
    WORD_BASES,
    batches,
    chunks,
    inverse,
    mix,
    powers,
    ranges,
    utf8,
    window_hashes,
    window_minima,
    words_of,
)
from starweir.staging import stage

#: Words of the short windows whose least hash leads a window.
LEADER_WORDS = 6

# A place is one number that sorts by text and start: 23 bits that tell texts of one
# doc_id apart besides their hash, 32 bits for the start, 8 bits for a number of windows.
_TIE, _START, _COUNT = 23, 32, 8

#: What identifies a text, whatever its doc_id: 87 bits of two hashes beside it.
KEYS = ["doc", "mark", "tie"]


def _tie(text: Column) -> Column:
    return F.hash(text).cast("long").bitwiseAND(F.lit((1 << _TIE) - 1))


def place(tie: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (tie << (_START + _COUNT)) | (start << _COUNT) | count


def starts_and_counts(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (places >> _COUNT) & ((1 << _START) - 1), places & ((1 << _COUNT) - 1)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and what identifies a text: ``doc``, a NULL doc_id as the least
    number, and ``mark`` and ``tie``, which tell texts of one doc_id apart."""
    return docs.select(
        "doc_id",
        "text",
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64("text").alias("mark"),
        _tie(F.col("text")).alias("tie"),
    )


def _stretches(hashes: np.ndarray, first: np.ndarray, length: int):
    """Stretches of windows with one leader: leader, hash of all words under the stretch,
    text, start in the text, and number of windows.

    A window's leader is the short window in it with the least hash, the first of several.
    It depends on the window's words alone, so equal windows have equal leaders at the same
    distance, and the windows of one stretch all differ.
    """
    own = np.diff(first)
    number = np.maximum(own - length + 1, 0)
    at = ranges(first[:-1], number)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    short = min(LEADER_WORDS, length)
    short_windows = mix(window_hashes(hashes, short, WORD_BASES[0]))
    leader = window_minima(short_windows, length - short + 1)[at]
    row = np.repeat(np.arange(len(own)), number)
    new = np.ones(len(at), bool)
    new[1:] = (leader[1:] != leader[:-1]) | (row[1:] != row[:-1])
    leader = short_windows[leader]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    start = at[begin]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(WORD_BASES[1], len(hashes)), out=sums[1:])
    back = powers(inverse(WORD_BASES[1]), len(hashes) + 1)
    end = start + count + length - 1
    under = mix((sums[end] - sums[start]) * back[start] + count.astype(np.uint64))
    return leader[begin], under, row[begin], start - first[row[begin]], count


def _led(length: int):
    if length >= 1 << _COUNT:
        raise ValueError(f"windows have fewer than {1 << _COUNT} words")

    def lead(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            doc, mark, tie = (batch.column(c).to_numpy() for c in KEYS)
            for at, end in chunks(edges):
                words = words_of(data[edges[at] : edges[end]], edges[at : end + 1] - edges[at])
                leader, under, row, start, count = _stretches(words.hashes(), words.first, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(leader.view(np.int64)),
                        pa.array(under.view(np.int64)),
                        pa.array(doc[at + row]),
                        pa.array(mark[at + row]),
                        pa.array(place(tie[at + row], start, count)),
                    ],
                    ["leader", "under", "doc", "mark", "place"],
                )

    return lead


def distinct_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows of numbers without those equal to the row before: what rows with one
    doc_id and one text have in common."""
    last = None
    for frame in parts:
        if not len(frame):
            continue
        rows = [frame[c].to_numpy() for c in reversed(frame.columns)]
        again = np.zeros(len(frame), bool)
        again[0] = last is not None and all(r[0] == x for r, x in zip(rows, last))
        # Few rows stand at the place of the row before; only those are compared whole.
        same = np.flatnonzero(rows[0][1:] == rows[0][:-1])
        for r in rows[1:]:
            same = same[r[same + 1] == r[same]]
        again[same + 1] = True
        last = [r[-1] for r in rows]
        yield frame[~again] if again.any() else frame


def _resolve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For stretches sorted by leader, words, document and place: all but the first of
    equal stretches are repeats; the first of each is open if its leader has others."""
    last_leader = last_under = None
    waiting: tuple | None = None
    for frame in distinct_rows(parts):
        if not len(frame):
            continue
        leader, under = frame["leader"].to_numpy(), frame["under"].to_numpy()
        text = [frame[c].to_numpy() for c in ("doc", "mark", "place")]
        same_leader = np.zeros(len(frame), bool)
        same_leader[1:] = leader[1:] == leader[:-1]
        same_leader[0] = leader[0] == last_leader
        repeat = same_leader.copy()
        repeat[1:] &= under[1:] == under[:-1]
        repeat[0] &= under[0] == last_under
        # Firsts of their words: open if another first of the same leader stands beside.
        firsts = np.flatnonzero(~repeat)
        alike = leader[firsts][1:] == leader[firsts][:-1]
        is_open = np.zeros(len(firsts), bool)
        is_open[1:] |= alike
        is_open[:-1] |= alike
        extra: list[list] = []
        if waiting is not None:
            if len(firsts) and leader[firsts[0]] == waiting[0]:
                is_open[0] = True
                if not waiting[2]:
                    extra.append(waiting[1])
            if len(firsts):
                waiting = None
        if len(firsts):
            i = firsts[-1]
            waiting = (leader[i], [c[i] for c in text], bool(is_open[-1]))
        last_leader, last_under = leader[-1], under[-1]
        opened = firsts[is_open]
        before = np.array([e for e in extra], np.int64).reshape(-1, 3).T
        columns = [np.concatenate([c[repeat], c[opened], e]) for c, e in zip(text, before)]
        is_open = np.arange(len(columns[0])) >= repeat.sum()
        yield pd.DataFrame(dict(zip(("doc", "mark", "place", "open"), (*columns, is_open))))


def _opened(length: int):
    """Two hashes of every window in the open stretches of each text."""

    def windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            doc, mark, tie = (batch.column(c).to_numpy() for c in KEYS)
            places = batch.column("places")
            for at, end in chunks(edges):
                words = words_of(data[edges[at] : edges[end]], edges[at : end + 1] - edges[at])
                hashes = words.hashes()
                own = places.slice(at, end - at)
                number = own.value_lengths().to_numpy()
                row = np.repeat(np.arange(end - at), number)
                start, count = starts_and_counts(own.flatten().to_numpy())
                window = ranges(words.first[row] + start, count)
                row = np.repeat(row, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(
                            pa.array(window_hashes(hashes, length, b)[window].view(np.int64))
                            for b in WORD_BASES
                        ),
                        pa.array(doc[at + row]),
                        pa.array(mark[at + row]),
                        pa.array(
                            place(tie[at + row], window - words.first[row], np.ones_like(row))
                        ),
                    ],
                    ["one", "two", "doc", "mark", "place"],
                )

    return windows


def _later(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For windows sorted by hash, document and place: all but the first of each."""
    last = None
    for frame in distinct_rows(parts):
        if not len(frame):
            continue
        one, two = frame["one"].to_numpy(), frame["two"].to_numpy()
        again = np.zeros(len(frame), bool)
        again[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
        again[0] = last == (one[0], two[0])
        last = (one[-1], two[-1])
        yield frame.loc[again, ["doc", "mark", "place"]]


def per_document(found: DataFrame) -> DataFrame:
    """The places of each text; there are no more than it has windows."""
    tie = F.shiftrightunsigned("place", _START + _COUNT).alias("tie")
    return found.groupBy("doc", "mark", tie).agg(F.collect_set("place").alias("places"))


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(doc, mark, tie, places) of the windows of ``length`` words that also start earlier."""
    spark, texts = docs.sparkSession, keyed(docs)
    resolved = stage(
        texts.mapInArrow(_led(length), "leader long, under long, doc long, mark long, place long")
        .repartition("leader")
        .sortWithinPartitions("leader", "under", "doc", "mark", "place")
        .mapInPandas(_resolve, "doc long, mark long, place long, open boolean"),
        "stretches",
    )
    release(spark)
    again = stage(
        texts.join(per_document(resolved.where("open")), KEYS)
        .mapInArrow(_opened(length), "one long, two long, doc long, mark long, place long")
        .repartition("one", "two")
        .sortWithinPartitions("one", "two", "doc", "mark", "place")
        .mapInPandas(_later, "doc long, mark long, place long"),
        "windows",
    )
    release(spark)
    return per_document(resolved.where("NOT open").drop("open").unionAll(again))


def _cut(length: int):
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            places = batch.column("places").fill_null([])
            removed = np.zeros(len(batch), np.int64)
            words_in = np.zeros(len(batch), np.int64)
            texts: list[str] = []
            for at, end in chunks(edges):
                piece = data[edges[at] : edges[end]]
                words = words_of(piece, edges[at : end + 1] - edges[at])
                own = places.slice(at, end - at)
                row = np.repeat(np.arange(end - at), own.value_lengths().to_numpy())
                start, count = starts_and_counts(own.flatten().to_numpy())
                start = words.first[row] + start
                depth = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(depth, start, 1)
                np.add.at(depth, start + count + length - 1, -1)
                kept = np.cumsum(depth[:-1]) == 0
                counted = np.concatenate([[0], np.cumsum(kept)])[words.first]
                words_in[at:end] = np.diff(words.first)
                removed[at:end] = words_in[at:end] - np.diff(counted)
                raw = piece.tobytes()
                starts, ends = words.starts[kept].tolist(), words.ends[kept].tolist()
                for low, high in zip(counted[:-1].tolist(), counted[1:].tolist()):
                    texts.append(
                        b" ".join([raw[s:e] for s, e in zip(starts[low:high], ends[low:high])]).decode()
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words_in),
                    pa.array(removed),
                    pa.array(texts, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return cut


def remove_repeated_passages(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without words that a window of
    ``length`` words covers whose sequence also starts earlier: in a smaller doc_id, or in
    the same text before. Kept words are joined by blanks. What overlaps is merged, so
    removed are maximal runs of words. Windows are judged on the texts as they come.

    1. Every window is hashed. Windows that have the same least short window follow one
       another in stretches. Stretches of equal words are found by one hash each: all but
       the first repeat, and stretches whose leader stands nowhere else cannot.
    2. Where equal leaders stand in different words, every window's two hashes are
       counted.
    3. The repeats of each text are cut out.

    A leader with very many stretches streams through its task in sorted order. A NULL or
    empty text has no words. A NULL doc_id counts as the least. Texts of one doc_id come
    in the order of their ``xxhash64``; rows that are equal in both are one document, and
    each row gets its result.
    """
    found = repeated_windows(docs, length)
    return (
        keyed(docs)
        .join(found, KEYS, "left")
        .mapInArrow(_cut(length), "doc_id long, n_words long, n_removed long, kept string")
    )
