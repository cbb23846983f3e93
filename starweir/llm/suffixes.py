"""Repeated strings of bytes: suffixes sorted bucket by bucket, with the ranks of a
difference cover's sample to end long comparisons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm.housekeeping import release
from starweir.llm.substrings import (
    KEYS,
    distinct_rows,
    keyed,
    per_document,
    place,
    starts_and_counts,
)
from starweir.llm.text import (
    BYTE_BASE,
    batches,
    byte_values,
    chunks,
    mix,
    piece_hashes,
    prefix_hashes,
    ranges,
    utf8,
    window_hashes,
    window_minima,
)
from starweir.staging import stage

#: Bytes of the short strings whose least hash leads a string.
LEADER_BYTES = 16
#: Every difference modulo 31 is one of two members of this cover.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Pieces sorted at once.
BLOCK_PIECES = 50_000
#: A leader with more pieces is no bucket: the least document of each of its strings is found.
BUCKET_PIECES = 200_000


def _stretches(data: np.ndarray, bounds: np.ndarray, length: int):
    """Stretches of strings with one leader: leader, hash of all bytes under the stretch,
    text, start in the text, number of strings.

    A string's leader is the short string in it with the least hash, the first of several.
    It depends on the string alone: equal strings have equal leaders at the same distance.
    """
    number = np.maximum(np.diff(bounds) - length + 1, 0)
    at = ranges(bounds[:-1], number)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    short = mix(window_hashes(byte_values(data), LEADER_BYTES, BYTE_BASE))
    leader = window_minima(short, length - LEADER_BYTES + 1)[at]
    row = np.repeat(np.arange(len(number)), number)
    new = np.ones(len(at), bool)
    new[1:] = (leader[1:] != leader[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    start = at[begin]
    under = piece_hashes(prefix_hashes(data), start, start + count + length - 1)
    return short[leader[begin]], under, row[begin], start - bounds[row[begin]], count


def _led(length: int):
    def lead(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            doc, mark, tie = (batch.column(c).to_numpy() for c in KEYS)
            for at, end in chunks(edges):
                leader, under, row, start, count = _stretches(
                    data[edges[at] : edges[end]], edges[at : end + 1] - edges[at], length
                )
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


def _resolve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For stretches sorted by leader, bytes, document and place: those of later documents
    than the first with the same bytes repeat; the first document's are open if the leader
    has other bytes too."""
    leader_now = under_now = first_now = None
    several = False  # the present leader is known to have different bytes
    held: list[list[np.ndarray]] = []  # its first rows otherwise

    def out(of, text, is_open) -> pd.DataFrame:
        # Which leader matters for open stretches only.
        doc, mark, where = text
        return pd.DataFrame(
            {"leader": of, "doc": doc, "mark": mark, "place": where, "open": is_open}
        )

    for frame in distinct_rows(parts):
        if not len(frame):
            continue
        leader, under = frame["leader"].to_numpy(), frame["under"].to_numpy()
        text = [frame[c].to_numpy() for c in ("doc", "mark", "place")]
        doc = text[0]
        new_leader = np.ones(len(frame), bool)
        new_leader[1:] = leader[1:] != leader[:-1]
        goes_on = leader[0] == leader_now
        new_group = new_leader.copy()
        new_group[1:] |= under[1:] != under[:-1]
        group_goes_on = goes_on and under[0] == under_now
        group = np.cumsum(new_group) - 1
        first = doc[new_group]
        if group_goes_on:
            first[0] = first_now
        repeat = doc > first[group]
        run = np.cumsum(new_leader) - 1
        groups = np.bincount(run[new_group])
        many = groups > 1
        if goes_on and (several or not group_goes_on):
            many[0] = True
        is_open = ~repeat & many[run]
        pieces = [
            out(0, [c[repeat] for c in text], False),
            out(leader[is_open], [c[is_open] for c in text], True),
        ]
        if held and goes_on and many[0]:
            pieces += [out(leader_now, h, True) for h in held]
        if not goes_on or many[0] or len(many) > 1:
            held = []
        several = bool(many[-1])
        if not several:
            rest = ~repeat & (run == run[-1])
            held.append([c[rest] for c in text])
        leader_now, under_now, first_now = leader[-1], under[-1], first[group[-1]]
        yield pd.concat(pieces)


def _pieces(length: int):
    """The open stretches' bytes, with the distance from the first byte to the leader."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            doc, mark, tie = (batch.column(c).to_numpy() for c in KEYS)
            places = batch.column("places")
            for at, end in chunks(edges):
                piece = data[edges[at] : edges[end]]
                own = places.slice(at, end - at)
                row = np.repeat(np.arange(end - at), own.value_lengths().to_numpy())
                low = (edges[at:end] - edges[at])[row]
                start, count = starts_and_counts(own.flatten().to_numpy())
                short = mix(window_hashes(byte_values(piece), LEADER_BYTES, BYTE_BASE))
                inside = np.arange(length - LEADER_BYTES + 1)
                for few in np.array_split(np.arange(len(start)), len(start) // 20_000 + 1):
                    s, c, r = start[few], count[few], row[few]
                    first = low[few] + s
                    distance = np.argmin(short[first[:, None] + inside], axis=1)
                    bucket = short[first + distance]
                    raw = piece.tobytes()
                    ends = (first + c + length - 1).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket.view(np.int64)),
                            pa.array(doc[at + r]),
                            pa.array(mark[at + r]),
                            pa.array(place(tie[at + r], s, c)),
                            pa.array(distance.astype(np.int32)),
                            pa.array([raw[a:b] for a, b in zip(first.tolist(), ends)], pa.binary()),
                        ],
                        ["bucket", "doc", "mark", "place", "distance", "piece"],
                    )

    return rows


def _strings(length: int):
    """Every string of the open stretches by itself."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            doc, mark, tie = (batch.column(c).to_numpy() for c in KEYS)
            places = batch.column("places")
            for at, end in chunks(edges):
                raw = data[edges[at] : edges[end]].tobytes()
                own = places.slice(at, end - at)
                row = np.repeat(np.arange(end - at), own.value_lengths().to_numpy())
                start, count = starts_and_counts(own.flatten().to_numpy())
                for few in np.array_split(np.arange(len(start)), len(start) // 20_000 + 1):
                    begin = ranges(start[few], count[few])
                    r = np.repeat(row[few], count[few])
                    first = (begin + (edges[at:end] - edges[at])[r]).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([raw[i : i + length] for i in first], pa.binary()),
                            pa.array(doc[at + r]),
                            pa.array(mark[at + r]),
                            pa.array(place(tie[at + r], begin, np.ones_like(begin))),
                        ],
                        ["string", "doc", "mark", "place"],
                    )

    return rows


def _of_large(strings: DataFrame) -> DataFrame:
    """(doc, mark, place) of the strings that an earlier document has too. Each task first
    keeps one row per string; strings in very many places are spread over slices, each
    with a copy of the string's one least document."""
    least = stage(
        strings.groupBy("string")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count(F.lit(1)).alias("n"))
        .where("least < most")
        .select("string", "least", F.expr(f"int(n div {BUCKET_PIECES}) + 1").alias("slices")),
        "least",
    )
    # No more than one for every BUCKET_PIECES strings.
    sliced = F.broadcast(least.where("slices > 1").select("string", "slices"))
    dealt = strings.join(sliced, "string", "left").withColumn(
        "slice", F.expr("pmod(xxhash64(mark, place), coalesce(slices, 1))")
    )
    copies = least.select("string", "least", F.expr("explode(sequence(0L, slices - 1L))").alias("slice"))
    return (
        dealt.join(copies, ["string", "slice"])
        .where("doc > least")
        .select("doc", "mark", "place")
    )


def _sampled(column: int) -> int:
    """The first column from ``column`` on that is in the cover's sample."""
    while column % MODULUS not in COVER:
        column += 1
    return column


def _as_numbers(columns: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian numbers, most significant first."""
    width = -(-columns.shape[1] // 8) * 8
    padded = np.zeros((len(columns), width), np.uint8)
    padded[:, : columns.shape[1]] = columns
    return list(padded.view(">u8").astype(np.uint64).T)


def repeats_in_block(
    bucket: np.ndarray,
    doc: np.ndarray,
    count: np.ndarray,
    distance: np.ndarray,
    pieces: list[bytes],
    length: int,
) -> np.ndarray:
    """Whether each string of each piece also starts in an earlier document; a row for
    each piece, a column for each start.

    The pieces of a bucket are laid so that their leaders are in the same columns; equal
    strings then begin in the same column, and from any column the next one of the sample
    is the same for both. Sorted are the suffixes in the sample's columns, once each, with
    the lengths of the prefixes that neighbours share. What begins elsewhere is compared
    only up to the next sampled column; from there the sample's ranks decide.
    """
    left = length - LEADER_BYTES
    width = 2 * left + LEADER_BYTES
    sizes = count + length - 1
    grid = np.zeros((len(pieces), width), np.uint8)
    low = left - distance
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    grid.ravel()[ranges(np.arange(len(pieces)) * width + low, sizes)] = flat
    found = np.zeros((len(pieces), left + 1), bool)
    by_sample: dict[int, list[int]] = {}
    for column in range(left + 1):
        by_sample.setdefault(_sampled(column), []).append(column)
    for sample, columns in by_sample.items():
        suffixes = grid[:, sample : sample + length]
        numbers = _as_numbers(suffixes)
        order = np.lexsort([*numbers[::-1], bucket])
        ordered = suffixes[order]
        equal = ordered[1:] == ordered[:-1]
        shared = np.where(equal.all(1), suffixes.shape[1], np.argmin(equal, axis=1))
        apart = bucket[order][1:] != bucket[order][:-1]
        for column in columns:
            need = length - (sample - column)
            rank = np.empty(len(pieces), np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(apart | (shared < need))])
            valid = np.flatnonzero((column >= low) & (column < low + count))
            some = np.bincount(rank[valid], minlength=len(pieces))[rank[valid]] > 1
            valid = valid[some]
            if not len(valid):
                continue
            before = _as_numbers(grid[valid, column:sample]) if sample > column else []
            keys = [rank[valid], *before]
            by = np.lexsort([doc[valid], *keys[::-1]])
            new = np.zeros(len(valid), bool)
            new[0] = True
            for key in keys:
                new[1:] |= key[by][1:] != key[by][:-1]
            docs = doc[valid][by]
            first = docs[new][np.cumsum(new) - 1]
            found[valid[by], column] = docs > first
    return found


def _sorted_buckets(length: int):
    """The repeats of pieces that come sorted by bucket; whole buckets are sorted together."""

    def runs(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, mark, where = (batch.column(c).to_numpy() for c in ("doc", "mark", "place"))
        distance = batch.column("distance").to_numpy().astype(np.int64)
        start, count = starts_and_counts(where)
        found = repeats_in_block(
            batch.column("bucket").to_numpy(), doc, count, distance,
            batch.column("piece").to_pylist(), length,
        )
        edge = np.zeros((len(found), found.shape[1] + 2), np.int8)
        edge[:, 1:-1] = found
        step = np.diff(edge, axis=1)
        row, begin = np.nonzero(step == 1)
        _, end = np.nonzero(step == -1)
        low = length - LEADER_BYTES - distance[row]
        tie = where[row] >> 40
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc[row]),
                pa.array(mark[row]),
                pa.array(place(tie, start[row] + begin - low, end - begin)),
            ],
            ["doc", "mark", "place"],
        )

    def sort(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in parts:
            held.append(batch)
            rows += len(batch)
            if rows < BLOCK_PIECES:
                continue
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bucket = table.column("bucket").to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1]))
            if cut:
                yield runs(table.slice(0, cut))
            held, rows = [table.slice(cut)], len(table) - cut
        if rows:
            yield runs(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return sort


def repeated_strings(docs: DataFrame, length: int) -> DataFrame:
    """(doc, mark, tie, places) of the strings of ``length`` bytes that also start in a
    document with a smaller doc_id."""
    spark, texts = docs.sparkSession, keyed(docs)
    resolved = stage(
        texts.mapInArrow(_led(length), "leader long, under long, doc long, mark long, place long")
        .repartition("leader")
        .sortWithinPartitions("leader", "under", "doc", "mark", "place")
        .mapInPandas(_resolve, "leader long, doc long, mark long, place long, open boolean"),
        "stretches",
    )
    release(spark)
    is_open = resolved.where("open")
    # No more than one for every BUCKET_PIECES open stretches.
    large = stage(
        is_open.groupBy("leader").count().where(f"count > {BUCKET_PIECES}").select("leader"), "large"
    )

    def opened(how: str) -> DataFrame:
        places = per_document(is_open.join(F.broadcast(large), "leader", how))
        return texts.join(places, KEYS)

    schema = "bucket long, doc long, mark long, place long, distance int, piece binary"
    found = stage(
        opened("left_anti")
        .mapInArrow(_pieces(length), schema)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_sorted_buckets(length), "doc long, mark long, place long"),
        "strings",
    )
    release(spark)
    if not large.isEmpty():
        strings = opened("left_semi").mapInArrow(
            _strings(length), "string binary, doc long, mark long, place long"
        )
        found = found.unionAll(stage(_of_large(strings), "strings-of-large"))
        release(spark)
    return per_document(resolved.where("NOT open").select("doc", "mark", "place").unionAll(found))


def _cut(length: int):
    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            places = batch.column("places").fill_null([])
            row = np.repeat(np.arange(len(batch)), places.value_lengths().to_numpy())
            start, count = starts_and_counts(places.flatten().to_numpy())
            start = edges[row] + start
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, start, 1)
            np.add.at(depth, start + count + length - 1, -1)
            gone = np.cumsum(depth[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            firsts = edges[:-1][np.diff(edges) > 0]
            begins[firsts] = gone[firsts]
            kept = data[~gone]
            kept_edges = np.concatenate([[0], np.cumsum(~gone)])[edges]
            spans = np.concatenate([[0], np.cumsum(begins)])[edges]
            n = np.diff(edges)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n),
                    pa.array(n - np.diff(kept_edges)),
                    pa.array(np.diff(spans)),
                    pa.Array.from_buffers(
                        pa.binary(),
                        len(batch),
                        [None, pa.py_buffer(kept_edges.astype(np.int32)), pa.py_buffer(kept)],
                    ),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return cut


def remove_repeated_strings(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the UTF-8 bytes of each text without
    those that a string of ``length`` bytes covers that also starts in a document with a
    smaller doc_id. ``n_spans`` counts the maximal runs removed. Matches stay within
    documents and are judged on the texts as they come. ``kept`` may break a character.

    1. Strings with one leader follow one another in stretches. Stretches of equal bytes
       are found by a hash; only where one leader stands in different bytes is more to do.
    2. Those stretches, cut out with what surrounds them, are suffix buckets: a leader's
       suffixes come together and are sorted, a block of whole buckets at a time. Long
       ties end at the columns of a difference cover, whose suffixes are ranked before.
       A leader of more than BUCKET_PIECES stretches is no bucket that one task could hold:
       its strings are grouped by their bytes, each task's first, to their least document.
    3. The repeats of each document are cut out.

    A NULL text is empty. A NULL doc_id counts as the least. Texts with one doc_id do not
    take from each other; rows equal in both are one document, and each gets its result.
    """
    found = repeated_strings(docs, length)
    return (
        keyed(docs)
        .join(found, KEYS, "left")
        .mapInArrow(
            _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
        )
    )
