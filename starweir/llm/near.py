"""Near copies: candidates from an inverted join on signature coordinates, confirmed on
whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm.graph import components
from starweir.llm.text import (
    WORD_BASES,
    batches,
    chunks,
    mix,
    ranges,
    utf8,
    window_hashes,
    words_of,
)
from starweir.staging import stage


@dataclass(frozen=True)
class NearRules:
    #: Words in a shingle.
    words: int = 3
    #: Link if 100 * size of the intersection >= percent * size of the union.
    percent: int = 85
    #: Coordinates of a signature, and how many must agree for a candidate. Two sets as
    #: similar as 0.85 agree in fewer than 27 of 48 with a probability of 4e-7.
    coordinates: int = 48
    matches: int = 27
    #: A list with more documents is cut into parts, and all pairs of parts are handled.
    list_rows: int = 4096
    #: The same for a class of candidates, in shingles.
    class_shingles: int = 2_000_000

    @property
    def prefix(self) -> int:
        """Two signatures that agree in ``matches`` coordinates agree in one of the first
        so many."""
        return self.coordinates - self.matches + 1


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingle_sets(
    data: np.ndarray, bounds: np.ndarray, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and the bounds of the texts'."""
    found = words_of(_LOWER[data], bounds)
    hashes = found.hashes()
    own = np.diff(found.first)
    long = own >= words
    starts = ranges(found.first[:-1][long], own[long] - words + 1)
    shingles = window_hashes(hashes, words, WORD_BASES[0])[starts]
    row = np.repeat(np.flatnonzero(long), own[long] - words + 1)
    # A short text is one shingle: its words, told apart from longer ones by their number.
    for i in np.flatnonzero((own > 0) & ~long):
        part = hashes[found.first[i] : found.first[i + 1]]
        one = window_hashes(part, len(part), WORD_BASES[1]) + np.uint64(len(part))
        shingles, row = np.append(shingles, one), np.append(row, i)
    shingles = mix(shingles)
    order = np.lexsort((shingles, row))
    shingles, row = shingles[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (row[1:] != row[:-1])
    shingles, row = shingles[new], row[new]
    return shingles, np.searchsorted(row, np.arange(len(bounds)))


def set_hashes(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Two hashes of each set, 128 bits together; sums, so that order does not matter."""
    one = np.add.reduceat(shingles, starts)
    return np.stack([one, np.add.reduceat(mix(shingles ^ WORD_BASES[1]), starts)])


def signatures(shingles: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """The minima of ``coordinates`` hash functions over each set, none of them empty."""
    keys = mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64))
    out = np.empty((len(starts), coordinates), np.uint32)
    for k in range(coordinates):
        values = ((shingles ^ keys[k]) * (keys[coordinates + k] | np.uint64(1))) >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(values, starts)
    return out


def _signed(rules: NearRules):
    """(doc_id, tie, set hashes, n_shingles, signature) of each text."""

    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            for at, end in chunks(edges):
                sets, bounds = shingle_sets(
                    data[edges[at] : edges[end]], edges[at : end + 1] - edges[at], rules.words
                )
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                starts = bounds[:-1][full]
                hashes = np.zeros((2, len(n)), np.uint64)
                signed = [None] * len(n)
                if len(full):
                    hashes[:, full] = set_hashes(sets, starts)
                    signs = signatures(sets, starts, rules.coordinates).astype("<u4")
                    for i, row in zip(full.tolist(), signs):
                        signed[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(at, end - at) for c in ("doc_id", "tie")),
                        pa.array(hashes[0].view(np.int64)),
                        pa.array(hashes[1].view(np.int64)),
                        pa.array(n),
                        pa.array(signed, pa.binary()),
                    ],
                    ["doc_id", "tie", "h1", "h2", "n_shingles", "signature"],
                )

    return sign


def _postings(rules: NearRules):
    """A row for each of the first coordinates: its list, the document, and one byte of
    every coordinate to count collisions by."""

    def post(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = mix(np.arange(100, 100 + rules.prefix, dtype=np.uint64))
        for batch in parts:
            n = len(batch)
            signs = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4")
            signs = signs.reshape(n, rules.coordinates)
            lists = mix(signs[:, : rules.prefix].astype(np.uint64) ^ salts)
            short = (mix(signs) & np.uint64(255)).astype(np.uint8)
            rows = [r.tobytes() for r in short]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lists.ravel().view(np.int64)),
                    pa.array(np.repeat(batch.column("node").to_numpy(), rules.prefix)),
                    pa.array(rows, pa.binary()).take(
                        pa.array(np.repeat(np.arange(n), rules.prefix))
                    ),
                ],
                ["list", "node", "short"],
            )

    return post


def _spanning(left: np.ndarray, right: np.ndarray, agree) -> list[tuple[int, int]]:
    """Links that connect what agreeing pairs connect: few, not all pairs.

    ``left`` and ``right`` are row numbers; pairs have one of each (if ``right`` is empty,
    both of ``left``). ``agree(row, rows)`` tells which rows go with a row. A row that has
    been reached is not compared again with rows that come later.
    """
    links: list[tuple[int, int]] = []
    if not len(right):
        rest = left
        while len(rest):
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                row = front.pop()
                hit = agree(row, rest)
                links += [(row, r) for r in rest[hit]]
                front += rest[hit].tolist()
                rest = rest[~hit]
        return links
    rest = [left, right]
    while len(rest[0]) and len(rest[1]):
        front = [(rest[0][0], 1)]
        rest[0] = rest[0][1:]
        while front:
            row, side = front.pop()
            if not len(rest[side]):
                continue
            hit = agree(row, rest[side])
            links += [(row, r) for r in rest[side][hit]]
            front += [(r, 1 - side) for r in rest[side][hit].tolist()]
            rest[side] = rest[side][~hit]
    return links


def _grouped(key: str, links_of, quick=None):
    """For rows sorted by ``key`` and part: the links of each group of at least two rows.

    One group is held at a time. ``links_of(frame, side)`` gets the side of each row if
    the group is a pair of parts, else None. ``quick(frame, lows, highs)`` does what it
    can for many groups at once, and returns links and the groups that need more.
    """

    def link(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in parts:
            if not len(frame):
                continue
            keys, part = frame[key].to_numpy(), frame["part"].to_numpy()
            new = np.flatnonzero((keys[1:] != keys[:-1]) | (part[1:] != part[:-1])) + 1
            edges = np.concatenate([[0], new, [len(frame)]])
            if held and (held[0][key].iloc[0] != keys[0] or held[0]["part"].iloc[0] != part[0]):
                yield links(pd.concat(held, ignore_index=True))
                held = []
            if len(edges) > 2:
                first = frame.iloc[: edges[1]]
                yield links(pd.concat([*held, first], ignore_index=True))
                held = []
                several = np.flatnonzero(np.diff(edges[1:-1]) > 1) + 1
                if quick and len(several):
                    found, more = quick(frame, edges[several], edges[several + 1])
                    yield found
                    several = several[more | frame["pair"].to_numpy()[edges[several]]]
                if len(several):
                    yield pd.concat(
                        [
                            links(frame.iloc[edges[i] : edges[i + 1]].reset_index(drop=True))
                            for i in several.tolist()
                        ]
                    )
            held.append(frame.iloc[edges[-2] :])
        if held:
            yield links(pd.concat(held, ignore_index=True))

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        if len(frame) > 1:
            side = frame["side"].to_numpy() if frame["pair"].iloc[0] else None
            nodes = frame["node"].to_numpy()
            found = [(nodes[a], nodes[b]) for a, b in links_of(frame, side)]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return link


def _among(n: int, side: np.ndarray | None, agree) -> list[tuple[int, int]]:
    rows = np.arange(n)
    if side is None:
        return _spanning(rows, rows[:0], agree)
    return _spanning(rows[side == 0], rows[side == 1], agree)


def _collisions(rules: NearRules):
    """Links between sets of one list whose signatures collide often enough."""

    def links_of(frame: pd.DataFrame, side: np.ndarray | None) -> list[tuple[int, int]]:
        short = np.frombuffer(b"".join(frame["short"]), np.uint8).reshape(len(frame), -1)

        def agree(row: int, rows: np.ndarray) -> np.ndarray:
            return (short[rows] == short[row]).sum(1) >= rules.matches

        return _among(len(frame), side, agree)

    return links_of


def _first_collisions(rules: NearRules):
    """Links of each list's first row. A list whose rows all collide with it needs no
    more, nor does one of two rows."""

    def quick(frame: pd.DataFrame, lows: np.ndarray, highs: np.ndarray):
        short = np.frombuffer(b"".join(frame["short"]), np.uint8).reshape(len(frame), -1)
        nodes, side = frame["node"].to_numpy(), frame["side"].to_numpy()
        others = highs - lows - 1
        first, rows = np.repeat(lows, others), ranges(lows + 1, others)
        agree = (short[rows] == short[first]).sum(1) >= rules.matches
        missed = np.add.reduceat(~agree, np.cumsum(others) - others)
        # In a pair of parts, rows of one side are not for this group to link.
        hit = agree & (~frame["pair"].to_numpy()[rows] | (side[rows] != side[first]))
        found = pd.DataFrame({"a": nodes[first[hit]], "b": nodes[rows[hit]]})
        return found, (missed > 0) & (others > 1)

    return quick


def _confirmed(rules: NearRules):
    """Links between the whole sets of one class of candidates."""

    def links_of(frame: pd.DataFrame, side: np.ndarray | None) -> list[tuple[int, int]]:
        sizes = frame["n_shingles"].to_numpy()
        sets = np.frombuffer(b"".join(frame["shingles"]), "<u8")
        ends = np.cumsum(sizes)
        starts = ends - sizes

        def agree(row: int, rows: np.ndarray) -> np.ndarray:
            own, n = sets[starts[row] : ends[row]], sizes[rows]
            near = 100 * np.minimum(n, len(own)) >= rules.percent * np.maximum(n, len(own))
            out = np.zeros(len(rows), bool)
            if near.any():
                n = n[near]
                others = sets[ranges(starts[rows[near]], n)]
                place = np.minimum(np.searchsorted(own, others), len(own) - 1)
                both = np.add.reduceat((own[place] == others).astype(np.int64), np.cumsum(n) - n)
                out[near] = 100 * both >= rules.percent * (n + len(own) - both)
            return out

        return _among(len(frame), side, agree)

    return links_of


def _parted(rows: DataFrame, key: str, weight, size: int) -> DataFrame:
    """Rows of groups of at least two, with the pair of parts of the group they are for.

    A group of at most ``size`` is one part. A larger one is cut by hash into as many
    parts as needed, and each row goes to every pair of parts that has its own: no pair of
    rows is left out, and no pair of parts is much larger than two times ``size``.
    """
    groups = (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weight"))
        .where("n > 1")
        .select(key, F.ceil(F.col("weight") / size).cast("int").alias("parts"))
    )
    parts = F.col("parts")
    return (
        rows.join(groups, key)
        .withColumn("own", F.pmod(F.xxhash64("node"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("part", F.least("own", "other") * parts + F.greatest("own", "other"))
        .withColumn("pair", F.col("part") % (parts + 1) != 0)
        .withColumn("side", (F.col("own") > F.col("other")).cast("int"))
        .select(*rows.columns, "part", "pair", "side")
    )


def _set_rows(rules: NearRules):
    """The whole shingle sets of chosen documents, if they are the sets that were meant."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            data, edges = utf8(batch.column("text"))
            for at, end in chunks(edges):
                sets, bounds = shingle_sets(
                    data[edges[at] : edges[end]], edges[at : end + 1] - edges[at], rules.words
                )
                n = np.diff(bounds)
                own = batch.slice(at, end - at)
                meant = np.stack([own.column(h).to_numpy() for h in ("h1", "h2")])
                full = np.flatnonzero(n)
                hashes = np.zeros((2, len(n)), np.uint64)
                if len(full):
                    hashes[:, full] = set_hashes(sets, bounds[:-1][full])
                kept = full[(hashes.view(np.int64) == meant).all(0)[full]]
                own = own.take(pa.array(kept))
                raw = memoryview(sets.astype("<u8")).cast("B")
                yield pa.RecordBatch.from_arrays(
                    [
                        *(own.column(c) for c in ("class", "part", "pair", "side", "node")),
                        pa.array(n[kept]),
                        pa.array(
                            [bytes(raw[8 * bounds[i] : 8 * bounds[i + 1]]) for i in kept.tolist()],
                            pa.binary(),
                        ),
                    ],
                    ["class", "part", "pair", "side", "node", "n_shingles", "shingles"],
                )

    return rows


def _linked(rows: DataFrame, key: str, links_of, quick=None) -> DataFrame:
    """The distinct links of all groups, of which each is in one task."""
    return (
        rows.repartition(key, "part")
        .sortWithinPartitions(key, "part", "node")
        .mapInPandas(_grouped(key, links_of, quick), "a long, b long")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )


def near_components(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, kept) of every text.

    Texts are lower-cased in A-Z; a set is its distinct shingles of ``words`` words, or the
    one sequence of a shorter text. Texts are linked by the similarity of their sets, and a
    component's id is the least doc_id in it. ``kept`` is true for that document. ``tie`` is
    a hash that tells texts of one doc_id apart; of those in one component the least is kept.

    1. Each distinct set, not each document, is signed, and posted in the list of each of
       the first coordinates' values (a prefix: who agrees in enough coordinates shares
       one of these lists). In a list, colliding coordinates are counted, and links are
       kept that connect what has enough; who is connected is skipped.
    2. The classes that these links connect are the candidates. Their whole sets come
       together and are compared exactly; links are kept that connect what is similar.
    3. Components of the confirmed links.

    Lists and classes of any size are cut into pairs of parts, so that no task holds more
    than a fixed amount and no pair is left out. NULL and empty texts have no shingles and
    no links. A row with a NULL doc_id is not linked, its component is NULL, and it is kept.
    Rows with equal doc_ids and texts are one document here; each is returned.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    signed = stage(
        docs.mapInArrow(
            _signed(rules),
            "doc_id long, tie long, h1 long, h2 long, n_shingles long, signature binary",
        ),
        "signed",
    )
    chosen = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Exact copies: one set, named by the least document that has it.
    sets = stage(
        chosen.groupBy("h1", "h2")
        .agg(
            F.min(F.struct("doc_id", "tie")).alias("least"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
        .select("h1", "h2", "least.*", "n_shingles", "signature")
        .withColumn("node", F.monotonically_increasing_id()),
        "sets",
    )
    postings = sets.select("node", "signature").mapInArrow(
        _postings(rules), "list long, node long, short binary"
    )
    listed = _parted(postings, "list", F.lit(1), rules.list_rows)
    collide = _linked(listed, "list", _collisions(rules), _first_collisions(rules))
    candidates = stage(collide, "candidates")
    classes = components(candidates).withColumnRenamed("component", "class")
    members = _parted(
        sets.drop("signature").join(classes, "node"),
        "class",
        F.col("n_shingles"),
        rules.class_shingles,
    ).select("doc_id", "tie", "h1", "h2", "class", "part", "pair", "side", "node")
    # Always by a shuffle: what is sent must not depend on how many members there are.
    members = stage(members, "members").hint("merge")
    whole = docs.join(members, ["doc_id", "tie"]).mapInArrow(
        _set_rows(rules),
        """class long, part int, pair boolean, side int, node long, n_shingles long,
        shingles binary""",
    )
    links = stage(_linked(whole, "class", _confirmed(rules)), "near-links")
    roots = (
        sets.select("h1", "h2", "node", "doc_id", "tie")
        .join(components(links), "node", "left")
        .withColumn("root", F.coalesce("component", "node"))
    )
    least = roots.groupBy("root").agg(F.min(F.struct("doc_id", "tie")).alias("least"))
    named = roots.join(least, "root").select("h1", "h2", "least")
    found = signed.drop("signature").join(named, ["h1", "h2"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return found.select(
        "doc_id",
        "tie",
        "n_shingles",
        F.when(linked, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.struct("doc_id", "tie") == F.col("least"))
        .otherwise(F.lit(True))
        .alias("kept"),
    )


def drop_near_copies(docs: DataFrame, rules: NearRules = NearRules()) -> DataFrame:
    """``docs`` with one document of each component; see :func:`near_components`.

    Of rows with equal doc_id and text one stays, whatever their other columns say. Rows
    without a doc_id or without words all stay.
    """
    found = stage(near_components(docs, rules), "components")
    kept = found.where("kept").select("doc_id", "tie").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (
        F.xxhash64(F.col("d.text")) == F.col("k.tie")
    )
    out = docs.alias("d").join(kept.alias("k"), same, "left_semi")
    copies = found.where("kept AND doc_id IS NOT NULL AND n_shingles > 0")
    if copies.groupBy("doc_id", "tie").count().where("count > 1").isEmpty():
        return out
    alone = F.col("doc_id").isNull() | (F.trim(F.coalesce("text", F.lit(""))) == "")
    return out.where(alone).unionAll(out.where(~alone).dropDuplicates(["doc_id", "text"]))
