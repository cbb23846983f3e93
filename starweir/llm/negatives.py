"""Hard negatives: for each anchor and positive, the nearest rows of other labels below it.

The scores of an anchor's positives are the upper limits of slots: slot j takes the scores
up to the j-th limit and above the next one. Every row falls in one slot at most, so one
pass keeps the best rows of each slot, and the best rows below any limit are read off the
slots from its own one down. No window is searched by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starweir.staging import stage

#: Stands for a NULL id, which comes after all others.
NO_ID = np.iinfo(np.int64).max
#: Rows scored at once against anchors.
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 256
#: Largest size of a component, so that a score fits in 64 bits.
LARGEST = 1 << 24


@dataclass(frozen=True)
class NegativeRules:
    positives: int = 5
    negatives: int = 5
    #: A negative's score is so many hundredths of the positive's at least.
    percent: int = 80
    scale: int = 256
    #: Every ``anchor_step``-th id is an anchor.
    anchor_step: int = 100
    #: Bytes of anchors sent to every task at once; more anchors take more passes.
    anchor_bytes: int = 32 << 20


@dataclass
class Rows:
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def take(self, at) -> Rows:
        return Rows(self.ids[at], self.labels[at], self.vectors[at])


def _numbers(column: pa.Array, empty: int) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(empty).to_numpy(zero_copy_only=False)


def rows_of(batch: pa.RecordBatch, scale: int) -> Iterator[Rows]:
    """The rows that take part, one piece for each length of vector, in the order of ids."""
    vectors = batch.column("embedding")
    lengths = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, np.int64)
    flat = vectors.flatten().cast(pa.float64())
    # flatten() leaves the values of NULL vectors out, offsets may not.
    lengths = np.where(vectors.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    values = np.floor(scale * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
    starts = np.cumsum(lengths) - lengths
    ids = _numbers(batch.column("vec_id"), NO_ID)
    labels = _numbers(batch.column("label"), 0)
    present = ~batch.column("label").is_null().to_numpy(zero_copy_only=False)
    labels = np.where((ids % 7 == 0) & (ids != NO_ID), np.fmod(labels + 1, 10), labels)
    for length in np.unique(lengths[present & (lengths > 0)]):
        at = np.flatnonzero(present & (lengths == length))
        at = at[np.argsort(ids[at], kind="stable")]
        for few in np.array_split(at, max(1, -(-len(at) // BLOCK_ROWS))):
            block = values[starts[few][:, None] + np.arange(length)]
            good = (np.abs(block) <= LARGEST).all(axis=1)  # not so for NaN
            if good.any():
                yield Rows(ids[few][good], labels[few][good], block[good])


def scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    largest = float(np.abs(anchors).max(initial=0) * np.abs(vectors).max(initial=0))
    if largest * anchors.shape[1] < 2.0**53:
        return (anchors @ vectors.T).astype(np.int64)
    return anchors.astype(np.int64) @ vectors.astype(np.int64).T


@dataclass
class Best:
    """The best ``k`` rows for each group of numbers, found so far."""

    k: int
    groups: int

    def __post_init__(self) -> None:
        none = np.zeros(0, np.int64)
        self.group, self.score, self.id = none, none, none
        #: Scores below are beaten by k rows already.
        self.least = np.full(self.groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        able = score >= self.least[group]
        if not able.any():
            return
        group = np.concatenate([self.group, group[able]])
        score = np.concatenate([self.score, score[able]])
        ids = np.concatenate([self.id, ids[able]])
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        kept = place < self.k
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]
        full = place == self.k - 1
        self.least[group[full]] = score[full]


def _anchors(rows: DataFrame, rules: NegativeRules) -> DataFrame:
    """(anchor, vec_id, label, vector, copies): different anchors, numbered."""
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in rows_of(batch, rules.scale):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.ids), pa.array(own.labels), pa.array(list(own.vectors.astype("i8")))],
                    ["vec_id", "label", "vector"],
                )

    chosen = rows.where(F.col("vec_id") % rules.anchor_step == 0)
    return stage(
        chosen.mapInArrow(blocks, "vec_id long, label long, vector array<long>")
        .groupBy("vec_id", "label", "vector")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("anchor", F.monotonically_increasing_id()),
        "anchors",
    )


def _best(
    rows: DataFrame, anchors: DataFrame, rules: NegativeRules, passes: int, limits: DataFrame | None
) -> DataFrame:
    """(anchor, slot, score, vec_id): in each slot the best rows of each task.

    Without ``limits`` there is one slot, for the rows of the anchor's own label. With them,
    (anchor, limits) from the highest down, slots are for the rows of other labels.
    """
    spark = rows.sparkSession
    schema = "anchor long, slot int, score long, vec_id long"
    parts = []
    held = anchors if limits is None else anchors.join(limits, "anchor")
    for number in range(passes):
        own = held.where(F.pmod(F.xxhash64("anchor"), F.lit(passes)) == number).toArrow()
        if not len(own):
            continue
        sent = spark.sparkContext.broadcast(packed_anchors(own, rules))
        parts.append(rows.mapInArrow(_scorer(sent, rules, limits is None), schema))
    if not parts:
        return spark.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found


def packed_anchors(table: pa.Table, rules: NegativeRules) -> list[tuple]:
    """Blocks of anchors whose vectors are equally long: numbers, labels, vectors and limits."""
    vectors = [np.array(v, np.float64) for v in table["vector"].to_pylist()]
    lengths = np.array([len(v) for v in vectors])
    numbers = table["anchor"].to_numpy()
    labels = table["label"].to_numpy()
    limits = np.full((len(vectors), rules.positives), np.iinfo(np.int64).min)
    if "limits" in table.column_names:
        for row, own in zip(limits, table["limits"].to_pylist()):
            row[: len(own)] = own
    out = []
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        for few in np.array_split(at, -(-len(at) // BLOCK_ANCHORS)):
            out.append((numbers[few], labels[few], np.stack([vectors[i] for i in few]), limits[few]))
    return out


def _scorer(sent, rules: NegativeRules, same_label: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from score_batches(batches, sent.value, rules, same_label)

    return run


def score_batches(batches, blocks, rules: NegativeRules, same_label: bool):
    slots = 1 if same_label else rules.positives
    # One more for the anchor, which is a row like others here.
    k = rules.positives + 1 if same_label else rules.negatives
    bests = [Best(k, len(numbers) * slots) for numbers, *_ in blocks]
    for batch in batches:
        for rows in rows_of(batch, rules.scale):
            for best, (_, labels, vectors, limits) in zip(bests, blocks):
                if vectors.shape[1] != rows.vectors.shape[1]:
                    continue
                found = scores(vectors, rows.vectors)
                same = labels[:, None] == rows.labels[None, :]
                if same_label:
                    able = same & (found >= best.least[:, None])
                    anchor, row = np.nonzero(able)
                    best.add(anchor, found[anchor, row], rows.ids[row])
                    continue
                # No window is open below the lowest one's lower limit, nor for a negative score.
                lowest = np.where(limits < 0, np.iinfo(np.int64).max, limits).min(axis=1)
                floor = rules.percent / 100 * lowest.astype(float) * (1 - 1e-12)
                able = ~same & (found <= limits[:, :1]) & (found >= floor[:, None])
                anchor, row = np.nonzero(able)
                score = found[anchor, row]
                slot = (score[:, None] <= limits[anchor]).sum(axis=1) - 1
                best.add(anchor * slots + slot, score, rows.ids[row])
    for best, (numbers, *_) in zip(bests, blocks):
        ids = pa.array(best.id, mask=best.id == NO_ID)
        columns = [
            pa.array(numbers[best.group // slots]),
            pa.array((best.group % slots).astype(np.int32)),
            pa.array(best.score),
            ids,
        ]
        yield pa.RecordBatch.from_arrays(columns, ["anchor", "slot", "score", "vec_id"])


def hard_negatives(embeddings: DataFrame, rules: NegativeRules = NegativeRules()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``embeddings`` has vec_id, embedding and label; other columns are not read. Components
    become floor(scale * x), and a score is the inner product of two such vectors, exactly.
    Anchors are the rows whose id is divisible by ``anchor_step``. An anchor's positives are
    its best other rows of the same label. For each, the best rows of other labels come
    whose score is at most the positive's and ``percent`` hundredths of it at least; a
    positive with a negative score has none. Equal scores go by the smaller id.

    Rows with a NULL label, a NULL or empty vector, or a component that is NULL, not finite
    or beyond 2**24 after scaling take no part. Vectors of different lengths have no score.
    A NULL id is never an anchor and comes last among equal scores; 2**63 - 1 is taken for
    NULL. Repeated rows are rows of their own: a copy of an anchor is one of its positives,
    and repeats the anchor's result. Empty tables give no rows.

    Every row meets every anchor, a block against a block. Anchors go to the tasks in
    passes of at most ``anchor_bytes``; a task keeps the best rows only, whatever it reads.
    """
    rows = embeddings.select("vec_id", "embedding", "label")
    anchors = _anchors(rows, rules)
    size = anchors.agg(F.sum(8 * F.size("vector") + 8 * rules.positives + 24)).first()[0] or 0
    passes = max(1, -(-int(size) // rules.anchor_bytes))
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]

    def ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

    # The anchor itself has its id and its score with itself; rows like that are alike.
    own = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x)
    near = ranked(_best(rows, anchors, rules, passes, None), ["anchor"], "place").where(
        F.col("place") <= rules.positives + 1
    )
    near = near.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id"), own.alias("own")), "anchor")
    itself = (F.col("vec_id") == F.col("anchor_id")) & (F.col("score") == F.col("own"))
    selfless = Window.partitionBy("anchor").orderBy("place")
    itself_at = F.min(F.when(F.coalesce(itself, F.lit(False)), F.col("place"))).over(Window.partitionBy("anchor"))
    positives = stage(
        near.withColumn("itself_at", itself_at)
        .where("itself_at IS NULL OR place <> itself_at")
        .withColumn("place", F.row_number().over(selfless))
        .where(F.col("place") <= rules.positives)
        .select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    limits = positives.where("positive_score >= 0").groupBy("anchor").agg(
        F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits")
    )
    in_slots = ranked(
        _best(rows, anchors, rules, passes, limits), ["anchor", "slot"], "place"
    ).where(F.col("place") <= rules.negatives)
    # At most positives * negatives rows an anchor, from the highest score down.
    suffixes = in_slots.groupBy("anchor").agg(
        F.sort_array(
            F.collect_list(
                F.struct("slot", "place", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            )
        ).alias("slots")
    )

    def wide(score: Column) -> Column:
        return score.cast("decimal(20,0)")

    below = F.filter(
        "slots",
        lambda s: (s["slot"] >= F.array_position("limits", F.col("positive_score")) - 1)
        & (wide(s["negative_score"]) * 100 >= wide(F.col("positive_score")) * rules.percent),
    )
    return (
        positives.where("positive_score >= 0")
        .join(limits, "anchor")
        .join(suffixes, "anchor")
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id"), "copies"), "anchor")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(below, 1, rules.negatives)).alias("at", "n"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("at") + 1).alias("rank"),
            "n.negative_id",
            "positive_score",
            "n.negative_score",
        )
    )
