"""Rules for text quality: counts over each text, and how much its n-grams look like
trusted text rather than like the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm.text import (
    WORD_BASES,
    Words,
    batches,
    chunks,
    mix,
    prefix_hashes,
    ranges,
    string_hashes,
    utf8,
    window_hashes,
    words_of,
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

REPEAT_WINDOW = 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class QualityRules:
    #: Buckets of the hashed n-grams; the tables that reach driver and tasks have this size.
    bucket_bits: int = 18
    #: Sightings in trusted text added to both sides of a ratio: an n-gram that trusted text
    #: should have so often, but has not, counts half. The same at every size of corpus.
    smoothing: float = 4.0
    #: At most so many trusted texts are used, those with the least hashes of their ids.
    trusted_rows: int = 20_000
    #: Mean log-likelihood ratio per n-gram from which a text is kept.
    threshold: float = -0.1
    #: Mean ratio of the words of the worst window of so many words, from which it is kept.
    window: int = 16
    window_threshold: float = -0.25
    least_words: int = 50
    most_repeated_percent: int = 50


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` from first[i] to first[i + 1]."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _windows(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows that lie in one text, and the first word of each."""
    windows = window_hashes(hashes, length, WORD_BASES[0])
    own = np.diff(words.first)
    starts = ranges(words.first[:-1], np.maximum(own - length + 1, 0))
    return windows[starts], starts


def _repeated(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Words in windows that their text has twice or more."""
    n = len(hashes)
    windows, starts = _windows(words, hashes, REPEAT_WINDOW)
    row = np.searchsorted(words.first, starts, "right")
    keyed = mix(windows + row.astype(np.uint64) * WORD_BASES[1])
    order = np.argsort(keyed, kind="stable")
    same = keyed[order][1:] == keyed[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + REPEAT_WINDOW, np.int64)
    at = starts[twice]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + REPEAT_WINDOW, -1)
    return _sums(np.cumsum(covered)[:n] > 0, words.first)


def _repeated_lines(data: np.ndarray, bounds: np.ndarray, words: Words, sums: np.ndarray):
    """Lines with a word that equal an earlier line of their text."""
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([bounds[1:], breaks]), kind="stable")
    # The break at a text's end comes before the text's own end, which is the last line's.
    row = np.searchsorted(bounds[1:], starts, "right")
    kept = (np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)) & (
        ends > starts
    )
    starts, ends, row = starts[kept], ends[kept], row[kept]
    lines = string_hashes(data, sums, starts, ends)
    keyed = mix(lines + row.astype(np.uint64) * WORD_BASES[1])
    _, first = np.unique(keyed, return_index=True)
    again = np.ones(len(keyed), bool)
    again[first] = False
    return np.bincount(row[again], minlength=len(bounds) - 1)


def count_chunk(data: np.ndarray, bounds: np.ndarray) -> tuple[dict, Words, np.ndarray]:
    """The counts of each text, its words and their hashes."""
    words = words_of(data, bounds)
    sums = prefix_hashes(data)
    hashes = string_hashes(data, sums, words.starts, words.ends)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    counts = {
        "n_words": np.diff(words.first),
        "word_chars": _sums(points[words.ends] - points[words.starts], words.first),
        "n_symbols": _sums(_SYMBOL[data], bounds),
        "n_dup_lines": _repeated_lines(data, bounds, words, sums),
        "n_repeat_words": _repeated(words, hashes),
    }
    return counts, words, hashes


def ngram_buckets(words: Words, hashes: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the words and of the pairs of words, and the word at which each starts."""
    shift = np.uint64(64 - bits)
    pairs, starts = _windows(words, hashes, 2)
    singles = (mix(hashes) >> shift).astype(np.int64)
    return [
        (singles, np.arange(len(hashes))),
        ((mix(pairs + np.uint64(1)) >> shift).astype(np.int64), starts),
    ]


def count_ngrams(
    docs: DataFrame, trusted: np.ndarray, rules: QualityRules
) -> tuple[np.ndarray, np.ndarray]:
    """Counts of every bucket over all texts, and over those whose doc_id is trusted.

    Each task adds up its own texts before anything is shuffled.
    """
    bits, size = rules.bucket_bits, 1 << rules.bucket_bits
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(trusted)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, size), np.int64)
        for batch in batches(parts):
            data, bounds = utf8(batch.column("text"))
            ids = np.asarray(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
            ids_known = np.isin(ids, known.value) & np.asarray(
                batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            )
            for at, end in chunks(bounds):
                piece = data[bounds[at] : bounds[end]]
                words = words_of(piece, bounds[at : end + 1] - bounds[at])
                good = np.repeat(ids_known[at:end], np.diff(words.first))
                for buckets, starts in ngram_buckets(words, words.hashes(), bits):
                    both[0] += np.bincount(buckets, minlength=size)
                    both[1] += np.bincount(buckets[good[starts]], minlength=size)
        (used,) = np.nonzero(both[0])
        for at in range(0, len(used), 1 << 15):
            part = used[at : at + (1 << 15)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(both[0][part]), pa.array(both[1][part])],
                ["bucket", "corpus", "trusted"],
            )

    found = (
        docs.select("doc_id", "text")
        .mapInArrow(count, "bucket long, corpus long, trusted long")
        .groupBy("bucket")
        .agg(F.sum("corpus").alias("corpus"), F.sum("trusted").alias("trusted"))
        .toArrow()
    )
    at = found["bucket"].to_numpy()
    corpus, trust = np.zeros(size), np.zeros(size)
    corpus[at] = found["corpus"].to_numpy()
    trust[at] = found["trusted"].to_numpy()
    return corpus, trust


def log_ratios(corpus: np.ndarray, trusted: np.ndarray, smoothing: float) -> np.ndarray:
    """log(p trusted / p corpus) of each bucket, as sightings in trusted text against those
    to be expected there, both smoothed, so that what is rare says little."""
    if not trusted.sum():
        return np.zeros(len(corpus), np.float32)
    expected = corpus * (trusted.sum() / corpus.sum())
    return np.log((trusted + smoothing) / (expected + smoothing)).astype(np.float32)


def trusted_ids(labels: DataFrame, rows: int) -> np.ndarray:
    """doc_ids labelled good and not toxic, ``rows`` at most, by the hash of the id."""
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
    chosen = good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return np.sort(chosen.toArrow()["doc_id"].to_numpy())


def fit_ratios(docs: DataFrame, labels: DataFrame, rules: QualityRules) -> np.ndarray:
    return log_ratios(
        *count_ngrams(docs, trusted_ids(labels, rules.trusted_rows), rules), rules.smoothing
    )


def score_chunk(words: Words, hashes: np.ndarray, ratios: np.ndarray, bits: int) -> np.ndarray:
    """Mean log-likelihood ratio of each text's n-grams; 0 for a text without words."""
    total = np.zeros(len(words.first) - 1)
    number = np.zeros(len(words.first) - 1)
    for buckets, starts in ngram_buckets(words, hashes, bits):
        first = np.searchsorted(starts, words.first)
        total += _sums(ratios[buckets].astype(np.float64), first)
        number += np.diff(first)
    return total / np.maximum(number, 1)


def worst_windows(
    words: Words, hashes: np.ndarray, ratios: np.ndarray, bits: int, length: int
) -> np.ndarray:
    """The least mean log-likelihood ratio of ``length`` consecutive words of each text; 0
    for a text with fewer words. A few words that trusted text avoids stand out in it."""
    (buckets, _), _ = ngram_buckets(words, hashes, bits)
    total = np.zeros(len(buckets) + 1)
    np.cumsum(ratios[buckets].astype(np.float64), out=total[1:])
    number = np.maximum(np.diff(words.first) - length + 1, 0)
    starts = ranges(words.first[:-1], number)
    out = np.zeros(len(number))
    if len(starts):
        means = (total[starts + length] - total[starts]) / length
        some = number > 0
        out[some] = np.minimum.reduceat(means, (np.cumsum(number) - number)[some])
    return out


_SCHEMA = ", ".join(f"{name}: long" for name in COUNTS)
RESULT = f"struct<{_SCHEMA.replace(': ', ':')}, score:double, worst:double, base_failed:boolean, kept:boolean>"


def quality_column(ratios: np.ndarray, rules: QualityRules, spark):
    """A column expression: the counts, the score and the verdict for a text."""
    table = spark.sparkContext.broadcast(ratios)

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        data, bounds = utf8(texts)
        found: list[dict[str, np.ndarray]] = []
        for at, end in chunks(bounds):
            piece = data[bounds[at] : bounds[end]]
            counts, words, hashes = count_chunk(piece, bounds[at : end + 1] - bounds[at])
            known = (words, hashes, table.value, rules.bucket_bits)
            counts["score"], counts["worst"] = score_chunk(*known), worst_windows(*known, rules.window)
            found.append(counts)
        none = np.zeros(0, np.int64)
        out = {c: np.concatenate([none, *(f[c] for f in found)]) for c in COUNTS}
        for c in ("score", "worst"):
            out[c] = np.concatenate([none.astype(float), *(f[c] for f in found)])
        out["base_failed"] = (out["n_words"] < rules.least_words) | (
            100 * out["n_repeat_words"] > rules.most_repeated_percent * out["n_words"]
        )
        out["kept"] = (
            ~out["base_failed"]
            & (out["score"] >= rules.threshold)
            & (out["worst"] >= rules.window_threshold)
        )
        return pa.StructArray.from_arrays(list(map(pa.array, out.values())), list(out))

    return judge


def judge_quality(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()):
    """``docs`` with a column ``quality``: counts, ``score``, ``worst``, ``base_failed`` and
    ``kept``.

    The n-grams (words and pairs of words) of all texts are counted in hashed buckets, and
    those of the trusted texts too. A text's score is the mean log ratio of its n-grams'
    shares in trusted text and in the corpus, ``worst`` the least mean of the words of one
    window. It fails with too few or too many repeated words; else score and worst window
    decide, each against a fixed threshold.

    A NULL or empty text has no words, score 0, and fails. Rows with a NULL doc_id are
    judged, but never trusted. Copies of a doc_id are each judged. Without trusted texts
    every score is 0. ``quality`` replaces a column of that name.
    """
    ratios = fit_ratios(docs, labels, rules)
    judge = quality_column(ratios, rules, docs.sparkSession)
    return docs.withColumn("quality", judge("text"))


def keep_good(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()):
    """The rows of ``docs`` whose text is kept; see :func:`judge_quality`."""
    ratios = fit_ratios(docs, labels, rules)
    return docs.where(quality_column(ratios, rules, docs.sparkSession)("text")["kept"])
