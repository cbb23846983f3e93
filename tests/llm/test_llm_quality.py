"""Verdicts on quality and toxicity against labels, and at different sizes of corpus."""

import os

import pytest
from pyspark.sql import functions as F

from starweir.llm import quality
from starweir.llm.shipping import ship


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    ship(spark)
    folder = f"{os.path.dirname(sf_dir)}/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return docs.select("doc_id", "text"), labels


def test_recall_and_loss_by_labels(corpus):
    docs, labels = corpus
    judged = quality.judge_quality(docs, labels).where("NOT quality.base_failed").join(labels.withColumnRenamed("quality", "label"), "doc_id")
    kept = {
        (r.label, r.toxic): r.kept
        for r in judged.groupBy("label", "toxic").agg(F.avg(F.col("quality.kept").cast("int")).alias("kept")).collect()
    }
    assert kept[1, 0] >= 0.98
    assert kept[0, 0] <= 0.05
    # One in five here; a half at ten times the size and more, where more sightings are trusted.
    assert kept[1, 1] <= 0.85


def test_verdicts_do_not_depend_on_the_size_of_the_corpus(corpus):
    docs, labels = corpus
    copies = docs.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9))))
    many = copies.select((F.col("doc_id") + F.col("copy").cast("long") * 1_000_000_000).alias("doc_id"), "text")
    one = quality.judge_quality(docs, labels).select("doc_id", "quality.kept")
    ten = quality.judge_quality(many, labels).where("doc_id < 1000000000").select("doc_id", "quality.kept")
    assert one.exceptAll(ten).count() == 0


def test_one_window_of_avoided_words_is_enough(spark):
    ship(spark)
    plain = "the day was long and the road was dry so we went home by the river in the end "
    docs = [(i, plain * 5 + f"number{i}") for i in range(40)]
    docs += [(100 + i, plain * 3 + "awful nasty rotten words " * 2 + plain * 3 + f"number{i}") for i in range(40)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    rules = quality.QualityRules(most_repeated_percent=100)
    df = spark.createDataFrame([*docs, (None, None), (None, ""), (500, "short")], "doc_id long, text string")
    out = {r.doc_id: r.quality for r in quality.judge_quality(df, labels, rules).collect()}
    assert all(out[i].kept for i in range(40))
    assert not any(out[100 + i].kept for i in range(40))
    assert out[None].worst == 0.0 and not out[None].kept and not out[500].kept
