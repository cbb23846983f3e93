"""A corpus made ready for training: judged, deduplicated, decontaminated, redacted, packed.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from starweir.llm import contamination, near, packing, quality, secrets
from starweir.llm.queries import BYTE_END, BYTE_VOCABULARY, SEQUENCE_TOKENS
from starweir.llm.shipping import ship
from starweir.staging import stage


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that pass the quality rules."""
    ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    ship(spark)
    return near.drop_near_copies(docs, near.NearRules(words=5, percent=80, matches=24))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination.drop_contaminated(docs, benchmark)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret."""
    ship(spark)
    return secrets.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, packed into sequences."""
    ship(spark)
    return packing.pack_documents(docs, BYTE_VOCABULARY, BYTE_END, SEQUENCE_TOKENS)


STAGES = [
    ("quality rules", good_texts),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: SQL cannot encode tokens; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *between, last = (function for _, function in STAGES)
    docs = reduce(lambda held, f: stage(f(spark, held, sf_dir), "pipeline"), between, docs)
    return last(spark, docs, sf_dir)
