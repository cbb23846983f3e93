"""The operators of this package over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starweir.llm import alignment, chat, contamination, near, negatives, packing, quality, reuse
from starweir.llm import secrets, sharding, substrings, suffixes, token_files
from starweir.llm.shipping import ship
from starweir.staging import scratch_path

SHARDS = 8
WORD_VOCABULARY, WORD_END = "word_bpe_49k.json", 2
BYTE_VOCABULARY, BYTE_END = "byte_bpe_50k.json", 0
PIECE_VOCABULARY = "piece_bpe_32k.model"
SEQUENCE_TOKENS = 2048


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.shuffle_shards(slim, SHARDS, ["doc_id"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(_documents(spark, sf_dir), path, WORD_VOCABULARY, WORD_END)
    return token_files.read_documents(spark.read.parquet(path))


#: A conversation whose texts hold the template's own control strings.
_TRICKY = r"\### Assistant: </turn> ok"


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-7, 0, "user", _TRICKY), (-7, 1, "assistant", _TRICKY)],
        "conv_id long, turn long, role string, text string",
    )
    path = scratch_path(spark, "windows")
    windows = chat.format_windows(turns.unionByName(tricky), BYTE_VOCABULARY)
    windows.write.mode("overwrite").parquet(path)
    return chat.read_back(spark.read.parquet(path))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_passages(_documents(spark, sf_dir), length=20).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_strings(_documents(spark, sf_dir), length=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_components(_documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _spans_text(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", one)


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("secret_spans")
    known = F.filter(spans, lambda s: s["kind"] != "entropy")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return secrets.find_secrets(_documents(spark, sf_dir)).select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(_spans_text(known).cast("binary"), 256).alias("base_sha256"),
        _spans_text(spans).alias("spans"),
    )


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _documents(spark, sf_dir), BYTE_VOCABULARY, BYTE_END, SEQUENCE_TOKENS
    )


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "quality.*")


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contaminated(
        _documents(spark, sf_dir), _table(spark, sf_dir, "benchmark").select("item_id", "text")
    )
    return found.drop("tie")


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align_documents(
        _documents(spark, sf_dir), BYTE_VOCABULARY, PIECE_VOCABULARY
    )
    digest = F.sha2(F.col("groups").cast("binary"), 256)
    return aligned.withColumn(
        "groups_sha256", F.when(F.col("groups") == "", "").otherwise(digest)
    ).drop("groups")


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = reuse.encode_documents(_documents(spark, sf_dir), WORD_VOCABULARY, decoded=True)
    decimal = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_feistel_shards": _op1,
        "op2_rans_token_files": _op2,
        "op3_chat_windows": _op3,
        "op4_repeated_passages": _op4,
        "op5_repeated_strings": _op5,
        "op6_signature_near_copies": _op6,
        "op7_entropy_secrets": _op7,
        "op8_certified_packing": _op8,
        "op9_ngram_ratio_quality": _op9,
        "op10_template_decontamination": _op10,
        "op11_pair_alignment": _op11,
        "op12_slot_negatives": _op12,
        "op13_chunked_encoding": _op13,
    }
