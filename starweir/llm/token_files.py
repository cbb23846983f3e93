"""Token ids of a corpus in entropy-coded segments, written and read by Spark.

A segment holds whole documents, in the order of their ids, with one frequency table
shared by its blocks. A row of the written table is a segment and can be decoded by
itself; so can every checkpoint of every block in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweir.llm import rans
from starweir.llm.text import batches
from starweir.llm.tokens import encoder

#: A segment is closed when it has so many ids.
SEGMENT_IDS = 2_000_000

_BLOCK = pa.struct(
    [
        ("n", pa.int32()),
        ("words", pa.binary()),
        ("states", pa.binary()),
        ("offsets", pa.list_(pa.int32())),
        ("crc32", pa.int64()),
    ]
)
_SEGMENT = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("symbols", pa.binary()),
        ("frequencies", pa.binary()),
        ("blocks", pa.list_(_BLOCK)),
    ]
)
SEGMENT = """part int, segment int, first long, n_tokens long, doc_ids array<long>,
    doc_tokens array<long>, symbols binary, frequencies binary, blocks array<struct<
    n:int, words:binary, states:binary, offsets:array<int>, crc32:long>>"""
DOCUMENT = "part int, first long, doc_id long, n_tokens long, ids_crc32 long"


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Write the ids of every text, each followed by ``end_id``, in the order of doc_id.

    NULL doc_ids come first, copies of a doc_id in the order of their texts' hashes. A
    NULL text is empty and has the end id only. Other columns are not written. Documents
    are range partitioned, so one doc_id with very many rows is spread as well.
    """

    def segments(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        part = TaskContext.get().partitionId()
        first = number = held = 0
        doc_ids: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal first, number, held
            all_ids = np.concatenate(ids)
            symbols, frequencies = rans.frequency_table(all_ids)
            blocks = rans.encode(all_ids, symbols, frequencies)
            row = {
                "part": part,
                "segment": number,
                "first": first,
                "n_tokens": len(all_ids),
                "doc_ids": [i for a in doc_ids for i in a.to_pylist()],
                "doc_tokens": np.concatenate(lengths).tolist(),
                "symbols": symbols.astype("<u4").tobytes(),
                "frequencies": frequencies.astype("<u4").tobytes(),
                "blocks": [vars(b) for b in blocks],
            }
            first, number, held = first + len(all_ids), number + 1, 0
            for kept in (doc_ids, lengths, ids):
                kept.clear()
            return pa.RecordBatch.from_pylist([row], _SEGMENT)

        for batch in batches(parts, size=4 << 20):
            own, bounds = encode(batch.column("text"))
            own = np.insert(own, bounds[1:], end_id).astype(np.uint32)
            doc_ids.append(batch.column("doc_id"))
            lengths.append(np.diff(bounds) + 1)
            ids.append(own)
            held += len(own)
            if held >= SEGMENT_IDS:
                yield close()
        if ids:
            yield close()

    (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
        .mapInArrow(segments, SEGMENT)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_documents(written: DataFrame) -> DataFrame:
    """Every document of a written table: its place in the whole and a checksum of its ids.

    ``start`` is the number of ids of all documents before it. Blocks whose ids do not
    have their checksum are an error.
    """

    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in batch.to_pylist():
                ids = read_segment(row)
                ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
                starts = ends - np.array(row["doc_tokens"], np.int64)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crcs = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(ends), pa.int32()),
                        pa.array(starts + row["first"]),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends - starts),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "first", "doc_id", "n_tokens", "ids_crc32"],
                )

    # One row per range partition.
    sizes = written.groupBy("part").agg(F.sum("n_tokens").alias("n")).toArrow().sort_by("part")
    ends = np.cumsum(sizes["n"].to_numpy()) if len(sizes) else np.zeros(0, np.int64)
    before = pa.table(
        {
            "part": sizes["part"].cast(pa.int32()),
            "before": pa.array(ends - sizes["n"].to_numpy(), pa.int64()),
        }
    )
    offsets = written.sparkSession.createDataFrame(before)
    return (
        written.mapInArrow(documents, DOCUMENT)
        .join(F.broadcast(offsets), "part")
        .select(
            "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
        )
    )


def read_segment(row: dict) -> np.ndarray:
    """The ids of one row of a written table."""
    return rans.decode(
        [rans.Block(**b) for b in row["blocks"]],
        np.frombuffer(row["symbols"], "<u4"),
        np.frombuffer(row["frequencies"], "<u4"),
    )
