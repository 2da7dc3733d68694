"""Token-id files in document order, coded with the context-mixing range coder (operator 7).

Documents are range-partitioned by id and sorted, so file n holds the ids that
follow those of file n - 1. A file is a Parquet table whose rows are chunks: the
document ids and id counts of whole documents, and one binary payload in the
format of ``mixcoder`` (independently reset, checksummed blocks). A chunk ends
with the document that brings it to ``CHUNK_IDS`` ids, so no document spans two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arenaspark.llm.common import lean, scratch_path, small_side
from arenaspark.llm.mixcoder import pack_chunk, unpack_chunk
from arenaspark.llm.tokens import ids_crc32, public_tokenizer, slices_of, worker_encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
CHUNK_IDS = 4 << 20
BROADCAST_CHUNKS = 200_000


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer_path: str | None = None, end_id: int = END_ID) -> None:
    """Write all ids of ``docs`` in ascending id order (null ids first; equal ids by content hash)."""
    model = tokenizer_path or public_tokenizer(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file_no, chunk_no = worker_encoder(model), TaskContext.get().partitionId(), 0
        keys: list = []
        held: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            counts = [len(x) for x in held]
            return pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int32()), pa.array([chunk_no], pa.int32()), pa.array([total], pa.int64()),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([pack_chunk(np.concatenate(held))], pa.binary())],
                names=["file_no", "chunk_no", "n_ids", "keys", "counts", "payload"])

        for b in batches:
            texts, own = b.column(1), b.column(0).to_pylist()
            for part in slices_of(texts):
                ids, counts = encoder.encode(texts[part])
                at = 0
                for k, n in enumerate(counts.tolist(), part.start):
                    held.append(np.append(ids[at:at + n], np.uint32(end_id)))
                    keys.append(own[k])
                    at, total = at + n, total + n + 1
                    if total >= CHUNK_IDS:
                        yield flush()
                        keys, held, total, chunk_no = [], [], 0, chunk_no + 1
        if held:
            yield flush()

    rows = (docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
            .repartitionByRange("key").sortWithinPartitions("key", F.xxhash64("text")))
    rows.mapInArrow(lean(run, 2048), "file_no int, chunk_no int, n_ids bigint, keys array<bigint>, counts array<bigint>, payload binary"
                    ).write.parquet(path)


def chunk_starts(chunks: DataFrame) -> DataFrame:
    """(file_no, chunk_no, chunk_start): ids before each chunk; one row per file is summed in one task."""
    files = chunks.groupBy("file_no").agg(F.sum("n_ids").alias("ids"))
    past = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file_no", F.coalesce(F.sum("ids").over(past), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file_no").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    return (chunks.select("file_no", "chunk_no", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("before"))
            .join(files, "file_no").select("file_no", "chunk_no", (F.col("file_start") + F.col("before")).alias("chunk_start")))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document of the files under ``path``: id, start, n_tokens, ids_crc32 (and the ids on request)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file_no, chunk_no, keys, counts, payload in zip(*b.columns):
                ids = unpack_chunk(payload.as_py())
                n = np.asarray(counts.values, dtype=np.int64)
                if int(n.sum()) != len(ids):
                    raise ValueError(f"chunk {chunk_no} of file {file_no}: id counts do not fit")
                ends = np.cumsum(n)
                parts = [ids[e - k:e] for e, k in zip(ends.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file_no.as_py()] * len(n), pa.int32()), pa.array([chunk_no.as_py()] * len(n), pa.int32()),
                     keys.values, pa.array(ends - n), pa.array(n), pa.array([ids_crc32(x) for x in parts], pa.int64()),
                     pa.array([x.tolist() if with_ids else None for x in parts], pa.list_(pa.int64()))],
                    names=["file_no", "chunk_no", id_col, "at", "n_tokens", "ids_crc32", "ids"])

    chunks = spark.read.schema("file_no int, chunk_no int, n_ids bigint, keys array<bigint>, counts array<bigint>, "
                               "payload binary").parquet(path)
    docs = chunks.select("file_no", "chunk_no", "keys", "counts", "payload").mapInArrow(
        lean(run, 2048), f"file_no int, chunk_no int, `{id_col}` bigint, at bigint, n_tokens bigint, ids_crc32 bigint, ids array<bigint>")
    starts = small_side(chunk_starts(chunks.select("file_no", "chunk_no", "n_ids")), BROADCAST_CHUNKS)
    return docs.join(starts, ["file_no", "chunk_no"]).select(
        id_col, (F.col("chunk_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
                end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs``, read them back and describe each document.

    Null and empty texts hold the end id alone. Repeated rows and null ids are kept; an empty table gives an
    empty result; other columns are not read."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, id_col, text_col, tokenizer_path, end_id)
    return read_token_files(spark, path, id_col)
