"""Token ids of documents in ORC files that are read in parallel by stripe and pruned by their metadata.

A file holds its documents in ascending doc_id order. Whole numbers are run-length encoded by the format itself; every
stripe has row indexes and a Bloom filter on doc_id, so a reader that asks for some documents skips the other stripes
and row groups.

Defined results: a null text counts as empty (only the end id); a null doc_id sorts before all others; rows of one doc_id
are documents of their own, side by side, in the order of a hash of their texts; an empty table gives no rows; further columns are ignored. Texts may have
any length, as a document is one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.llm.common import new_path
from clickmill.llm.tokens import encoder, portions, text_bytes

ROW_INDEX_STRIDE = 1_000
STRIPE_BYTES = 8 << 20
BLOOM_FALSE_POSITIVES = 0.01

_FILE_COLUMNS = "doc_id bigint, n_tokens bigint, local_start bigint, task int, ids array<int>"


def _tokenised(path: str, end_id: int):
    """Rows of a task: the ids of each document, how many ids come before it in the same task, and the task's number.

    Task numbers ascend with the doc_ids, and stay the same if a task runs again or writes several files.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path, spaced=False)
        task, before = TaskContext.get().partitionId(), 0
        for batch in portions(batches):
            ids = [one + end for one in codes.encode(text_bytes(batch.column(1)))]
            ends = np.cumsum([0] + [len(one) // 4 for one in ids])
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
            )
            tasks = pa.array(np.full(len(ids), task, np.int32))
            columns = [batch.column(0), pa.array(np.diff(ends)), pa.array(ends[:-1] + before), tasks, lists]
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "local_start", "task", "ids"])

    return encode


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> None:
    """Write the ids of doc_id, text to ``folder``, in ascending doc_ids from task to task and within each.

    Rows are dealt out by doc_id, then by their texts' hash and row number, so that many rows of one doc_id, or copies of one
    row, are shared by several tasks.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", "digest", "row"]
    numbered = texts.withColumns({"digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    (
        ordered.select("doc_id", "text").mapInArrow(_tokenised(tokenizer, end_id), _FILE_COLUMNS)
        .write.option("compression", "zstd")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FALSE_POSITIVES)
        .orc(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_tokens, local_start, task, ids, file: what the files hold; filters on doc_id reach the file metadata."""
    return spark.read.schema(_FILE_COLUMNS).orc(folder).select("*", F.col("_metadata.file_name").alias("file"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        sums = [zlib.crc32(values[a:b].astype("<u4")) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        columns = [batch.column(0), batch.column(1), pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, batch.column(3)], ["doc_id", "local_start", "n_tokens", "ids_crc32", "task"])


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files.

    The offset of a task is the number of ids in the tasks before it. Those totals are read from the number columns alone, one
    row per task that wrote.
    """
    held = read_token_files(spark, folder)
    totals = held.groupBy("task").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("total"))
    # Unpartitioned on purpose: one row per task.
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("task", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    rows = held.select("doc_id", "local_start", "ids", "task").mapInArrow(
        _checksums, "doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint, task int"
    )
    start = (F.col("local_start") + F.col("offset")).alias("start")
    return rows.join(offsets, "task").select("doc_id", start, "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the documents' ids, read them back, and return the digest of what was read."""
    folder = folder or new_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)
    return file_digests(docs.sparkSession, folder)
