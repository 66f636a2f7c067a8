"""Helpers that the operators share: input tables, tables in the shared folder, checked broadcasts, words as hashes."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only if it was counted and its rows fit this many bytes; larger ones are shuffled.
BROADCAST_BYTES = 16 << 20
# Keys with more than one in so many rows of a table are joined by broadcast.
FREQUENT = 20_000
# Bytes of rows that Spark hands to a Python worker at once. A batch lies in the executor's memory several times: as a growing
# buffer, on its way, and in the worker; with the default of 64 MB that is a large part of an executor for each task.
BATCH_BYTES = 4 << 20
# Entries after which a worker empties its cache of words.
CACHE_WORDS = 400_000


# The folder that holds the package.
_ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> SparkSession:
    """The session, with this package's folder on the search path of workers that run on the same machine.

    Workers of a cluster get the package as any other (--py-files or an installation); there the entry does nothing.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [_ROOT])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where none is set and all tasks run on this machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="clickmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside gets Arrow batches of at most BATCH_BYTES, or a row if that is larger; the option is put back after it."""
    option = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(option)
    spark.conf.set(option, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(option, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with bounded_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, key: str) -> tuple[DataFrame, str]:
    """The frame as a table in buckets of a key, in the shared folder, and the table's name; joins by the key do not shuffle it."""
    spark = df.sparkSession
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, name)
    table_name = path.rsplit("/", 1)[1].replace("-", "_")
    # Dealt out by the key first, so that each bucket is one file.
    writer = df.repartition(number, key).write.format("parquet").option("path", path).option("compression", "zstd")
    with bounded_batches(spark):
        writer.bucketBy(number, key).saveAsTable(table_name)
    return spark.table(table_name), table_name


def drop_table(df: DataFrame, name: str) -> None:
    """Delete a table made by ``bucketed``, with its files."""
    discard(df)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """The frame, marked for broadcast if its counted rows fit BROADCAST_BYTES; otherwise as it is, for a shuffle."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def joined_counted(left: DataFrame, right: DataFrame, keys: list[str], number: str, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has each key once and in ``number`` how many of ``total`` rows have it.

    Keys with more than 1/FREQUENT of the rows, fewer than FREQUENT keys at any size, are broadcast, so no key's rows meet in
    one task; the others are shuffled.
    """
    hot = F.broadcast(right.filter(F.col(number) * FREQUENT > total))
    cold = right.filter(F.col(number) * FREQUENT <= total)
    rare = left.join(F.broadcast(right.filter(F.col(number) * FREQUENT > total).select(*keys)), keys, "left_anti")
    return left.join(hot, keys).unionByName(rare.join(cold, keys))


def sampled(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of the key: the same ones in every run.

    A threshold on the hash, from the number of rows, leaves little more than that before they are sorted in one task.
    """
    number = F.xxhash64(*key)
    share = 1.5 * (rows + 100) / max(df.count(), 1)
    if share < 1:
        df = df.filter(number.cast("double") < F.lit((2 * share - 1) * 2.0**63))
    return df.orderBy(number, *key).limit(rows)


# What operators keep in a worker from task to task. Spark hands a worker the tasks of any operator, one after another.
_KEPT: list = []


def kept(cache):
    """The cache, an object with a length and ``clear``, known to ``claim``."""
    _KEPT.append(cache)
    return cache


def claim(*caches) -> None:
    """Called where a task begins: empty what other operators have left in this worker, all kept caches but these."""
    others = [cache for cache in _KEPT if len(cache) and not any(cache is own for own in caches)]
    for cache in others:
        cache.clear()
    if others:
        give_back()


def give_back() -> None:
    """Return the freed memory of Arrow and of the C library to the system, which a waiting worker would hold on to."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class WordHash(dict):
    """64-bit hashes of byte strings, kept for the words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashes(words: Sequence[bytes], cache: WordHash) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of a well-known hash)."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def windows(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbouring values, in order."""
    count = max(0, len(values) - width + 1)
    total = np.zeros(count, np.uint64)
    for place in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + values[place : place + count]
    return mixed(total + np.uint64(width))
