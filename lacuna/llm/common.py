"""What the training-data operators share: shared storage, byte-level words, hashing."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Separators of the byte-level word definition: every byte that is not 0-9, A-Z, a-z or >= 0x80.
WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words as UTF-8 bytes; None has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX2
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: What drops an operator's cache in this Python worker, by the operator's name.
HELD: dict[str, Callable[[], None]] = {}


def tidy(name: str | None = None) -> None:
    """At the start of a task of operator name: Python workers serve many stages, and what other operators left goes."""
    for other, drop in HELD.items():
        if other != name:
            drop()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def tidied(rows):
    """rows(batches) as a task that is tidy before and after: an idle Python worker gives back what the task had."""

    def run(batches):
        tidy()
        try:
            yield from rows(batches)
        finally:
            tidy()

    return run


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Arrow batches of whole texts and packed rows are kept small, unless the session has a size of its own; Parquet's parallel reads, which hold buffers beside the heap, are off unless the session names them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default
        spark.conf.set(key, str(rows))
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", str(size)), ("parquet.hadoop.vectored.io.enabled", "false")):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, as in tests, one of our own if all run on this machine; a cluster has to name one."""
    small_batches(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "lacuna-shared")
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/lacuna/{name}-{uuid.uuid4().hex}"


#: The folders of this driver's written tables.
WRITTEN: set[str] = set()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors. It stays until discard() or discard_all()."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    WRITTEN.add(path)
    return out


def discard(table: DataFrame) -> None:
    """Deletes what written() wrote, once nothing that is still to run reads it."""
    path = table.__dict__.get("written_to")
    if path:
        _delete(table.sparkSession, path)
        WRITTEN.discard(path)


def discard_all(spark: SparkSession) -> None:
    """Deletes all tables that this driver wrote: for callers whose results are stored. Results that weren't can't be computed any more."""
    for path in [*WRITTEN]:
        _delete(spark, path)
    WRITTEN.clear()


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def filesystem(url: str):
    """pyarrow's file system and path for a folder's URL, so that file, s3, gs and hdfs all work."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(url if "://" in url else "file://" + os.path.abspath(url))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, limit: int) -> bool:
    """Whether df has at most limit rows: the check that goes before a broadcast."""
    return df.limit(limit + 1).count() <= limit


def maybe_broadcast(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if small(df, limit) else df
