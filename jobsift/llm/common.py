"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space that ends a word; ``bytes.split()`` without arguments splits at exactly these.
WHITE = b" \t\n\r\x0b\x0c"

#: Spark's switch for removing the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator needs, under fixed names, so that
    further columns of any name cannot clash; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it
    back: cuts the lineage, survives lost executors.  Its shuffles go once it is
    written, not when the driver happens to collect garbage."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, name)}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def longs(batch: pa.RecordBatch, column: str = "doc_id") -> list:
    return batch.column(column).to_pylist()


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string array without nulls."""
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def window_sums(values: np.ndarray, width: int, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit polynomial hash of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    m = np.uint64(multiplier)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = out * m + values[j:j + n]
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``width`` that begins at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(np.asarray(starts) + width, n), -1)
    return np.cumsum(steps[:n]) > 0


#: What Spark hands to a Python worker at once, at most; several copies of it are in memory on both sides.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound on the bytes of an Arrow batch, whose default
    of 64 MB a worker is much where whole rows pass through Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(key, "64m"))
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def zipped(data: bytes) -> bytes:
    """``data`` as a zstandard frame."""
    return pa.Codec("zstd", 3).compress(data, asbytes=True) if data else b""


def unzipped(frame: bytes, size: int) -> pa.Buffer:
    """The ``size`` bytes of which ``zipped`` made ``frame``."""
    return pa.Codec("zstd").decompress(frame, size) if size else pa.py_buffer(b"")


def rebatched(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``max_bytes`` at most (one row at least).

    Arrow keeps what it has freed; between two batches that is given back, as a
    worker lives on after its task and shares the executor's memory.
    """
    for batch in batches:
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
        pa.default_memory_pool().release_unused()
