"""Incremental ingest with Structured Streaming (S4, S13, U1 per batch).

A daily drop folder is read as a file stream with ``trigger(availableNow)``
(process what is there, then stop) and a checkpoint, so each file is
ingested exactly once across runs; processed files are moved to an archive
folder by the source (``cleanSource=archive``).  Each micro-batch is written with
``foreachBatch``: to a folder of its own, so re-running a batch id after a
failure replaces its rows, or merged into a ``BucketedTable``, whose commit names
the batch, so a batch that comes again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import text_schema


def csv_drop_stream(spark: SparkSession, drop_dir: str, columns, archive_dir: str | None = None,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """The files of a drop folder, all with the header ``columns``: a file with
    another one fails the batch, as its values would land in wrong columns.
    Sites with other headers get a folder and a stream of their own."""
    r = (spark.readStream.schema(text_schema(columns)).option("header", True).option("multiLine", True)
         .option("escape", '"').option("enforceSchema", False))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(drop_dir).withColumn("_source_file", F.input_file_name())


def run_available(stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, int], None]) -> None:
    """Process every file currently in the drop folder, then stop."""
    q = (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .foreachBatch(on_batch).start())
    q.awaitTermination()


def append_batches(target_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: append the batch, tagged with its id; a replayed
    batch id first drops its earlier output (idempotent)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("_batch_id", F.lit(batch_id))
        out.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/_batch_id={batch_id}")

    return sink


def latest_by_key_batches(target_path: str, key: str, order: list[str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that keeps only the newest row per key of each
    batch (late/re-crawled rows: newest crawl date wins)."""
    from ..operators.dedupe import latest_per_key

    def sink(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, [key], order)
        latest.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/_batch_id={batch_id}")

    return sink


def merge_batches(table, order: list[str], stream: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink that keeps one row a key in ``table`` (a
    ``BucketedTable``), the newest by ``order`` of all batches: a row that comes
    late does not replace a newer one.  ``stream`` names the query whose batch ids
    these are; a batch up to the one that the table's last commit names is passed over."""
    from ..operators.dedupe import latest_per_key
    from ..operators.tables import BucketedTable

    def sink(batch: DataFrame, batch_id: int) -> None:
        # The batch belongs to the stream's own session.
        mine = BucketedTable(batch.sparkSession, table.root, table.keys, table.buckets, table.schema, table.keep)
        done = mine.merged_batch(stream)
        if done is not None and batch_id <= done:
            return
        newer = F.struct(*[F.col(f"s_{c}") for c in order]) >= F.struct(*[F.col(f"t_{c}") for c in order])
        update = {c: F.when(newer, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")) for c in mine.schema.fieldNames() if c not in mine.keys}
        mine.merge(latest_per_key(batch.select(*mine.schema.fieldNames()), mine.keys, order), update, batch=(stream, batch_id), check_unique=False)

    return sink
