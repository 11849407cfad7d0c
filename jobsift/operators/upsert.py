"""MERGE-style upsert as a join rewrite.

Parquet tables cannot ``MERGE INTO``; the new version of the target is
computed as one full outer join on the key and written as a new table
version.  Both sides are hash-partitioned on the key by the join; when the
target is stored bucketed on the key its side needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "MergeAction"


class DuplicateSourceKey(RuntimeError):
    """More than one source row matches one target row (T-SQL MERGE error)."""


class BucketCountMismatch(ValueError):
    """A bucketed table is merged with another number of buckets."""


def check_unique_source(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a target row would be matched by several source rows.

    First one aggregate over the batch's keys (map-side combined); the
    target is consulted only when the batch does hold duplicate keys (the
    usual batch is already one row per key), and then only for those keys
    through a semi join.  At most one offending key reaches the driver.
    """
    nn = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    dups = source.filter(nn).groupBy(*keys).count().filter("count > 1").drop("count")
    if dups.isEmpty():
        return
    hit = target.select(*keys).join(dups, on=list(keys), how="left_semi").limit(1).collect()
    if hit:
        raise DuplicateSourceKey(f"source rows share key {hit[0].asDict()} that matches a target row")


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
          update: Mapping[str, Column | str] | None = None,
          insert: Mapping[str, Column | str] | None = None,
          check_unique: bool = True) -> DataFrame:
    """Return the merged target with a ``MergeAction`` column.

    ``update``/``insert`` map target columns to source expressions (a source
    column name or a Column over ``src.*``/``tgt.*``).  Matched rows take the
    ``update`` values (other columns keep the target's), source-only rows
    are inserted with the ``insert`` values (other columns NULL),
    target-only rows are kept.  Keys compare with SQL ``=``: NULL keys never
    match, so NULL-key source rows are always inserted.
    """
    cols = target.columns
    update = dict(update if update is not None else {c: c for c in cols if c in source.columns})
    insert = dict(insert if insert is not None else {c: c for c in cols if c in source.columns})
    if check_unique:
        check_unique_source(target, source, keys)
    tgt = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    src = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    cond = None
    for k in keys:
        term = F.col(f"t_{k}") == F.col(f"s_{k}")
        cond = term if cond is None else cond & term
    j = tgt.join(src, cond, "full_outer")

    def resolve(e: Column | str) -> Column:
        return F.col(f"s_{e}") if isinstance(e, str) else e

    matched = F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    src_only = F.col("_in_t").isNull()
    out = []
    for c in cols:
        keep = F.col(f"t_{c}")
        upd = resolve(update[c]) if c in update else keep
        ins = resolve(insert[c]) if c in insert else F.lit(None)
        out.append(F.when(matched, upd).when(src_only, ins).otherwise(keep).cast(target.schema[c].dataType).alias(c))
    action = F.when(matched, F.lit("UPDATE")).when(src_only, F.lit("INSERT")).alias(ACTION)
    return j.select(*out, action)


def action_counts(merged: DataFrame) -> DataFrame:
    """``OUTPUT $action`` totals: rows inserted and updated (U4)."""
    return merged.agg(F.count_if(F.col(ACTION) == "INSERT").alias("inserted"),
                      F.count_if(F.col(ACTION) == "UPDATE").alias("updated"))


BUCKET = "_bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Hash bucket of the key (stable across runs and engines' partitions)."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))


def merge_into_bucketed(spark, path: str, source: DataFrame, keys: Sequence[str], buckets: int,
                        update: Mapping[str, Column | str] | None = None,
                        insert: Mapping[str, Column | str] | None = None,
                        empty_target: DataFrame | None = None, finalize=None) -> dict[str, int]:
    """MERGE a batch into a ``BucketedTable`` (see ``operators.tables``) of which
    only the newest version is kept, so the folder can also be read as it is.

    Only the buckets the batch touches are read and rewritten.  ``finalize`` may
    transform the merged rows (with their ``MergeAction``) before the write, e.g.
    to number inserted rows.  Returns the action counts.
    """
    from .tables import BucketedTable, COMMIT, FOLDER, MANIFESTS
    from ..session import path_exists
    if empty_target is None:
        if not path_exists(spark, f"{path.rstrip('/')}/{MANIFESTS}"):
            raise ValueError("empty_target schema is needed for the first run")
        empty_target = spark.read.parquet(path).drop(COMMIT, FOLDER, BUCKET)
    return BucketedTable(spark, path, keys, buckets, empty_target.schema, keep=1).merge(source, update, insert, finalize)
