"""Dimension fill, surrogate keys and calendar.

Surrogate keys continue an IDENTITY column: new members get
``max(existing id) + rank`` in name order.  The rank is computed without a
single-partition window: rows are range-partitioned and sorted by name,
each partition counts its rows, and the offsets (one number per partition, so a
bounded list) are added to the places within.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOW33 = (1 << 33) - 1


def max_key(df: DataFrame | None, key: str) -> int:
    """Largest existing surrogate key (a single scalar), 0 when empty."""
    if df is None:
        return 0
    v = df.agg(F.max(key)).first()[0]
    return int(v or 0)


def assign_ids(df: DataFrame, order_by: Sequence[str], key: str, start: int = 0,
               key_type: str = "int") -> DataFrame:
    """Add ``key = start + 1 + rank`` in ``order_by`` order (ranks are dense
    over rows, so ``order_by`` must be unique)."""
    s = (df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
           .withColumn("_mid", F.monotonically_increasing_id())
           .withColumn("_pid", F.shiftright(F.col("_mid"), 33)))
    s = materialize(s, "assign-ids")  # written once, as both uses below must see the same partitions
    # one number a partition: bounded by the number of shuffle partitions
    counts = {r["_pid"]: r["count"] for r in s.groupBy("_pid").count().collect()}
    before, offsets = 0, [0]
    for pid in range(max(counts, default=0) + 1):
        offsets.append(before)
        before += counts.get(pid, 0)
    offset = F.element_at(F.lit(offsets[1:]), F.col("_pid").cast("int") + 1).cast("bigint")
    return s.select(*df.columns, (F.lit(start + 1) + offset + F.col("_mid").bitwiseAND(F.lit(_LOW33))).cast(key_type).alias(key))


def assign_ids_small(df: DataFrame, order_by: Sequence[str], key: str, start: int = 0,
                     key_type: str = "int") -> DataFrame:
    """``assign_ids`` for inputs with a proven small bound (members of a fixed
    label vocabulary): one ordered window, no range-partition sampling."""
    w = Window.orderBy(*order_by)
    return df.withColumn(key, (F.lit(start) + F.row_number().over(w)).cast(key_type))


def dim_fill(dim: DataFrame | None, src: DataFrame, src_col: str, key: str, name: str,
             bounded: bool = False) -> DataFrame:
    """New members of a name dimension: distinct non-NULL ``src_col`` values
    not yet in ``dim`` (left anti join), keyed after the current maximum.

    ``bounded``: the values come from a fixed label vocabulary (rule
    tables), so the new members are few and are numbered with a plain
    window; otherwise the partition-offset numbering is used."""
    new = src.select(F.col(src_col).alias(name)).filter(F.col(name).isNotNull()).distinct()
    if dim is not None:
        new = new.join(dim.select(name), on=name, how="left_anti")
    number = assign_ids_small if bounded else assign_ids
    return number(new, [name], key, start=max_key(dim, key)).select(key, name)


def dim_fill_child(dim: DataFrame | None, src: DataFrame, src_col: str, parent_col: str, parent: DataFrame,
                   parent_name: str, parent_key: str, key: str, name: str, bounded: bool = False) -> DataFrame:
    """Child dimension carrying its parent's key (province -> region).

    Distinct (name, parent id) pairs, as the source does: a name listed
    under two parents yields two members."""
    pairs = (src.select(F.col(src_col).alias(name), F.col(parent_col).alias("_pname"))
             .filter(F.col(name).isNotNull())
             .join(F.broadcast(parent.select(F.col(parent_name).alias("_pname"), parent_key)), "_pname", "left")
             .select(name, parent_key).distinct())
    if dim is not None:
        pairs = pairs.join(dim.select(name), on=name, how="left_anti")
    number = assign_ids_small if bounded else assign_ids
    return number(pairs, [name, parent_key], key, start=max_key(dim, key)).select(key, name, parent_key)


def union_dim(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if existing is None else existing.unionByName(new)


def date_bounds(src: DataFrame, col: str) -> DataFrame:
    """A3: MIN/MAX of the safely converted date (one row)."""
    d = F.col(col).cast("string").try_cast("date")
    return src.agg(F.min(d).alias("MinDate"), F.max(d).alias("MaxDate"))


def calendar_rows(dates: DataFrame) -> DataFrame:
    """Calendar attributes of a ``FullDate`` column."""
    d = F.col("FullDate")
    return dates.select(F.date_format(d, "yyyyMMdd").cast("int").alias("DateKey"), d.alias("FullDate"),
                        F.year(d).alias("Nam"), F.quarter(d).alias("Quy"), F.month(d).alias("Thang"))


def calendar_fill(existing: DataFrame | None, src: DataFrame, col: str) -> DataFrame:
    """D3: every day between the min and max valid date that the calendar
    lacks.  ``sequence`` replaces the recursive CTE; the range has one row
    per day, so it stays small whatever the fact size."""
    b = date_bounds(src, col).filter(F.col("MinDate").isNotNull())
    days = b.select(F.explode(F.sequence("MinDate", "MaxDate")).alias("FullDate"))
    if existing is not None:
        days = days.join(existing.select("FullDate"), "FullDate", "left_anti")
    return calendar_rows(days)
