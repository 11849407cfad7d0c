"""Group-mean imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def impute_group_mean(df: DataFrame, cols: Sequence[str], keys: Sequence[str], zero_is_missing: bool = True,
                      final_fill: float | None = 0.0, bounded_groups: bool = False) -> DataFrame:
    """Fill missing values with the mean of their group, then ``final_fill``.

    Plan: a hash aggregate with map-side partial means (one small row per
    group) joined back on the keys, instead of a window partitioned by the
    keys -- a window would put a whole hot group into one task.  When the
    keys come from a fixed label vocabulary (``bounded_groups``) the group
    table is broadcast; otherwise AQE picks the join at run time.
    Rows whose key is NULL get no group mean (pandas drops NULL keys).
    """
    work = df
    if zero_is_missing:
        work = work.select(*[F.when(F.col(c) == 0, F.lit(None)).otherwise(F.col(c)).alias(c) if c in cols
                             else F.col(c) for c in df.columns])
    means = work.groupBy(*keys).agg(*[F.round(F.avg(c), 6).alias(f"_mean_{c}") for c in cols])
    means = means.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    if bounded_groups:
        means = F.broadcast(means)
    joined = work.join(means, on=list(keys), how="left")
    out = []
    for c in df.columns:
        if c in cols:
            v = F.coalesce(F.col(c), F.col(f"_mean_{c}"))
            if final_fill is not None:
                v = F.coalesce(v, F.lit(final_fill))
            out.append(v.alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)
