"""Keep-latest and keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Room for one 64-bit column in a packed order, what makes a long unsigned, and less than any time (as SQL decimals).
SLOT, SHIFT, NEVER = "20000000000000000000BD", "9223372036854775808BD", "-999999999999999999BD"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1`` written
    as an aggregate with ``max_by``: Spark combines map-side, so a hot
    key (or the NULL key, which the source groups into one row) is reduced
    before the shuffle instead of being sorted inside one task.  The whole row
    is the aggregate's value, so Spark sorts rows by key for it; for wide rows
    of a stored table with a unique id see ``latest_by_id``.  Put a
    unique column last in ``order`` to make ties deterministic.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep-first (``drop_duplicates`` in source order)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def _as_long(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, T.TimestampNTZType):
        # by its parts, as a cast to a timestamp depends on the session's time zone
        seconds = F.hour(name) * 3600 + F.minute(name) * 60 + F.extract(F.lit("SECOND"), F.col(name))
        return F.unix_date(F.col(name).cast("date")).cast("long") * 86_400_000_000 + (seconds * 1_000_000).cast("long")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name).cast("long")
    raise TypeError(f"{name} is {kind.simpleString()}; a packed order takes dates, timestamps and integers")


def latest_by_id(df: DataFrame, keys: Sequence[str], when: str, row_id: str) -> DataFrame:
    """``latest_per_key(df, keys, [when, row_id])`` with the payload left out of the aggregate.

    ``when`` and ``row_id``, a unique integer that is never NULL, become one
    decimal, which a hash aggregate can hold in place: only keys and decimals are aggregated
    and shuffled by key.  The rows are then fetched in one semi join on that
    decimal.  It is unique, so the rows of a hot key (or of the NULL key) spread
    over all tasks of the join.  A NULL ``when`` comes before all others.

    ``df`` is read twice, so it should be a stored table, and must give the same rows both times.
    """
    if isinstance(df.schema[row_id].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{row_id} must be an integer")
    rank = "_rank"
    while rank in df.columns:
        rank = "_" + rank
    # days or microseconds since 1970 have 18 digits at most for the years 1 to 9999, an integer has to stay within them too
    high = F.coalesce(_as_long(df, when).cast("decimal(18,0)"), F.expr(NEVER))
    packed = high * F.expr(SLOT) + (_as_long(df, row_id).cast("decimal(19,0)") + F.expr(SHIFT))
    given = df.withColumn(rank, packed.cast("decimal(38,0)"))
    best = given.groupBy(*keys).agg(F.max(rank).alias(rank)).select(rank)
    return given.join(best, rank, "left_semi").select(*df.columns)
