"""Crawl frontier over listing cards.

Per site, in (page, pos) order, a card is *new* when what names it (its link, or
its job id) is not in the history and (optionally) not seen earlier in the run.
Scanning stops after ``max_empty`` consecutive pages without a new card, pages
without any card among them, and at most ``cap`` new cards are taken.

No task sees a whole site.  First occurrences are a (site, key) aggregate joined
back, page totals are a hash aggregate.  What lies before a page is summed up in
three levels: inside its range of ``RANGE`` pages, over the ranges of its group
of ranges, and over the groups, of which a site has one for 65,536 pages.  A run
of empty pages is found by counting, for each page, the empty ones among the
last ``max_empty``; the rank inside a page uses (site, page) partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE = 256


def mark_new(listing: DataFrame, history: DataFrame, dedupe_within_run: bool = True, key: str = "link") -> DataFrame:
    """``listing`` with ``is_new``; a card whose ``key`` is NULL is not."""
    seen = history.select("site", key).distinct().withColumn("_seen", F.lit(True))
    cards = listing.join(seen, ["site", key], "left")
    is_new = F.col("_seen").isNull() & F.col(key).isNotNull()
    if dedupe_within_run:
        # first occurrence per key as an aggregate (combined map-side, so a
        # link repeated on many pages is not gathered into one task)
        first = listing.groupBy("site", key).agg(F.min(F.struct("page", "pos")).alias("_first"))
        cards = cards.join(first, ["site", key], "left")
        is_new = is_new & F.coalesce(F.struct("page", "pos") == F.col("_first"), F.lit(False))
        return cards.withColumn("is_new", is_new).drop("_seen", "_first")
    return cards.withColumn("is_new", is_new).drop("_seen")


def sums_before(df: DataFrame, group: str, place: str, values: list[str]) -> DataFrame:
    """``df`` with ``<value>_before``: what rows of the same ``group`` and a smaller
    ``place`` (unique in it, not negative) add up to."""
    df = df.withColumn("_range", F.floor(F.col(place) / RANGE)).withColumn("_group", F.floor(F.col("_range") / RANGE))

    def before(keys: list[str], order: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    ranges = df.groupBy(group, "_group", "_range").agg(*[F.sum(v).alias(v) for v in values])
    groups = ranges.groupBy(group, "_group").agg(*[F.sum(v).alias(v) for v in values])
    tops = groups.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_group", *values))).alias("_all"))

    def added(v: str):
        return F.aggregate(F.slice("_all", F.lit(1), F.col("_i")), F.lit(0).cast("long"), lambda a, x: a + x[v]).alias(f"{v}_c")

    tops = tops.select(group, F.posexplode("_all").alias("_i", "_one"), "_all").select(group, F.col("_one._group").alias("_group"), *[added(v) for v in values])
    w2 = before([group, "_group"], "_range")
    ranges = ranges.select(group, "_group", "_range", *[F.coalesce(F.sum(v).over(w2), F.lit(0)).alias(f"{v}_b") for v in values])
    w1 = before([group, "_group", "_range"], place)
    df = df.select("*", *[F.coalesce(F.sum(v).over(w1), F.lit(0)).alias(f"{v}_a") for v in values])
    df = df.join(ranges.join(tops, [group, "_group"]), [group, "_group", "_range"])
    df = df.withColumns({f"{v}_before": F.col(f"{v}_a") + F.col(f"{v}_b") + F.col(f"{v}_c") for v in values})
    return df.drop("_range", "_group", *[f"{v}_{x}" for v in values for x in "abc"])


def page_plan(cards: DataFrame, max_empty: int | None, pages: DataFrame | None = None) -> DataFrame:
    """Per (site, page): new cards on the page, new cards before it, and whether
    the scan reaches the page.  ``pages``: (site, page) of all pages that were
    fetched; those without a card are empty.  By default the pages of ``cards``."""
    totals = cards.groupBy("site", "page").agg(F.sum(F.col("is_new").cast("int")).alias("n_new"))
    if pages is not None:
        totals = totals.join(pages.select("site", "page").distinct(), ["site", "page"], "right").withColumn("n_new", F.coalesce("n_new", F.lit(0)))
    out = sums_before(totals.withColumn("_one", F.lit(1)), "site", "page", ["n_new", "_one"]).withColumnsRenamed({"n_new_before": "new_before", "_one_before": "_index"}).drop("_one")
    if max_empty is None:
        return out.withColumn("reached", F.lit(True)).drop("_index")
    empty = out.where("n_new = 0").select("site", "_index")
    near = empty.select("site", F.explode(F.sequence(F.col("_index"), F.col("_index") + max_empty - 1)).alias("_end"))
    full = near.groupBy("site", "_end").count().where(F.col("count") == max_empty)
    stop = full.groupBy("site").agg(F.min("_end").alias("_stop"))
    out = out.join(stop, "site", "left")
    return out.withColumn("reached", F.col("_stop").isNull() | (F.col("_index") <= F.col("_stop"))).drop("_stop", "_index")


def crawl_frontier(listing: DataFrame, history: DataFrame, cap: int | None = 100, max_empty: int | None = 5,
                   dedupe_within_run: bool = True, key: str = "link", pages: DataFrame | None = None) -> DataFrame:
    """New cards to crawl: (site, page, pos, link, rank) with rank 1..cap; with a
    ``key`` other than the link also that column."""
    cards = mark_new(listing, history, dedupe_within_run, key)
    plan = page_plan(cards, max_empty, pages)
    new = cards.filter("is_new").join(plan.filter("reached").select("site", "page", "new_before"), ["site", "page"])
    rank = F.col("new_before") + F.row_number().over(Window.partitionBy("site", "page").orderBy("pos", "link"))
    out = new.withColumn("rank", rank.cast("int"))
    if cap is not None:
        out = out.filter(F.col("rank") <= cap)
    return out.select("site", "page", "pos", "link", *([key] if key != "link" else []), "rank")
