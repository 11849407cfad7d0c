"""Containment (theta) join of texts with ordered keyword rules.

Two plans for "first rule whose keyword occurs wins":

* ``first_match`` (functions.text): a CASE chain folded into the
  projection -- no join at all; best for the fixed rule sets.
* ``first_match_join``: rules as a table ``(priority, label, keyword)`` of any
  size.  A text that contains a keyword contains its first characters, so both
  sides meet in an equi-join on short character grams: each keyword with its
  first one, each text with its distinct ones.  Only pairs that share a gram are
  then verified with ``contains``, and a per-text ``min_by(label, priority)``
  (combined map-side) picks the rule.  Grams travel with the text's key alone;
  the text joins the candidates, not the grams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    rows = [(i, label, kw) for i, (label, kws) in enumerate(rules) for kw in kws]
    schema = T.StructType([T.StructField("priority", T.IntegerType()), T.StructField("label", T.StringType()),
                           T.StructField("keyword", T.StringType())])
    return spark.createDataFrame(rows, schema)


#: Characters of a gram; shorter keywords take as many as they have.
GRAM = 3


def text_grams(text, sizes: Sequence[int]):
    """The distinct runs of so many characters in a text, in one pass for each size."""
    grams = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) if n else F.array(F.lit("")) for n in sizes]
    return F.array_distinct(F.concat(*grams))


def first_match_join(df: DataFrame, key: str, text: str, rules: DataFrame, default: str,
                     out: str = "label") -> DataFrame:
    """One row per ``key`` (unique): label of the lowest-priority matching rule.
    A null keyword matches nothing, an empty one everything but a null text."""
    texts = df.select(key, F.lower(F.col(text)).alias("_t"))
    rules = rules.where("keyword IS NOT NULL").withColumn("_gram", F.substring("keyword", 1, GRAM))
    sizes = sorted(r[0] for r in rules.select(F.length("_gram")).distinct().collect())  # GRAM + 1 values at most
    if not sizes:
        return texts.select(key, F.lit(default).alias(out))
    grams = texts.select(key, F.explode(text_grams(F.col("_t"), sizes)).alias("_gram"))
    pairs = grams.join(rules, "_gram").drop("_gram")
    met = pairs.join(texts, key).where(F.col("_t").contains(F.col("keyword")))
    best = met.groupBy(key).agg(F.min_by("label", F.struct("priority", "label")).alias(out))
    return texts.select(key).join(best, key, "left").select(key, F.coalesce(out, F.lit(default)).alias(out))
