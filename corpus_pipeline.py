"""The corpus pipeline over ``documents``.

Quality rules, line dedup, SimHash near-dedup, benchmark decontamination,
packing.  Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame;
the driver writes it as Parquet and rereads it as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from jobsift.llm.common import documents, stored
from jobsift.llm.tokens import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are found earlier; n_chars follows the text.
    A document of which no line is left stays, with an empty text."""
    out = line_dedup.remove_lines(docs, line_dedup.EDITS)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the windows."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", benchmark), ("packing", packed)]

#: Estimation, hashes and tokens cannot be said in SQL; each stage's operator is tested by itself.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{k}")
    return docs
