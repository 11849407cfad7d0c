"""The registered query of each operator: its whole table, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors, decontaminate, frames, licences, line_dedup, packing, periodic_runs, prefix_trie, quality_rules, reply_trees, simhash, suffix_sort, suffix_tree_lm
from .common import documents, stored
from .tokens import tokenizer_path


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "p_good")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_lm.score(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sort.remove_repeats(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(documents(spark, sf_dir), line_dedup.EDITS)


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op9_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = frames.write(documents(spark, sf_dir), frames.shared_folder(spark, "frames"), tokenizer_path("word_bpe_49k.json"))
    return frames.read(spark, manifest)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.remove_repeats(documents(spark, sf_dir))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


#: A conversation that says what marks of chat templates look like.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    rows = conversations(spark, sf_dir).select("conv_id", "turn", "role", "text").unionByName(more)
    out = reply_trees.read_back(stored(reply_trees.format_conversations(rows), "chats"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"),
                      F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP11_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown AS (SELECT *, len(replace(replace(replace(replace(role, '\', '\\'), '</', '<\/'), '<turn>', '<\turn>'), '<role>', '<\role>'))
    + len(replace(replace(replace(replace(text, '\', '\\'), '</', '<\/'), '<turn>', '<\turn>'), '<role>', '<\role>')) + 28 AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(prefix_trie.numbered_turns(conversations(spark, sf_dir)), "trie-given")
    return prefix_trie.prefix_trie(prefix_trie.with_shared_openings(turns))


OP12_SQL = """
WITH own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, turns, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda s, t: xor(s >> 1, 3988292384::BIGINT * (s & 1))))) % 9 AS h FROM own),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
paths AS (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS depth FROM rebuilt),
nodes AS (SELECT turns[1:depth] AS way, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(turns) = depth), '')) AS ends_sha256 FROM paths GROUP BY 1, 2),
counted AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.way[1:n.depth] = n.way) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * octet_length(encode(n.way[n.depth].x)) END AS saves
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.way = n.way[1:n.depth - 1])
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, u.parent_conv_id, u.n_convs, u.n_children, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, CAST(sum(v.saves) AS BIGINT) AS saved_tokens, u.ends_sha256
FROM counted u JOIN counted v ON v.depth >= u.depth AND v.way[1:u.depth] = u.way GROUP BY u.conv_id, u.depth, u.parent_conv_id, u.n_convs, u.n_children, u.ends_sha256"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.periodic_runs(documents(spark, sf_dir), rewrite=True)
    best = F.aggregate(F.slice("runs", F.lit(2), F.greatest(F.size("runs") - 1, F.lit(0))), F.get("runs", F.lit(0)), lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = out.withColumn("best", best)
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                      F.sha2(listed, 256).alias("runs_sha256"), "collapsed_sha256", "n_words", "n_kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_tree_lm": op2_suffix_tree_lm,
    "op3_simhash": op3_simhash,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_licences": op8_licences,
    "op9_frames": op9_frames,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_reply_trees": op11_reply_trees,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE: dict[str, str] = {
    "op8_licences": licences.oracle(),
    "op11_reply_trees": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
}
