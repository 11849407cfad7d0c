"""The corpus pipeline: nulls, empty texts, repeated rows, ties, extra columns
with clashing names and empty tables; planted copies, junk and benchmark passages."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from jobsift.llm.tokens import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept_row string, item_id long, key string"
ITEM = "the harbour master of a small northern town counts nine grey boats before the morning fog has lifted and writes them down"


def _prose(rnd: random.Random, n: int) -> str:
    words = ["harvest", "river", "stone", "window", "letter", "garden", "winter", "morning", "paper", "silver", "bridge", "travel", "simple", "corner", "yellow", "market", "summer", "ocean", "branch", "candle"]
    return " ".join(rnd.choice(words) + rnd.choice(["", "", "s", "ed"]) for _ in range(n)) + "."


def _rows() -> list[tuple]:
    rnd = random.Random(31)
    texts = {k: "\n".join(_prose(rnd, 40) for _ in range(3)) for k in range(1, 31)}
    texts[12] = texts[11]  # an exact copy
    texts[13] = texts[11].replace("\n", " \n")  # lines that differ by an edit
    texts[20] += "\n" + ITEM
    texts[21] += "\n" + ITEM.replace("nine", "ten").upper()
    texts[22] = "### $$$ %%% &&& " * 40
    texts[23] = "same words again and again " * 60
    texts[24] = "too short"
    rows = [(k, t) for k, t in texts.items()]
    rows += [(5, texts[5]), (40, None), (41, ""), (42, " \n\t\n"), (None, _prose(rnd, 50)), (None, None)]
    return [(k, t, "en", None, len(t) if t is not None else None, "clash", k, None) for k, t in rows]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(_rows(), SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_decides_on_all_rows(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == columns
        seen.append(sorted((r["doc_id"] or -1, r["text"], r["n_chars"]) for r in docs.collect()))
    given = {k: t for k, t, *_ in _rows()}
    clean = [k for k in range(1, 31) if k not in (12, 13, 20, 21, 22, 23, 24)]
    ids = [[x[0] for x in rows] for rows in seen]
    # quality rules: junk, repetition, short and empty texts go, everything else stays, a row given twice too
    assert ids[0] == sorted([-1, 5, *range(1, 22), *range(25, 31)])
    # line dedup: no document goes; lines found earlier do, the first of them stays
    assert ids[1] == ids[0]
    left = {k: t for k, t, _ in seen[1]}
    assert left[12] == "" and left[13].strip() == "" and all(left[k] == given[k] for k in clean)
    assert all(n == len(t) for _, t, n in seen[1])
    # near-dedup: one document of each group; a row given twice is one document and stays as it is
    assert set(clean) <= set(ids[2]) and ids[2].count(5) == 2 and len(ids[2]) == len(set(ids[2])) + 1 and not {12, 13} <= set(ids[2])
    # decontamination: the two documents with the passage, and only they
    assert set(ids[2]) - set(ids[3]) == {20, 21} & set(ids[2]) and 20 in ids[2]
    # packing: each id once
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    _holds_all_ids(pieces, [(k, t) for k, t, _ in seen[3]])
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, pieces))


def _holds_all_ids(pieces, docs) -> None:
    """Start, length, checksum, document's tokens and gapless offsets of pieces against the tokenizers library."""
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t in docs}
    held = {k: np.zeros(len(x), int) for k, x in ids.items()}
    for r in pieces:
        k = -1 if r["doc_id"] is None else r["doc_id"]
        mine = ids[k][r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids[k]) and len(mine) == r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(mine, "<u4").tobytes())
        held[k][r["start"]:r["start"] + r["length"]] += 1
    rows = [k for k, _ in docs]
    assert all((n == rows.count(k)).all() for k, n in held.items())
    filled: dict = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in filled.values())


def test_an_empty_corpus(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id = 99").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("item_id = 99").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
