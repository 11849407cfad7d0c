"""Each operator against a brute-force version on a small table with nulls,
empty texts, repeated rows, ties and clashing column names, and on no rows."""

from __future__ import annotations

import hashlib
import io
import os
import random
import re
import time
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobsift.llm import anchors, decontaminate, flat_words, frames, induced_sorting, licences, line_dedup, packing, quality_rules, queries, simhash, suffix_sort, suffix_tree_lm
from jobsift.llm.common import SHUFFLE_CLEANUP, id_text, stored
from jobsift.llm.tokens import Encoder, tokenizer_path

WORD = re.compile("[^\x20\x09-\x0d]+")


def _texts() -> list[tuple]:
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["über", "naïve", "it's", "x2.5,", "MIT"]
    make = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    long, shared = make(700), make(60)
    rows = [(1, long), (2, long), (2, long), (3, make(50) + " " + shared + " " + make(40)), (4, shared + "\n" + make(30)), (5, None), (6, ""), (7, "one"), (8, "  two\n\nthree <|endoftext|> "), (9, "a " * 300), (10, make(90) + "\n" + shared), (11, "Released under the MIT License."), (None, make(25)), (None, None)]
    return [(i, t, i, "en") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_texts(), "doc_id long, text string, place long, key string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = 99")


def test_quality_counts_and_verdicts(docs, none):
    out = quality_rules.quality(docs).collect()
    assert len(out) == docs.count()
    by = {r["doc_id"]: r for r in out if r["doc_id"]}
    assert by[9]["n_repeat_words"] == 300 and by[9]["base_failed"] and not by[9]["kept"]
    assert by[5]["n_words"] == 0 and by[5]["base_failed"]
    words = WORD.findall(dict(x[:2] for x in _texts())[1])
    assert (by[1]["n_words"], by[1]["word_chars"]) == (len(words), sum(map(len, words)))
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.quality(none).count() == 0


def test_quality_against_brute_force(spark):
    rnd = random.Random(3)
    make = lambda n, kinds: " ".join(rnd.choice(["été", "a", "B2", "C#", "x|y", "<>", "日本", "tea!", "ROCK"][:kinds]) for _ in range(n))
    texts = [None, "", " \n\t\n ", make(19, 9), make(20, 9), "\u00a0 " * 30, "\u2028x\x85 \x1cy"]
    for _ in range(60):
        lines = [make(rnd.randrange(14), rnd.choice([2, 5, 9])) for _ in range(rnd.randrange(1, 12))]
        texts.append(rnd.choice(["\n", "\r\n", "\n \n"]).join(rnd.choice(lines) if rnd.random() < 0.3 else x for x in lines))
    for n in (30, 100, 200):  # repeated windows on both sides of the limit
        block = [f"k{i}" for i in range(n)]
        texts += [" ".join([*block[:m], *(f"u{i}" for i in range(100)), *block[:m]]) for m in (7, 8, 20, n)]

    def base(text):
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
        return len(words), sum(map(len, words)), sum(text.count(x) for x in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)

    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    rows = {r["doc_id"]: r for r in quality_rules.quality(docs).collect()}
    assert len(rows) == len(texts)
    for k, t in enumerate(texts):
        n, *_, repeats = base(t)
        got = rows[k]
        assert tuple(got[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base(t), t
        assert got["base_failed"] == (n < 20 or 100 * repeats > 30 * n)
        assert got["kept"] == (not got["base_failed"] and got["p_good"] >= 0.5)
    assert {r["base_failed"] for r in rows.values()} == {True, False}
    # the posterior of each vote pattern, by Bayes' rule from the estimated model
    patterns: dict[str, int] = {}
    for r in rows.values():
        patterns[r["votes"]] = patterns.get(r["votes"], 0) + 1
    model = quality_rules.fit(sorted(patterns.items()))
    for r in rows.values():
        good, bad = model["prior"], 1 - model["prior"]
        for vote, if_good, if_bad in zip(r["votes"], model["bad_if_good"], model["bad_if_bad"], strict=True):
            good *= {"b": if_good, "g": 1 - if_good, "-": 1}[vote]
            bad *= {"b": if_bad, "g": 1 - if_bad, "-": 1}[vote]
        assert abs(r["p_good"] - good / (good + bad)) < 1e-9


def test_fingerprints_against_the_definition():
    for t in ["", " \n", "one", "one two", "Über ZEBRA Éa b", "a b c a b c a b c", *(t for _, t, _, _ in _texts() if t)]:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        assert simhash.fingerprint(t.encode()) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_suffix_tree_scores(docs, none):
    out = suffix_tree_lm.score(docs).collect()
    assert len(out) == docs.count()
    empty = [r for r in out if r["doc_id"] in (5, 6)]
    assert all(r["n_tokens"] == 1 and r["score"] < 0 for r in empty) and empty[0]["score"] == empty[1]["score"]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in out if r["doc_id"])
    assert suffix_tree_lm.score(none).count() == 0


def test_simhash_components(docs, none):
    out = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    prints = {r: int(f, 16) for r, f in out}
    for (i, f), c in out.items():
        if i is not None:
            assert prints[i] == simhash.fingerprint((dict(x[:2] for x in _texts())[i] or "").encode())
    assert out[2, f"{prints[2]:016x}"] == 1 and out[6, "0" * 16] == 5
    assert simhash.keep_first(docs).columns == docs.columns
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_grid_loses_no_link(spark):
    rnd = random.Random(3)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    fps |= {f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4))) for f in list(fps)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), k) for k, f in enumerate(fps)], "fp long, node long")
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in simhash.links(frame).collect():
        assert (fps[r["a"]] ^ fps[r["b"]]).bit_count() <= 3
        parent[root(r["a"])] = root(r["b"])
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                assert root(i) == root(j)


def test_suffix_order_against_sorting():
    rnd = random.Random(1)
    for _ in range(150):
        s = [rnd.randint(1, rnd.choice([1, 2, 4])) for _ in range(rnd.randint(1, 50))] + [0]
        order, common = induced_sorting.suffix_order(np.array(s), most_held=rnd.choice([3, 1000]))
        wanted = sorted(range(len(s)), key=lambda i: s[i:])
        assert order.tolist() == wanted
        for a, b, n in zip(wanted, wanted[1:], common[1:].tolist(), strict=False):
            assert s[a:a + n] == s[b:b + n] and s[a + n:a + n + 1] != s[b + n:b + n + 1]


def test_suffix_dedup_against_brute_force(docs, none):
    width = 60
    seen: dict[bytes, set] = {}
    texts = {(i, t or "") for i, t, _, _ in _texts()}
    for i, t in texts:
        raw = t.encode()
        for k in range(len(raw) - width + 1):
            seen.setdefault(raw[k:k + width], set()).add((i, t, k))
    for r in suffix_sort.remove_repeats(docs, width=width, with_text=True).collect():
        ok = False
        for i, t in texts:
            if i == r["doc_id"]:
                raw = t.encode()
                gone = bytearray(len(raw))
                for k in range(len(raw) - width + 1):
                    if len(seen[raw[k:k + width]]) > 1:
                        gone[k:k + width] = b"\1" * width
                ok |= (r["n_bytes"], r["n_removed"], bytes(r["kept"])) == (len(raw), sum(gone), bytes(b for b, g in zip(raw, gone, strict=True) if not g))
        assert ok, r["doc_id"]
    assert suffix_sort.remove_repeats(none).count() == 0


def test_benchmark_passages(spark, none):
    item = "The quick brown fox jumps over the lazy dog while seventeen curious otters watch from the river bank"
    near = item.replace("quick", "quack").replace("otters", "oters").upper()
    docs = spark.createDataFrame([(1, "x " * 40 + item + " y"), (2, "some text " + near), (3, item[:50]), (4, None), (5, ""), (6, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "..."), (10, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.passages(docs, bench).collect()}
    assert got == {(1, 7, 0), (2, 7, 2)}
    assert {r["doc_id"] for r in decontaminate.clean_documents(docs, bench).collect()} == {3, 4, 5, 6}
    assert decontaminate.passages(none, bench).count() == 0
    assert decontaminate.clean_documents(docs, bench.where("item_id = 99")).count() == 6


def test_packing_places_every_id_once(docs, none):
    rows = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), width=64).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    wanted = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _, _ in _texts())
    assert sum(r["length"] for r in rows) == sum(wanted)
    filled: dict = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == 64 or n & (n - 1) == 0 for n in filled.values())
    assert packing.pack(none, tokenizer_path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_tokenizer(name):
    texts = ["", "It's 3.14, isn't it?", "  lead", "a\n\nb", "x<|endoftext|>y", "naïve ÜBER...\nline.,!", "tab\there", "日本語 テスト。", "don't we'll I'm!?", "A1b2 c-d_e", "é ́x", "x  y", "İstanbul ŒUVRE ﬁ"]
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    for text, ids in zip(texts, Encoder(tokenizer_path(name)).encode(pa.array(texts)), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_line_dedup(spark, none):
    rows = [(1, "hello world this is a long line\nshort\n\nhello world this is a long line"), (2, "hello world this is a lang line\nshort\nxhello world this is a long line"), (3, None), (4, ""), (5, "hello wrld this is a long line\nother thing entirely, right here\nother thing entirely right here"), (7, "hello worl this is a lng line")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, gone string")
    got = {r["doc_id"]: r["gone"] for r in line_dedup.dedup_report(docs).collect()}
    assert got == {1: [3], 2: [0, 1, 2], 3: [], 4: [], 5: [0, 2], 7: []}
    kept = {r["doc_id"]: r["text"] for r in line_dedup.remove_lines(docs).collect()}
    assert kept[3] is None and kept[5] == "other thing entirely, right here" and kept[2] == ""
    assert line_dedup.dedup_report(none).count() == 0


def test_edit_distance(spark):
    rnd = random.Random(5)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    pairs = [("".join(rnd.choice("abü") for _ in range(rnd.randint(0, 7))), "".join(rnd.choice("abü") for _ in range(rnd.randint(0, 7)))) for _ in range(120)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for most in (1, 2, 3):
        for r in frame.select("a", "b", line_dedup.edits_within("a", "b", most).alias("near")).collect():
            assert r["near"] == (distance(r["a"], r["b"]) <= most), (r["a"], r["b"], most)


def test_licences(docs, none):
    by = {r["doc_id"]: r for r in licences.scan(docs).collect() if r["doc_id"]}
    assert (by[11]["labels"], by[11]["base_labels"], by[11]["first_word"], by[11]["score"]) == ("MIT,mit", "mit", 3, 1.0)
    assert by[5]["n_words"] == 0 and by[5]["labels"] == "" and by[5]["first_word"] is None
    automaton = licences.Automaton({"T": "a <<optional>>b c<<end>> <<any 1-2>> d"})
    assert all(automaton.labels(x.encode().split()) == {"T"} for x in ("x a b c q d", "a q d", "a q r d y"))
    assert not any(automaton.labels(x.encode().split()) for x in ("a d", "a b c q r s d", "a q r s d"))
    assert licences.scan(none).count() == 0


def test_frames_round_trip(spark, docs, none):
    path = tokenizer_path("word_bpe_49k.json")
    manifest = frames.write(docs, frames.shared_folder(spark, "frames-test"), path)
    rows = frames.read(spark, manifest).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(path)
    start = 0
    wanted = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t, _, _ in _texts()}
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
        if r["doc_id"] is not None:
            assert r["ids_crc32"] == zlib.crc32(np.array(wanted[r["doc_id"]], "<u4").tobytes())
    assert len(rows) == docs.count() and [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda i: i or 0)
    assert [x.tolist() for x in frames.documents_of(spark, manifest, [2])[2]] == [wanted[2], wanted[2]]
    assert frames.read(spark, frames.write(none, frames.shared_folder(spark, "frames-test"), path)).count() == 0


def test_frames_notice_damage():
    sink = io.BytesIO()
    writer = frames.Writer(sink)
    writer.add(4, np.arange(1000, dtype=np.uint32))
    writer.close()
    raw = bytearray(sink.getvalue())
    assert frames.Reader(io.BytesIO(bytes(raw))).find(4)[0].tolist() == list(range(1000))
    raw[-1] ^= 1
    with pytest.raises(ValueError):
        frames.Reader(io.BytesIO(bytes(raw)))


def test_substring_dedup_against_brute_force(docs, none):
    seen: set = set()
    wanted: dict = {}
    for i, t in sorted({(i, t or "") for i, t, _, _ in _texts() if i is not None}):
        words = WORD.findall(t)
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            w = tuple(words[k:k + 20])
            if w in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(w)
        wanted[i] = (len(words), sum(gone), hashlib.sha256(" ".join(w for w, g in zip(words, gone, strict=True) if not g).encode()).hexdigest())
    for r in anchors.remove_repeats(docs).collect():
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == wanted[r["doc_id"]]
    assert anchors.remove_repeats(none).count() == 0


def test_substring_dedup_keeps_one_of_a_repeated_row(spark):
    make = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    shared = make("s", 25)
    rows = [(4, make("a", 30) + " " + shared), (4, make("a", 30) + " " + shared), (6, make("b", 10) + " " + shared)]
    beside = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    apart = spark.createDataFrame(rows[:1], "doc_id long, text string").union(spark.createDataFrame(rows[1:], "doc_id long, text string").coalesce(1))
    for frame in (beside, apart):
        got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in anchors.remove_repeats(frame, with_text=True).collect())
        assert got == [(4, 55, 0, rows[0][1])] * 2 + [(6, 35, 25, make("b", 10))]


def test_line_dedup_allows_more_edits_to_longer_lines(spark, monkeypatch):
    rnd = random.Random(11)

    def edited(line, n):
        for _ in range(n):
            k = rnd.randrange(len(line))
            line = line[:k] + rnd.choice(["", "q" + line[k], "q"]) + line[k + 1:]
        return line

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    steps = ((20, 2), (60, 3))
    lines = ["of at orinre of anouth", "of that orinre of anouth"]
    for n in (19, 20, 21, 24, 40, 58, 59, 60, 62, 90):
        base = "".join(rnd.choice("abcde ") for _ in range(n - 1)) + "x"
        lines += [base, *(edited(base, k) for k in (1, 2, 2, 3, 3, 3, 4))]
    lines = [x for x in dict.fromkeys(lines) if x.strip()]
    allowed = lambda n: 3 if n >= 60 else 2 if n >= 20 else 0
    wanted = [k for k, x in enumerate(lines) if any(distance(x, y) <= allowed(min(len(x), len(y))) for y in lines[:k])]
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id long, text string")
    got = sorted(r["doc_id"] for r in line_dedup.dedup_report(docs, steps).collect() if r["gone"])
    assert got == wanted and wanted[0] == 1
    monkeypatch.setattr(queries, "documents", lambda *_: docs.where("doc_id < 2"))
    assert {r["doc_id"]: r["n_near"] for r in queries.op7_line_dedup(spark, "").collect()} == {0: 0, 1: 1}


def test_line_dedup_generates_methods_that_the_jvm_compiles(spark, monkeypatch, capsys):
    docs = spark.createDataFrame([(k, f"a line of {k} that is long enough\n" + "xy z" * 120 + str(k)) for k in range(4)], "doc_id long, text string")
    kept, sizes = line_dedup.stored, {}

    def shown(df, name):
        capsys.readouterr()
        df.explain("codegen")
        sizes[name] = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", capsys.readouterr().out)]
        return kept(df, name)

    monkeypatch.setattr(line_dedup, "stored", shown)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        line_dedup.links(docs, line_dedup.EDITS, 20)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sizes["line-keys"] and sizes["line-links"]
    assert all(0 < n <= 8000 for found in sizes.values() for n in found), sizes


def test_line_dedup_counts_characters_beyond_ascii(spark):
    base = "".join(chr(0x1F600 + k) if k % 3 else "ềß"[k % 2] for k in range(48))
    rows = [(1, base), (2, base[:7] + base[8:]), (3, base[:40] + "ü" + base[41:] + "x"), (4, base[:5] + "abc" + base[8:]), (5, "plain ascii line of words, é or e"), (6, "plain ascii line of words, e or e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in line_dedup.dedup_report(docs, line_dedup.EDITS).orderBy("doc_id").collect() if r["gone"]] == [2, 3, 6]


def test_packing_deals_texts_after_the_words_shuffle_is_gone(spark, capsys):
    docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(30)], "doc_id long, text string")
    dealt, n, _ = packing.routed(id_text(docs), 6 << 20)
    capsys.readouterr()
    dealt.explain()
    plan = capsys.readouterr().out
    assert n == 30 and dealt.count() == 30 and "hashpartitioning(route" in plan and "hashpartitioning(part" not in plan


def test_packing_finds_neighbours_in_other_partitions(spark):
    rnd = random.Random(4)
    common = [f"c{i}" for i in range(30)]
    rows = [(k, " ".join(rnd.choice(common) for _ in range(20)) + f" rare{k % 20}a rare{k % 20}b") for k in range(40)]
    frames_of = lambda part: spark.createDataFrame(part, "doc_id long, text string").coalesce(1)
    path = tokenizer_path("byte_bpe_50k.json")
    apart = packing.pack(frames_of(rows[:20]).union(frames_of(rows[20:])), path, width=256).collect()
    windows: dict = {}
    for r in apart:
        windows.setdefault(r["sequence_id"], set()).add(r["doc_id"])
    # A filler that ends a window can leave its own neighbour behind, so not all pairs share one.
    assert sum(any({k, k + 20} <= w for w in windows.values()) for k in range(20)) > 10
    dealt = packing.routed(id_text(frames_of(rows[:20]).union(frames_of(rows[20:]))), 6 << 20)[0]
    part_of = {r["doc_id"]: r["part"] for r in dealt.select("doc_id", F.spark_partition_id().alias("part")).collect()}
    assert all(part_of[k] == part_of[k + 20] for k in range(20))
    assert sorted(apart) == sorted(packing.pack(frames_of(rows[::-1]), path, width=256).collect())


def test_packing_scores_by_all_documents():
    texts, words = ["a b", "a c", "b d"], [3, 9, 3, 1, 9, 1]
    index = packing.Index(pa.array(texts), np.array(words, np.uint32), 20, 4.0)
    weight = lambda df: np.log1p((20 - df + 0.5) / (df + 0.5)) * 2.2 / (1 + 1.2 * (1 - 0.75 + 0.75 * 2 / 4.0))
    assert np.allclose(index.scores(0), [weight(3) + weight(9), weight(3), weight(9)])


def test_suffix_tree_scores_against_brute_force(spark):
    mu, least, gain, depth = 4.0, 8, 8.0, suffix_tree_lm.DEPTH
    # Control characters in a text are characters like any other.
    given = [*_texts(), (20, "a\x00b \x01 c\x01 \x01", 20, "en"), (21, "\x01\x00 w1 \x00\x00\x00\x00", 21, "en"), (22, "\x00", 22, "en")]
    docs = spark.createDataFrame(given, "doc_id long, text string, place long, key string")
    before, behind = bytes([suffix_tree_lm.START]) * depth, bytes([suffix_tree_lm.END])
    rows = [(i, b" ".join((t or "").encode().translate(suffix_tree_lm.LOWER).split())) for i, t, _, _ in given]
    assert sum(not suffix_tree_lm.held_out(i) for i in (20, 21, 22)) >= 2
    train = [t for i, t in rows if not suffix_tree_lm.held_out(i)]
    met: dict[bytes, dict[int, int]] = {}
    for t in train:
        s = before + t + behind
        for at in range(depth, len(s)):
            for k in range(depth + 1):
                after = met.setdefault(s[at - k:at], {})
                after[s[at]] = after.get(s[at], 0) + 1
    total = {c: sum(after.values()) for c, after in met.items()}
    kept: dict[bytes, bool] = {}

    def p(context, x):
        count, many = met.get(context, {}).get(x, 0), total.get(context, 0)
        if not context:
            return (count + 1) / (many + 256)
        shorter = p(context[1:], x)
        if len(context) > 1 and context not in kept:
            kept[context] = many >= least and sum(n * np.log(n / many / p(context[1:], y)) for y, n in met[context].items()) >= gain
        return (count + mu * shorter) / (many + mu) if len(context) == 1 or kept[context] else shorter

    words: dict[bytes, int] = {}
    for w in b" ".join(train).split():
        words[w] = words.get(w, 0) + 1
    tokens, kinds = sum(words.values()) + len(train), len(words) + 1
    wanted = []
    for i, t in rows:
        s = before + t + behind
        logs = sum(np.log10(p(s[at - depth:at], s[at])) for at in range(depth, len(s)))
        base = sum(np.log10((n + 1) / (tokens + kinds + 1)) for n in [*(words.get(w, 0) for w in t.split()), len(train)])
        wanted.append((i or 0, len(t.split()) + 1, sum(w in words for w in t.split()) + 1, tokens, base, logs))
    got = [(r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in suffix_tree_lm.score(docs).collect()]
    assert any(kept.values()) and not all(kept.values())
    assert np.allclose(sorted(got), sorted(wanted))


def _least_edits(item: str, text: str) -> int:
    """Edits between ``item`` and the place of ``text`` that is nearest to it."""
    row = np.zeros(len(text) + 1, np.int64)
    codes, at = np.array(list(map(ord, text)), np.int64), np.arange(len(text) + 1)
    for x in item:
        below = np.append(row[0] + 1, np.minimum(row[1:] + 1, row[:-1] + (codes != ord(x))))
        row = np.minimum.accumulate(below - at) + at
    return int(row.min())


def test_benchmark_parts_against_brute_force(spark):
    rnd = random.Random(23)
    prose = lambda n: "".join(rnd.choice("abcdefgh éñ .") for _ in range(n))

    def edited(text, n):
        for _ in range(n):
            k = rnd.randrange(len(text))
            text = text[:k] + rnd.choice(["", "Q" + text[k], "Z"]) + text[k + 1:]
        return text

    items = [(k, prose(n)) for k, n in enumerate((12, 30, 99, 100, 101, 149, 150, 151, 250, 394, 394))]
    items += [(3, items[3][1]), (50, None), (51, ""), (52, " ." * 90)]
    texts: list = [None, "", prose(3000)]
    for _, t in items[:11]:
        n = len(t)
        for _ in range(6):
            size = rnd.choice([n, n, n * 2 // 3, n // 2, min(n, 150), min(n, 120), min(n, 90)])
            start = rnd.randrange(n - size + 1)
            texts.append(prose(rnd.randrange(80)) + edited(t[start:start + size].upper(), rnd.choice([0, 1, 4, size // 14, size // 10])) + prose(rnd.randrange(200)))
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, item_id string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    fold = lambda t: (t or "").translate(decontaminate.FOLD_TEXT)

    def near(item, text):
        return _least_edits(item, text) <= (0 if len(item) < 20 else min(int(0.08 * len(item)), len(item) // 10 - 1))

    def wanted(part):
        out = set()
        for d, text in enumerate(texts):
            for i, item in items:
                item, n = fold(item), len(item or "")
                cuts = [item[a:a + part] for a in [*range(0, n - part, part // 2), n - part]] if 0 < part < n else []
                if any(any(c.isalnum() for c in x) and near(x, fold(text)) for x in [item, *cuts]):
                    out.add((d, i))
        return out

    whole, parts = wanted(0), wanted(100)
    assert len(parts) > len(whole) + 5
    for part, found in ((0, whole), (100, parts)):
        rows = decontaminate.passages(docs, bench, part_chars=part).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == found
        assert {r["doc_id"] for r in decontaminate.clean_documents(docs, bench, part_chars=part).collect()} == set(range(len(texts))) - {d for d, _ in found}
        for r in rows:
            item = fold(dict(items)[r["item_id"]])[r["item_first"]:r["item_end"]]
            assert len(item) >= min(100, len(dict(items)[r["item_id"]])) and 0 <= r["first_char"] < r["end_char"] <= len(texts[r["doc_id"]])
            assert _least_edits(item, fold(texts[r["doc_id"]])[r["first_char"]:r["end_char"]]) <= r["edits"] * (1 + 2 * len(item) // 100)
    # a quote of one and a half parts is always found
    long = items[9][1]
    quoted = spark.createDataFrame([(k, "zz " + long[k:k + 150] + " zz") for k in range(0, 244, 9)], "doc_id long, text string")
    assert decontaminate.clean_documents(quoted, bench).count() == 0
    with pytest.raises(ValueError):
        decontaminate.Index([(1, "a" * 50)], 10, 0.08, 15)


def test_blocks_of_the_model_are_stored_compressed(spark):
    docs = spark.createDataFrame([(k, f"Some words of text {k % 5} " * 50) for k in range(100)] + [(None, None)], "doc_id long, text string")
    blocks = id_text(docs).mapInArrow(suffix_tree_lm._as_blocks, suffix_tree_lm.BLOCKS).collect()
    texts = sum(int(np.frombuffer(r["lengths"], np.int64).sum()) for r in blocks)
    assert 0 < sum(len(r["texts"]) for r in blocks) < texts / 4
    assert sum(len(suffix_tree_lm.Block(r.asDict()).ids) for r in blocks) == 101
    assert sum(int(suffix_tree_lm.Block(r.asDict()).n_words.sum()) for r in blocks) == 100 * 250


def test_dealt_documents_travel_compressed(spark):
    docs = spark.createDataFrame([(k, f"Some words of text {k % 5} " * 50) for k in range(100)], "doc_id long, text string")
    dealt = packing.routed(id_text(docs), 6 << 20)[0].toArrow().combine_chunks().to_batches()
    texts = dict(docs.collect())
    assert sum(len(x) for b in dealt for c in ("text", "dfs") for x in b.column(c).to_pylist()) < sum(map(len, texts.values())) / 4
    back = list(packing._unpacked(iter(dealt), 10_000))
    assert len(back) > 5
    assert {i: t for b in back for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)} == texts
    assert all(len(x) == 4 * len(texts[i].split()) for b in back for i, x in zip(b.column("doc_id").to_pylist(), b.column("dfs").to_pylist(), strict=True))


def _peak_mb(work) -> float:
    work()  # tables that stay are made
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_word_hashes_take_little_memory(spark):
    flat, _, starts, ends, counts = flat_words.spans(pa.array(["some words of a text " * 25_000] * 2))
    assert counts.sum() == 250_000
    assert _peak_mb(lambda: flat_words.hashes(flat, starts, ends)) < 8
    assert sum(x.nbytes for x in flat_words._powers_of(flat_words.MULTIPLIERS[0], 10)) < 4e6
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    anchors.repeated_words(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_stored_tables_leave_no_shuffle_behind(spark):
    shuffles = lambda: {f for f in Path(os.environ.get("SPARK_LOCAL_DIRS", spark.conf.get("spark.local.dir", "/tmp"))).rglob("shuffle_*.data") if f.stat().st_uid == os.getuid()}
    before = shuffles()
    rows = stored(spark.range(1000).repartition(7, "id"), "no-shuffle")
    for _ in range(50):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 1000
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_quality_features_take_little_memory():
    text = "a" * 3500
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array([text] * 2000)], ["doc_id", "text"])
    assert batch.nbytes > 6 << 20
    assert _peak_mb(lambda: list(quality_rules._features(iter([batch])))) < 30


def test_rarest_words_against_sorting():
    rnd = np.random.default_rng(3)
    for n, texts in ((5000, 40), (60, 30), (1, 1), (0, 2)):
        words = rnd.integers(0, 1 << 64, max(2, n // 8), np.uint64)[rnd.integers(0, max(2, n // 8), n)]
        counts = np.diff(np.concatenate([[0], np.sort(rnd.integers(0, n + 1, texts - 1)), [n]]))
        doc = np.repeat(np.arange(texts), counts)
        terms, term = np.unique(words, return_inverse=True)
        if n:
            got = packing._often(words, counts)
            assert [x.tolist() for x in got] == [terms.tolist(), [len(set(doc[term == k].tolist())) for k in range(len(terms))]]
        df = rnd.integers(1, 4, len(terms)).astype(np.uint32)
        wanted = {}
        for d, f, k in sorted(zip(doc.tolist(), df[term].tolist(), term.tolist(), strict=True)):
            if f > 1:
                wanted.setdefault(d, k)
        at, kind = packing._rarest(df[term], term, counts)
        assert dict(zip(at.tolist(), kind.tolist(), strict=True)) == wanted
