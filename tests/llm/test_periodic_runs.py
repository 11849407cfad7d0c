"""Run detection against a scan of every lag."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from jobsift.llm import periodic_runs, queries

WORD = re.compile("[^\x20\x09-\x0d]+")


def _runs(words: list) -> list[tuple[int, int, int]]:
    """Every lag, every stretch; a stretch that a shorter lag explains is not of this period."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            if end > at and length >= max(24, 3 * q) and not any(words[at:at + length - p] == words[at + p:at + length] for p in range(1, q)):
                out.append((at, length, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _periodic_text(rnd: random.Random) -> list[str]:
    n, k = rnd.randint(0, 170), rnd.choice([1, 2, 3, 6, 50])
    words = [f"w{rnd.randrange(k)}" for _ in range(n)]
    for _ in range(rnd.randint(0, 4)):
        if n > 30:
            a, p = rnd.randrange(n), rnd.randint(1, 45)
            for i in range(a, min(n, a + rnd.randint(10, 160))):
                words[i] = words[a + (i - a) % p]
    return words


def test_runs_equal_a_scan_of_every_lag():
    rnd = random.Random(2)
    for _ in range(1500):
        words = _periodic_text(rnd)
        known: dict = {}
        codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
        assert periodic_runs.runs(codes) == _runs(words)


def test_every_word_of_a_run_survives_the_splitting():
    rnd = random.Random(4)
    for _ in range(300):
        words = _periodic_text(rnd)
        known: dict = {}
        parts = periodic_runs.surviving(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
        assert all(any(a <= s and s + length <= b for a, b in parts) for s, length, _ in _runs(words))


def test_long_periods_take_no_scan_of_every_lag():
    codes = np.arange(300_000) % 70_000
    assert periodic_runs.runs(codes) == [(0, 300_000, 70_000)]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(6)
    texts = [(i, " ".join(_periodic_text(rnd)) if i % 9 else f"α{i}\t\x0b" * i) for i in range(260)]
    return texts + [(300, None), (301, ""), (302, " \n "), (None, "x " * 40), (7, texts[7][1]), (303, "long " * 60_000), (304, "a b " * 30)]


def test_query_equals_brute_force(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, lang string, runs long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        assert got.setdefault(r["doc_id"], r) == r
    for doc_id, text in rows:
        if doc_id == 303:
            assert got[303]["n_runs"] == 1 and got[303]["period"] == 1
            continue
        words = WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = _runs(words)
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        r = got[doc_id]
        assert r["n_runs"] == len(found)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest()
        from fractions import Fraction
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op13_periodic_runs(spark, str(tmp_path)).count() == 0
