"""Runs of repeating words, found by recursive frequency splitting.

A run is a stretch of consecutive words in which words ``q`` apart are the
same, ``q`` being the smallest such number, of ``max(24, 3 * q)`` words at
least, that no neighbouring word extends.  Each word of a run occurs three
times or more in it.  So a word that occurs less often in a segment lies in no
run of that segment and splits it; the parts are counted anew until no word
splits them.  Most texts have no part of 24 words left then.

The parts that survive are scanned at the lags that can be periods.  Places are
named by the 16, 32, 64, ... words that begin there, each name being the rank of
the pair of names of the two halves, so equal names are equal words.  A run of
period ``q`` holds more than ``q`` places whose next place of the same name is
``q`` away, for the first length of names that is ``q`` at least: no shorter
distance is possible there, as the smallest period would be shorter.  The scan
then follows the lag in both directions, word by word, and so is exact; it
takes a sort for each doubling of the lag.

One document is one unit of work: a task holds it as a few arrays of 8 bytes a
word.  Batches are cut to about 4 MB, a longer document is one by itself.

Defined cases: a null or empty text has no word and no run; repeated rows each
get the same answer; a null id counts as a document whose words are not
rewritten; further columns of any name are left out; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, longs, rebatched, texts_of

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of the first names: a run that matches itself at a lag does so at this many places or more.
FIRST = 16
BATCH_BYTES = 4 << 20
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, n_kept long, collapsed_sha256 string"


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which word of a text of ``n`` stands at each place once a tail of every
    tenth document is made periodic; None where nothing changes."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def surviving(codes: np.ndarray) -> list[tuple[int, int]]:
    """The segments, as (start, end), in which every word occurs ``LEAST_PERIODS``
    times or more; a run lies wholly in one of them."""
    out, waiting = [], [(0, len(codes))]
    while waiting:
        start, end = waiting.pop()
        if end - start < LEAST_WORDS:
            continue
        _, where, counts = np.unique(codes[start:end], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(counts[where] < LEAST_PERIODS)
        if not len(rare):
            out.append((start, end))
            continue
        edges = np.concatenate([[-1], rare, [end - start]])
        wide = np.flatnonzero(np.diff(edges) > LEAST_WORDS)
        waiting += [(start + int(edges[k]) + 1, start + int(edges[k + 1])) for k in wide]
    return sorted(out)


def _pairs_named(names: np.ndarray, step: int) -> np.ndarray:
    """Names of the places by twice as many words."""
    n = len(names) - step
    if n <= 0:
        return names[:0]
    return np.unique(names[:n] * (int(names.max()) + 1) + names[step:], return_inverse=True)[1].astype(np.int64)


def _same(codes: np.ndarray, lag: int, at: int, end: int, step: int) -> int:
    """The first place from ``at`` on, in direction ``step``, whose word is not the one ``lag`` later; ``end`` bounds it."""
    width = 64
    while at != end:
        stop = min(end, at + width) if step > 0 else max(end, at - width)
        lo, hi = (at, stop) if step > 0 else (stop + 1, at + 1)
        differ = np.flatnonzero(codes[lo:hi] != codes[lo + lag:hi + lag])
        if len(differ):
            return lo + int(differ[0] if step > 0 else differ[-1])
        at, width = stop, width * 2
    return end


def _scan(codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the runs in a segment; some come more than once."""
    n = len(codes)
    names, width = np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while width < FIRST:
        names, width = _pairs_named(names, width), width * 2
    below = 0  # lags up to this one were scanned
    while len(names) and below < n // LEAST_PERIODS:
        order = np.argsort(names, kind="stable")
        ranked = names[order]
        same = np.flatnonzero(ranked[1:] == ranked[:-1])
        lags = np.zeros(len(names), np.int64)
        lags[order[same]] = order[same + 1] - order[same]
        lags[(lags <= below) | (lags > width)] = 0
        edges = np.flatnonzero(np.diff(lags, prepend=0, append=0))
        for first, past in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            lag = int(lags[first])
            if lag:
                start = _same(codes, lag, first - 1, -1, -1) + 1 if first else 0
                end = _same(codes, lag, past, n - lag, 1) + lag
                if end - start >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                    yield start, end - start, lag
        below, names, width = width, _pairs_named(names, width), width * 2


def runs(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, which ``codes`` tells apart."""
    return sorted({(a + start, length, q) for a, b in surviving(codes) for start, length, q in _scan(codes[a:b])}, key=lambda r: (r[0], r[2]))


def collapsed(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, q in found:
        steps[start + q] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) == 0


def _found(batches: Iterator[pa.RecordBatch], rewrite: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("n_kept", pa.int64()), ("collapsed_sha256", pa.string())])
    for batch in rebatched(batches, BATCH_BYTES):
        rows = []
        for doc_id, text in zip(longs(batch), texts_of(batch), strict=True):
            words = text.split()
            at = planted(len(words), doc_id) if rewrite else None
            if at is not None:
                words = [words[i] for i in at.tolist()]
            found = []
            if len(words) >= LEAST_WORDS:
                known: dict[bytes, int] = {}
                found = runs(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
                if found:
                    kept = collapsed(len(words), found)
                    words = [w for w, k in zip(words, kept.tolist(), strict=True) if k]
            n = int(kept.size) if found else len(words)
            rows.append({"doc_id": doc_id, "n_words": n, "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in found], "n_kept": len(words), "collapsed_sha256": hashlib.sha256(b" ".join(words)).hexdigest()})
        yield pa.RecordBatch.from_pylist(rows, schema)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = False) -> DataFrame:
    """Every row of ``docs`` with the runs of its whole text by start, then
    period, and the hash of the words that stay when each run keeps its first
    period (joined by one space).  ``rewrite`` first makes a tail of every tenth
    document periodic, as ``planted`` says.  No shuffle: each document is judged
    by itself."""
    return id_text(docs, id_col, text_col).mapInArrow(lambda batches: _found(batches, rewrite), SCHEMA)
