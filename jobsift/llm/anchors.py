"""Substring dedup with difference-cover anchors.

A word goes if it is covered by a window of ``window`` consecutive words whose
word sequence also starts earlier: in a document of smaller id, or earlier in
the same one.

``COVER`` holds residues modulo ``PERIOD`` whose differences make every
residue.  For any two starts of one window there is a shift below the period
that takes both to cover places, so the two share an *aligned anchor*: a
shorter window of ``window - PERIOD + 1`` words that starts at a cover place in
both.  Only windows at cover places are hashed and grouped over the corpus.
Anchors met twice or more are then extended: each full window that holds such
an anchor is hashed (128 bits) and grouped, and every one but the first goes.

Shuffles carry columns of hashes and places in blocks, one row for each pair of
input batch and hash range, and within a batch only the first place of a hash
takes part, so a passage that a third of all documents share sends one entry a
batch.  The places that were combined away are settled where they stand.
Memory is bounded by a batch on the one side, and on the other by the hashes of
one of ``spark.sql.shuffle.partitions`` ranges.

Defined cases: a null or empty text has no word; texts under the window's
length lose nothing; rows with the same id and text are one document (each row
gets its result); different texts under one id are ordered by their hash; a
null id comes before all others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import covered, id_text, rebatched, small_batches, stored
from .flat_words import MULTIPLIERS, hashes, spans, window_hashes

#: A perfect difference set, every residue modulo 13 is a difference of two of these.
PERIOD = 13
COVER = (0, 1, 3, 9)
BATCH = 1 << 20

KEYS = ("doc_id", "text_key")
PLACES = "doc_id long, text_key long, places binary"
SENT = "part int, doc_ids binary, text_keys binary, places binary"
BLOCK = "part int, repeated boolean, h1 binary, h2 binary, doc_ids binary, text_keys binary, places binary"


def _runs(ids: np.ndarray, keys: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a document, with its places."""
    if not len(ids):
        return
    order = np.lexsort((places, keys, ids))
    ids, keys, places = ids[order], keys[order], places[order].astype(np.uint32)
    starts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])]))
    cut = [x.tobytes() for x in np.split(places, starts[1:])]
    yield pa.RecordBatch.from_arrays([pa.array(ids[starts]), pa.array(keys[starts]), pa.array(cut, pa.binary())], ["doc_id", "text_key", "places"])


def _sent(parts: int, ids: np.ndarray, keys: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Places on their way to their documents: a row for each range of documents."""
    if not len(ids):
        return
    with np.errstate(over="ignore"):
        mixed = (ids.view(np.uint64) ^ keys.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    part = ((mixed >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int32)
    order = np.lexsort((places, keys, ids, part))
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    columns = [np.split(x[order], cuts) for x in (ids, keys, places.astype(np.uint32))]
    yield pa.RecordBatch.from_arrays([pa.array(part[order][np.append(0, cuts)]), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in columns)], ["part", "doc_ids", "text_keys", "places"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of a range, with all its places."""
    got: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]]
    for batch in batches:
        for into, c in zip(got, ("doc_ids", "text_keys", "places"), strict=True):
            into += [np.frombuffer(x, into[0].dtype) for x in batch.column(c).to_pylist()]
    yield from _runs(*(np.concatenate(x) for x in got))


def _once(order: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """``order``, which sorts the columns, without entries equal to the one
    before: the places of a row that is listed twice are one place."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in columns:
        x = x[order]
        new[1:] |= x[1:] != x[:-1]
    return order[new]


def _blocks(parts: int, h1: np.ndarray, h2: np.ndarray, ids: np.ndarray, keys: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``BLOCK``: the first place of each hash, by hash range, and
    whether it is the only one; then the other places, which need no partner
    from elsewhere, with part -1."""
    if not len(h1):
        return
    order = _once(np.lexsort((places, keys, ids, h2, h1)), h1, h2, ids, keys, places)
    h1, h2, ids, keys, places = (x[order] for x in (h1, h2, ids, keys, places))
    first = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    single = first & np.append(first[1:], True)
    part = np.where(first, ((h1 >> np.uint64(33)) * np.uint64(parts)) >> np.uint64(31), -1).astype(np.int64)
    rows = []
    group = part * 2 + single
    order = np.argsort(group, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        p = int(part[at[0]])
        at = at[np.lexsort((places[at], keys[at], ids[at]))]
        rows.append((p, not single[at[0]], b"" if p < 0 else h1[at].tobytes(), b"" if p < 0 else h2[at].astype(np.uint32).tobytes(), ids[at].tobytes(), keys[at].tobytes(), places[at].astype(np.uint32).tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), *[pa.binary()] * 5), strict=True)], BLOCK.replace(" int", "").replace(" boolean", "").replace(" binary", "").split(", "))


def _joined(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    kinds = {"h1": np.uint64, "h2": np.uint32, "doc_ids": np.int64, "text_keys": np.int64, "places": np.uint32}
    got: dict[str, list[np.ndarray]] = {k: [np.zeros(0, t)] for k, t in kinds.items()}
    flags = [np.zeros(0, bool)]
    for batch in batches:
        for k, t in kinds.items():
            got[k] += [np.frombuffer(x, t) for x in batch.column(k).to_pylist()]
        flags += [np.full(len(x) // 4, f) for x, f in zip(batch.column("places").to_pylist(), batch.column("repeated").to_pylist(), strict=True)]
    return *(np.concatenate(got[k]) for k in kinds), np.concatenate(flags)


def _apart(order: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]])])


def _repeats(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose hash is found twice or more."""
    h1, _, ids, keys, places, flags = _joined(batches)
    if not len(h1):
        return
    order = np.argsort(h1, kind="stable")
    new = _apart(order, h1, h1)
    many = np.zeros(len(h1), bool)
    many[order] = ~(new & np.append(new[1:], True))
    many |= flags
    yield from _sent(parts, ids[many], keys[many], places[many])


def _later(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose hash is found earlier too."""
    h1, h2, ids, keys, places, _ = _joined(batches)
    if not len(h1):
        return
    order = _once(np.lexsort((places, keys, ids, h2, h1)), h1, h2, ids, keys, places)
    late = order[~_apart(order, h1, h2)]
    yield from _sent(parts, ids[late], keys[late], places[late])


def _settled(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, _, ids, keys, places, _ = _joined(iter([batch]))
        yield from _sent(parts, ids, keys, places)


def _gathered(blocks: DataFrame, step: Callable) -> DataFrame:
    """``(doc_id, text_key, places)`` of what ``step`` finds among each hash
    range, and of the places that were settled before; one row a document."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = blocks.where("part >= 0").repartition(parts, "part").mapInArrow(partial(step, parts), SENT)
    settled = blocks.where("part < 0").mapInArrow(partial(_settled, parts), SENT)
    return found.unionByName(settled).repartition(parts, "part").mapInArrow(_met, PLACES)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> tuple[DataFrame, DataFrame]:
    """(documents with a repeated anchor, with ``text``; ``(doc_id, text_key,
    places)`` of windows that start earlier elsewhere)."""
    short = window - PERIOD + 1
    if short < 1:
        raise ValueError(f"a window needs {PERIOD} words at least")
    small_batches(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs, id_col, text_col)
    at_cover = np.isin(np.arange(PERIOD), COVER)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, BATCH):
            flat, _, starts, ends, counts = spans(batch.column("text"))
            found = window_hashes(hashes(flat, starts, ends), short)
            doc = np.repeat(np.arange(len(counts)), counts)[:len(found)]
            place = (np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts))[:len(found)]
            ok = at_cover[place % PERIOD] & (place + short <= counts[doc]) & (counts[doc] >= window)
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False)[doc[ok]] for c in KEYS)
            yield from _blocks(parts, found[ok], np.zeros(int(ok.sum()), np.uint32), ids, keys, place[ok])

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, BATCH):
            flat, _, starts, ends, counts = spans(batch.column("text"))
            base = np.cumsum(counts) - counts
            wanted = np.zeros(len(starts) + 1, bool)
            for i, at in enumerate(batch.column("places").to_pylist()):
                anchors_at = np.frombuffer(at, np.uint32).astype(np.int64)
                near = (anchors_at[:, None] - np.arange(PERIOD)).reshape(-1)
                wanted[base[i] + near[(near >= 0) & (near + window <= counts[i])]] = True
            at = np.flatnonzero(wanted)
            h1, h2 = (window_hashes(hashes(flat, starts, ends, m), window)[at] for m in MULTIPLIERS)
            doc = np.searchsorted(base + counts, at, "right")
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False)[doc] for c in KEYS)
            yield from _blocks(parts, h1, h2.astype(np.uint32), ids, keys, at - base[doc])

    candidates = _gathered(keyed.mapInArrow(anchors, BLOCK), _repeats)
    held = stored(keyed.join(candidates.hint("shuffle_hash"), list(KEYS)), "anchored")
    return held, _gathered(held.mapInArrow(extended, BLOCK), _later)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed,
    kept_sha256 (of the kept words joined by a space), and the kept text if asked."""
    held, later = repeated_words(docs, id_col, text_col, window)
    more = ", kept_text string" if with_text else ""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, BATCH):
            words = [t.split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            joined = [b" ".join(w) for w in words]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(map(len, words), pa.int64()), pa.array([sha256(x).hexdigest() for x in joined], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array([x.decode() for x in joined], pa.string())] * with_text, ["doc_id", "text_key", "n_words", "kept_sha256", "kept_text"][:4 + with_text])

    def less(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, BATCH):
            out = []
            for text, at in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("places").to_pylist(), strict=True):
                words = text.split()
                gone = covered(np.frombuffer(at, np.uint32).astype(np.int64), window, len(words))
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                out.append((int(gone.sum()), sha256(kept).hexdigest(), kept.decode()))
            removed, digests, texts = zip(*out, strict=True) if out else ((), (), ())
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())] * with_text, ["doc_id", "text_key", "n_removed", "less_sha256", "less_text"][:4 + with_text])

    every = _keyed(docs, id_col, text_col).mapInArrow(whole, f"doc_id long, text_key long, n_words long, kept_sha256 string{more}")
    changed = held.select(*KEYS, "text").distinct().join(later.hint("shuffle_hash"), list(KEYS)).mapInArrow(less, f"doc_id long, text_key long, n_removed long, less_sha256 string{more.replace('kept', 'less')}")
    out = every.join(changed, list(KEYS), "left")
    texts = [F.coalesce("less_text", "kept_text").alias("kept_text")] if with_text else []
    return out.select(F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("less_sha256", "kept_sha256").alias("kept_sha256"), *texts)
