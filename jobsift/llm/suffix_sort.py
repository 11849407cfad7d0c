"""Removal of repeated byte strings by external induced suffix sorting.

A byte goes if it is covered by a string of ``width`` bytes that also starts
anywhere else, in the same document or another, overlaps included; strings are
judged on the input.

*Shards.*  Each window of ``width`` bytes has a minimizer: the place of its
smallest ``GRAM``-byte hash (the leftmost of equals), which depends on the
window's bytes alone.  Neighbouring windows with one minimizer make a segment.
Equal windows have equal minimizers, so they meet in the shard that the
minimizer's hash names; a shard's segments are all it needs.

*What need not be sorted.*  Only entries (minimizer, hash of the segment, place)
are shuffled first, one for each distinct segment of an input slice.  A segment
whose minimizer is found once cannot repeat; one that is found twice or more,
byte for byte (128 bits of hash), repeats as a whole.  What is left, segments
that share a minimizer but differ, meets by shard: their texts are fetched.
Equal windows lie alike about their minimizer, so segments of which no stretch
of ``width - STEP`` bytes, at one of the places ``STEP`` apart about the
minimizer, is found in another one have no common window and are left out; of
the others the windows about such stretches stay.  The suffixes of what stays
are sorted by recursive induction with queues that go to disk and carry the
common prefixes; a window repeats if a neighbour in that order shares ``width``
bytes with it.

Defined cases: a null or empty text has no byte; texts under ``width`` bytes
lose nothing; rows with the same id and text are one document (each row gets
its result), so a document does not repeat itself by being listed twice; texts
under one id are told apart by their hash; a null id is an id of its own; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, id_text, rebatched, stored
from .flat_words import MULTIPLIERS, _VALUES, _powers_of
from .induced_sorting import suffix_order

GRAM = 32
STEP = 16
BATCH = 1 << 20
SORTED = 1 << 20
NO_ID = -(1 << 63)
KEYS = ("doc_id", "text_key")
ENTRY = np.dtype([("anchor", "<u8"), ("h1", "<u8"), ("h2", "<u8"), ("doc_id", "<i8"), ("text_key", "<i8"), ("start", "<i8"), ("many", "<i8"), ("seen", "<i8")])
#: A note to a document: windows start .. start + many - 1 repeat, or, if wanted, its bytes go to shard ``anchor``.
NOTE = np.dtype([("doc_id", "<i8"), ("text_key", "<i8"), ("start", "<i8"), ("many", "<i8"), ("anchor", "<u8"), ("wanted", "<i8")])
SENT = "part int, notes binary"


def _rolled(flat: np.ndarray, multiplier: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that gives the hash of flat[a:b], for arrays a and b."""
    up, down = _powers_of(multiplier, len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[flat] * up[:len(flat)], out=sums[1:])

    def of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (sums[b] - sums[a]) * down[a]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            return h ^ (h >> np.uint64(29))

    return of


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by blocks of ``width``."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def segments(flat: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimizer's hash, two hashes of the bytes) of each segment."""
    nothing = np.zeros(0, np.int64)
    if len(flat) < width:
        return nothing, nothing, nothing, *[np.zeros(0, np.uint64)] * 3
    first, second = (_rolled(flat, m) for m in MULTIPLIERS)
    places = np.arange(len(flat) - GRAM + 1)
    grams = first(places, places + GRAM)
    bits = np.uint64(max(1, len(flat).bit_length()))
    least = _sliding_least(((grams >> bits) << bits) | places.astype(np.uint64), width - GRAM + 1)
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)[:len(at)]
    ok = np.arange(len(at)) + width <= offsets[1:][text]
    key = np.where(ok, at, -1)
    begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])]))
    end = np.append(begin[1:], len(key))
    begin, end = begin[key[begin] >= 0], end[key[begin] >= 0]
    to = end + width - 1
    return text[begin], begin - offsets[text[begin]], end - begin, grams[at[begin]], first(begin, to), second(begin, to)


def _part(values: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int64)


def _split(part: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    return pa.RecordBatch.from_arrays([pa.array(part[order][np.append(0, cuts)], pa.int32()), pa.array([x.tobytes() for x in np.split(rows[order], cuts)], pa.binary())], ["part", "notes"])


def _notes(parts: int, rows: np.ndarray, wanted: int) -> Iterator[pa.RecordBatch]:
    if len(rows):
        out = np.zeros(len(rows), NOTE)
        for c in ("doc_id", "text_key", "start", "many", "anchor"):
            out[c] = rows[c]
        out["wanted"] = wanted
        yield _split(_part(out["doc_id"].view(np.uint64) ^ out["text_key"].view(np.uint64), parts), out)


def _gathered(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for b in batches for x in b.column("notes").to_pylist())])


def _same(rows: np.ndarray) -> np.ndarray:
    """Rows in order of their bytes: true where other bytes begin."""
    return np.concatenate([[True], (rows["anchor"][1:] != rows["anchor"][:-1]) | (rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])])


def _ordered(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort((rows["start"], rows["text_key"], rows["doc_id"], rows["h2"], rows["h1"], rows["anchor"]))]


def _scanned(parts: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries by shard; those of a slice's equal segments after the first are
    settled at once, with part -1 - (part of their document)."""
    for batch in rebatched(batches, BATCH):
        flat, offsets = flat_bytes(batch.column("text"))
        text, start, many, anchor, h1, h2 = segments(flat, offsets, width)
        if not len(text):
            continue
        rows = np.zeros(len(text), ENTRY)
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEYS)
        rows["anchor"], rows["h1"], rows["h2"], rows["doc_id"], rows["text_key"], rows["start"], rows["many"] = anchor, h1, h2, ids[text], keys[text], start, many
        rows = _ordered(rows)
        # The same place of the same document, when a row is listed twice, counts once.
        rows = rows[np.concatenate([[True], rows[1:] != rows[:-1]])]
        new = _same(rows)
        heads = np.flatnonzero(new)
        rows["seen"][heads] = np.diff(np.append(heads, len(rows)))
        yield _split(_part(rows["anchor"][heads], parts), rows[heads])
        for settled in _notes(parts, rows[~new], 0):
            yield pa.RecordBatch.from_arrays([pa.array([-1 - p for p in settled.column("part").to_pylist()], pa.int32()), settled.column("notes")], ["part", "notes"])


def _met(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Notes on segments that repeat as a whole, and on those to be sorted."""
    rows = _gathered(batches, ENTRY)
    if not len(rows):
        return
    rows = _ordered(rows)
    place = ["anchor", "h1", "h2", "doc_id", "text_key", "start"]
    again = np.append(False, rows[place][1:] == rows[place][:-1])  # a row listed twice, in other slices
    rows = rows[~again]
    new = _same(rows)
    heads = np.flatnonzero(new)
    content = np.cumsum(new) - 1
    found = np.add.reduceat(rows["seen"], heads)
    yield from _notes(parts, rows[found[content] > 1], 0)
    anchors = rows["anchor"][heads]
    kinds = np.cumsum(np.concatenate([[True], anchors[1:] != anchors[:-1]])) - 1
    shared = np.bincount(kinds)[kinds] > 1
    yield from _notes(parts, rows[heads[shared]], 1)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document, with its notes."""
    rows = _gathered(batches, NOTE)
    if len(rows):
        rows = rows[np.lexsort((rows["start"], rows["text_key"], rows["doc_id"]))]
        heads = np.flatnonzero(np.concatenate([[True], (rows["doc_id"][1:] != rows["doc_id"][:-1]) | (rows["text_key"][1:] != rows["text_key"][:-1])]))
        yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"][heads].copy()), pa.array(rows["text_key"][heads].copy()), pa.array([x.tobytes() for x in np.split(rows, heads[1:])], pa.binary())], ["doc_id", "text_key", "notes"])


def _fetched(parts: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of segments to be sorted, by shard."""
    for batch in rebatched(batches, BATCH):
        out: list[tuple] = []
        for text, notes in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("notes").to_pylist(), strict=True):
            notes = np.frombuffer(notes, NOTE)
            notes = notes[notes["wanted"] == 1]
            for part, n in zip(_part(notes["anchor"], parts).tolist(), notes, strict=True):
                out.append((part, n.tobytes(), text[n["start"]:n["start"] + n["many"] + width - 1]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["part", "notes", "bytes"])


def _shared_stretches(width: int, anchors: np.ndarray, many: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, end of windows) of the segments, texts given in
    order of their minimizers, that share a stretch with another of the same
    minimizer.  A window that begins ``back`` bytes before the minimizer covers
    the stretch that begins ``back // STEP * STEP`` bytes before it; equal
    windows cover equal stretches."""
    sizes = np.array([len(t) for t in texts])
    base = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(texts), np.uint8)
    hashed = _rolled(flat, MULTIPLIERS[0])
    # The minimizer is the leftmost place in the first window with its hash.
    near = base[:, None] + np.arange(width - GRAM + 1)
    back = (hashed(near.reshape(-1), near.reshape(-1) + GRAM).reshape(near.shape) == anchors[:, None]).argmax(axis=1)
    low = np.maximum(back - many + 1, 0) // STEP
    count = back // STEP - low + 1
    of = np.repeat(np.arange(len(texts)), count)
    stretch = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = base[of] + back[of] - stretch * STEP
    h = hashed(at, at + width - STEP)
    order = np.lexsort((h, stretch, anchors[of]))
    a, j, x = anchors[of][order], stretch[order], h[order]
    equal = (a[1:] == a[:-1]) & (j[1:] == j[:-1]) & (x[1:] == x[:-1])
    found = np.zeros(len(of), bool)
    found[order] = np.append(equal, False) | np.append(False, equal)
    of, stretch = of[found], stretch[found]
    kept, heads = np.unique(of, return_index=True)
    if not len(kept):
        return kept, kept, kept
    first = np.maximum(back[kept] - np.maximum.reduceat(stretch, heads) * STEP - STEP + 1, 0)
    return kept, first, np.minimum(back[kept] - np.minimum.reduceat(stretch, heads) * STEP + 1, many[kept])


def _sorted(parts: int, width: int, most_held: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Notes on the windows of a shard's segments that repeat among them."""
    notes, texts = [], []
    for batch in batches:
        notes += batch.column("notes").to_pylist()
        texts += batch.column("bytes").to_pylist()
    rows = np.frombuffer(b"".join(notes), NOTE)
    order = np.argsort(rows["anchor"], kind="stable")
    rows, texts = rows[order], [texts[i] for i in order.tolist()]
    # Segments of one minimizer stay together; as many minimizers as come to SORTED bytes are sorted at once.
    fresh = np.append(True, rows["anchor"][1:] != rows["anchor"][:-1])[:len(rows)]
    begin = size = 0
    for k, text in enumerate(texts):
        if size >= SORTED and fresh[k]:
            yield from _sorted_run(parts, width, most_held, rows[begin:k], texts[begin:k])
            begin, size = k, 0
        size += len(text)
    if texts:
        yield from _sorted_run(parts, width, most_held, rows[begin:], texts[begin:])


def _sorted_run(parts: int, width: int, most_held: int, rows: np.ndarray, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    kept, first, end = _shared_stretches(width, rows["anchor"], rows["many"], texts)
    if not len(kept):
        return
    rows = rows[kept].copy()
    rows["start"] += first
    rows["many"] = end - first
    cut = [texts[k][a:b + width - 1] for k, a, b in zip(kept.tolist(), first.tolist(), end.tolist(), strict=True)]
    # What is now equal as a whole repeats; one of each is sorted with the others.
    number: dict[bytes, int] = {}
    group = np.array([number.setdefault(t, len(number)) for t in cut])
    heads = np.unique(group, return_index=True)[1]
    whole = np.bincount(group)[group] > 1
    yield from _notes(parts, rows[whole], 0)
    rows, texts = rows[heads], list(number)
    if len(texts) < 2:
        return
    # Segment k ends in a symbol of its own; the smallest one ends the whole.
    n = len(texts)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    s = np.zeros(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(s), bool)
    inside[ends] = False
    s[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + n
    s[ends] = np.arange(n)[::-1]
    order, common = suffix_order(s, most_held)
    long = common >= width
    repeated = np.zeros(len(s), bool)
    repeated[order[long]] = True
    repeated[order[np.flatnonzero(long) - 1]] = True
    edge = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(begin):
        of = np.searchsorted(ends, begin)
        out = rows[of].copy()
        out["start"] += begin - (ends[of] - sizes[of])
        out["many"] = end - begin
        yield from _notes(parts, out, 0)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 400, most_held: int = 4_000_000, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 (of the bytes that stay), and these bytes if asked."""
    if width <= GRAM:
        raise ValueError(f"a string needs more than {GRAM} bytes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    entries = keyed.mapInArrow(partial(_scanned, parts, width), SENT)
    entries = stored(entries, "segments")
    noted = entries.where("part >= 0").repartition(parts, "part").mapInArrow(partial(_met, parts), SENT).unionByName(entries.where("part < 0").select((-1 - F.col("part")).alias("part"), "notes"))
    per_document = noted.repartition(parts, "part").mapInArrow(_documents, "doc_id long, text_key long, notes binary")
    held = stored(keyed.join(per_document.hint("shuffle_hash"), list(KEYS)), "noted")
    # A document that is listed twice sends its segments once: distinct.
    fetched = held.mapInArrow(partial(_fetched, parts, width), "part int, notes binary, bytes binary").distinct()
    more = fetched.repartition(parts, "part").mapInArrow(partial(_sorted, parts, width, most_held), SENT)
    more = more.repartition(parts, "part").mapInArrow(_documents, "doc_id long, text_key long, notes binary").withColumnRenamed("notes", "more")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, BATCH):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(map(len, texts), pa.int64()), pa.array([sha256(t).hexdigest() for t in texts], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.binary())] * with_text, ["doc_id", "text_key", "n_bytes", "kept_sha256", "kept"][:4 + with_text])

    def less(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, BATCH):
            out = []
            for text, a, b in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("notes").to_pylist(), batch.column("more").to_pylist(), strict=True):
                notes = np.concatenate([np.frombuffer(a, NOTE), np.frombuffer(b or b"", NOTE)])
                notes = notes[notes["wanted"] == 0]
                steps = np.zeros(len(text) + 1, np.int64)
                np.add.at(steps, notes["start"], 1)
                np.add.at(steps, notes["start"] + notes["many"] + width - 1, -1)
                gone = np.cumsum(steps[:len(text)]) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((int(gone.sum()), int((np.diff(np.append(0, gone.astype(np.int8))) == 1).sum()), sha256(kept).hexdigest(), kept))
            removed, spans, digests, texts = zip(*out, strict=True) if out else ((),) * 4
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.binary())] * with_text, ["doc_id", "text_key", "n_removed", "n_spans", "less_sha256", "less"][:5 + with_text])

    binary = " binary" if with_text else ""
    every = keyed.mapInArrow(whole, "doc_id long, text_key long, n_bytes long, kept_sha256 string" + f", kept{binary}" * with_text)
    changed = held.join(more.hint("shuffle_hash"), list(KEYS), "left").mapInArrow(less, "doc_id long, text_key long, n_removed long, n_spans long, less_sha256 string" + f", less{binary}" * with_text).distinct()
    out = every.join(changed, list(KEYS), "left")
    last = [F.coalesce("less", "kept").alias("kept")] if with_text else []
    return out.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_bytes", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")), F.coalesce("less_sha256", "kept_sha256").alias("kept_sha256"), *last)
