"""Benchmark decontamination by q-gram lemma filtering.

A passage with at most ``k`` edits of an item of ``n`` characters shares at
least ``n + 1 - q * (k + 1)`` character q-grams with it, all on ``k + 1``
neighbouring diagonals (text place minus item place).  Shared q-grams are
counted in overlapping bands of ``2 * (k + 1)`` diagonals; bands that meet the
bound are aligned with banded dynamic programming, and those within ``k`` edits
are passages.

Characters are compared after folding: Latin letters to lower case, each white
space character to a space.  ``k`` is ``error_rate`` of the item's length, or
less if the bound would fall under one q-gram; items shorter than ``2 * q`` are
matched exactly.

A document may quote only a part of an item.  Items longer than ``part_chars``
are therefore also looked for by parts of that many characters, each of which
starts half a part after the one before, by the same bound and alignment.  So
every quote of one and a half parts is found, whatever surrounds it.

The items of the benchmark are a stated query set.  They are taken in blocks
of about ``block_chars`` characters (one item at least; parts take twice as much again), each block held
against all documents in one pass without a shuffle, so the memory of a task
is bounded however large the benchmark is.

Defined cases: null texts and items without a letter or digit match nothing;
repeated rows give their hits each; repeated items too; empty tables give an
empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import rebatched

#: Latin letters to lower case, white space to a space; one byte a character.
FOLD = bytes(x + 32 if 65 <= x <= 90 or 192 <= x <= 222 and x != 215 else 32 if x in b"\t\n\r\x0b\x0c " else x for x in range(256))
#: The same for whole strings, for the final comparison.
FOLD_TEXT = {i: x for i, x in enumerate(FOLD) if i != x}
GAP = b"\x00"
#: Characters of a part; 0: only whole items are looked for.
PART_CHARS = 100
#: What is told of a passage.
FOUND = ("item_id", "first_char", "end_char", "edits", "item_first", "item_end")


def folded(text: str) -> bytes:
    """One byte a character; characters past Latin-1 share one byte, so equal
    characters stay equal and no shared q-gram is lost."""
    return text.encode("latin-1", "replace").translate(FOLD)


def q_grams(flat: bytes, q: int) -> np.ndarray:
    """A 64-bit code of the ``q`` bytes (8 to 16) at each place."""
    n = len(flat) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(flat) + 1,), "<u8", flat + bytes(8), strides=(1,))
    with np.errstate(over="ignore"):
        first, second = eight[:n] * np.uint64(0x9E3779B97F4A7C15), eight[q - 8:q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
        return first + (second ^ (second >> np.uint64(31)))


def edit_budget(n: int, q: int, error_rate: float) -> int:
    """The edits that count as a match of an item of ``n`` characters."""
    return 0 if n < 2 * q else max(0, min(int(error_rate * n), n // q - 1))


def part_starts(n: int, part_chars: int) -> list[int]:
    """Where the parts of an item of ``n`` characters start; the last one ends with the item."""
    return [*range(0, n - part_chars, max(1, part_chars // 2)), n - part_chars] if 0 < part_chars < n else []


def align(item: str, text: str, low: int, width: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``item`` in ``text`` whose
    alignment keeps to diagonals ``low`` to ``low + width - 1``; None beyond ``most``."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    steps = np.arange(width)
    far = len(item) + most + 1

    def inside(j: int) -> np.ndarray:
        at = low + steps + j  # text characters used so far
        return (at >= 0) & (at <= len(codes))

    cost = np.where(inside(0), 0, far)
    start = low + steps
    padded = np.concatenate([codes, [0xFFFFFFFF]])
    for j, letter in enumerate(np.frombuffer(item.encode("utf-32-le"), np.uint32)):
        at = low + steps + j
        differ = padded[np.clip(at, -1, len(codes))] != letter
        change = cost + (differ | (at < 0))
        drop = np.append(cost[1:], far) + 1  # the item's character has no partner
        best = np.minimum(change, drop)
        origin = np.where(change <= drop, start, np.append(start[1:], 0))
        best = np.where(inside(j + 1), np.minimum(best, far), far)
        shifted = best - steps  # the text's characters without a partner
        least = np.minimum.accumulate(shifted)
        where = np.maximum.accumulate(np.where(shifted == least, steps, 0))
        cost, start = np.where(inside(j + 1), least + steps, far), origin[where]
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return (int(cost[best]), int(start[best]), low + best + len(item)) if cost[best] <= most else None


class Index:
    """The q-grams of some items and of their parts.

    ``items``: (item id, text) of whole items, then of parts; ``owner`` tells
    the whole item that each belongs to, ``first`` where it starts there.
    """

    def __init__(self, items: list[tuple[int, str]], q: int, error_rate: float, part_chars: int = 0):
        if 0 < part_chars < 2 * q:
            raise ValueError(f"parts of {part_chars} characters are too short for {q}-grams")
        self.q = q
        self.items = [(i, (t or "").translate(FOLD_TEXT)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if any(c.isalnum() for c in t)]
        self.n_whole = len(self.items)
        self.owner, self.first = list(range(self.n_whole)), [0] * self.n_whole
        for k, (i, t) in enumerate(self.items[:self.n_whole]):
            for at in part_starts(len(t), part_chars):
                if any(c.isalnum() for c in t[at:at + part_chars]):
                    self.items.append((i, t[at:at + part_chars]))
                    self.owner.append(k)
                    self.first.append(at)
        self.budget = np.array([edit_budget(len(t), q, error_rate) for _, t in self.items], np.int64)
        self.short = [k for k, (_, t) in enumerate(self.items) if len(t) < 2 * q]
        self.part_chars = part_chars
        long = [k for k in range(self.n_whole) if len(self.items[k][1]) >= 2 * q]
        grams = [q_grams(folded(self.items[k][1]), q) for k in long]
        grown = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(grown, kind="stable")
        self.grams, self.starts = np.unique(grown[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(grown))
        self.item = np.concatenate([np.full(len(g), k) for k, g in zip(long, grams, strict=True)] or [np.zeros(0, int)])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, int)])[order]
        self.shift = np.uint64(64 - max(16, int(len(self.grams)).bit_length() + 6))
        self.seen = np.zeros(1 << int(64 - self.shift), bool)
        self.seen[self._slot(self.grams)] = True
        lengths = np.array([len(t) for _, t in self.items], np.int64)
        self.bound = np.maximum(1, lengths + 1 - q * (self.budget + 1))
        self.error_rate = error_rate
        # whole item and start of each part, in order, as one number
        self.span = int(lengths.max(initial=0)) + 1
        self.part_key = np.array([o * self.span + f for o, f in zip(self.owner[self.n_whole:], self.first[self.n_whole:], strict=True)], np.int64)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (grams * np.uint64(0xD6E8FEB86659FD93)) >> self.shift

    def bands(self, flat: bytes) -> list[tuple[int, int, int]]:
        """(item, lowest diagonal, width) of the bands of ``flat`` that meet the bound."""
        if not len(self.grams):
            return []
        grams = q_grams(flat, self.q)
        at = np.flatnonzero(self.seen[self._slot(grams)])
        found = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        right = self.grams[found] == grams[at]
        at, found = at[right], found[right]
        many = self.ends[found] - self.starts[found]
        rows = np.repeat(self.starts[found], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item, place = self.item[rows], self.place[rows]
        diagonal = np.repeat(at, many) - place
        found_bands = self._dense(item, diagonal)
        if len(self.items) > self.n_whole:
            # Grams are counted for whole items; only those that could fill a part are dealt to the parts they lie in.
            budget = edit_budget(self.part_chars, self.q, self.error_rate)
            near = self._crowded(item, diagonal // (budget + 1), self.part_chars + 1 - self.q * (budget + 1))
            item, place, diagonal = item[near], place[near], diagonal[near]
            low = np.searchsorted(self.part_key, item * self.span + np.maximum(0, place + self.q - self.part_chars))
            many = np.searchsorted(self.part_key, item * self.span + place, "right") - low
            rows = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found_bands += self._dense(self.n_whole + rows, np.repeat(diagonal, many) + self.part_key[rows] % self.span)
        return found_bands

    @staticmethod
    def _counted(item: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct (item, band), the row of each given one there, and the counts there, in the band after and in the one before."""
        lowest = int(band.min(initial=0)) - 1
        width = int(band.max(initial=0)) - lowest + 2
        keys, where, counts = np.unique(item.astype(np.int64) * width + (band - lowest), return_inverse=True, return_counts=True)
        beside = keys[1:] == keys[:-1] + 1
        after, before = np.append(beside * counts[1:], 0)[:len(keys)], np.append(0, beside * counts[:-1])[:len(keys)]
        return keys // width, keys % width + lowest, where, counts, after, before

    def _crowded(self, item: np.ndarray, band: np.ndarray, bound: int) -> np.ndarray:
        """Which q-grams lie in two neighbouring bands that hold ``bound`` or more."""
        _, _, where, counts, after, before = self._counted(item, band)
        return ((counts + after >= bound) | (counts + before >= bound))[where]

    def _dense(self, item: np.ndarray, diagonal: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, lowest diagonal, width) of the overlapping bands that meet their item's bound."""
        item, band, _, counts, after, before = self._counted(item, diagonal // (self.budget[item] + 1))
        out = [(item[i], band[i]) for i in np.flatnonzero(counts + after >= self.bound[item])]
        out += [(item[i], band[i] - 1) for i in np.flatnonzero((before == 0) & (counts >= self.bound[item]))]
        return [(int(k), int(b * (self.budget[k] + 1)), int(2 * (self.budget[k] + 1))) for k, b in out]

    def passages(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(text, item id, start, end, edits, item start, item end).

        Of hits of one whole item that overlap the best stays.  Parts that lie
        in no hit of their whole item make one passage with the parts they
        overlap, in text and in item; its edits are those of its worst part.
        """
        flats = [folded(t) for t in texts]
        starts = np.cumsum([0, *(len(f) + 1 for f in flats)])
        hits: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
        whole: dict[int, str] = {}
        for k, low, width in self.bands(GAP.join(flats)):
            item, most = self.items[k][1], int(self.budget[k])
            a = int(np.clip(np.searchsorted(starts, low, "right") - 1, 0, len(texts) - 1))
            b = int(np.clip(np.searchsorted(starts, low + width, "right") - 1, 0, len(texts) - 1))
            for d in range(a, b + 1):
                if d not in whole:
                    whole[d] = texts[d].translate(FOLD_TEXT)
                text, here = whole[d], low - int(starts[d])
                left, right = max(0, here), max(0, here + width + len(item))
                near = text[left:right]
                at = near.find(item)
                if at >= 0:
                    hits[d, k].append((0, left + at, left + at + len(item)))
                elif most and (got := align(item, near, here - left, width, most)):
                    hits[d, k].append((got[0], left + got[1], left + got[2]))
        for k in self.short:
            for d, text in enumerate(texts):
                text, at = text.translate(FOLD_TEXT), -1
                while (at := text.find(self.items[k][1], at + 1)) >= 0:
                    hits[d, k].append((0, at, at + len(self.items[k][1])))
        wholes: dict[tuple[int, int], list[tuple]] = defaultdict(list)  # start, end, edits, item start, item end
        parts: dict[tuple[int, int], list[tuple]] = defaultdict(list)
        for (d, k), found in hits.items():
            taken: list[tuple] = []
            for edits, a, b in sorted(set(found)):
                if all(b <= x[0] or x[1] <= a for x in taken):
                    taken.append((a, b, edits, self.first[k], self.first[k] + len(self.items[k][1])))
            (wholes if k < self.n_whole else parts)[d, self.owner[k]] += taken
        for d, k in sorted(wholes.keys() | parts.keys()):
            joined: list[tuple] = []
            for a, b, edits, start, end in sorted(parts[d, k]):
                if any(a < x[1] and x[0] < b for x in wholes[d, k]):
                    continue
                if joined and a < joined[-1][1]:
                    x = joined.pop()
                    a, b, edits, start, end = x[0], max(x[1], b), max(x[2], edits), min(x[3], start), max(x[4], end)
                joined.append((a, b, edits, start, end))
            for found in sorted(wholes[d, k] + joined):
                yield d, self.items[k][0], *found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null")
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-2 * size // block_chars))  # twice as many as needed at least, as they differ in size
    for k in range(n if size else 0):
        yield [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").collect()]


def passages(docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", q: int = 10, error_rate: float = 0.08, part_chars: int = PART_CHARS, block_chars: int = 400_000) -> DataFrame:
    """Rows ``(*columns, item_id, first_char, end_char, edits, item_first, item_end)``, one a passage.

    ``item_first`` and ``item_end``: the characters of the item that the passage holds.
    ``columns``: what to hand on of each document (its id by default).
    """
    columns = columns or ["doc_id"]
    given = docs.select(F.struct(*columns).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([given.schema["doc"], *(T.StructField(c, T.LongType()) for c in FOUND)])
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, item_text_col, block_chars):
        def run(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            index = Index(items, q, error_rate, part_chars)
            for batch in rebatched(batches, 2 << 20):
                found = list(index.passages(batch.column("text").to_pylist()))
                if found:
                    rows = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc").take(rows[0]), *rows[1:]], ["doc", *FOUND])

        out = out.unionByName(given.mapInArrow(run, schema))
    return out.select("doc.*", *FOUND)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", q: int = 10, error_rate: float = 0.08, part_chars: int = PART_CHARS, block_chars: int = 400_000) -> DataFrame:
    """``docs`` without the documents that hold a passage, with all columns.

    Blocks follow one another; each sees what the ones before have kept.
    """
    for items in _blocks(benchmark, "item_id", "text", block_chars):
        names = docs.columns
        given = docs.select(F.struct(*(docs[c] for c in names)).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

        def run(batches: Iterator[pa.RecordBatch], items: list = items) -> Iterator[pa.RecordBatch]:
            index = Index(items, q, error_rate, part_chars)
            for batch in rebatched(batches, 2 << 20):
                hit = {x[0] for x in index.passages(batch.column("text").to_pylist())}
                keep = pa.array([i for i in range(batch.num_rows) if i not in hit], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc").take(keep)], ["doc"])

        docs = given.mapInArrow(run, T.StructType([given.schema["doc"]])).select("doc.*")
    return docs


