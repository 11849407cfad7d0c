"""Language-model scoring with a probabilistic suffix tree.

Symbols are the bytes of a text's words (A to Z lower-cased) joined by a space,
and an end symbol.  The tree's states are contexts of up to ``DEPTH`` symbols.
A context is retained if it was met ``least`` times and the log-likelihood that
its own next-symbol distribution gains over that of the next shorter context
is ``gain`` nats or more.  A retained state's distribution is smoothed with the
shorter one's: ``(count + mu * shorter) / (total + mu)``.  Each symbol is scored
in the longest retained suffix of what stands before it; order 0 and 1 are
always states.

The corpus is first written as blocks of documents.  Each block counts its
distinct symbol strings and words once and sends them, as columns, to ranges of
strings; those add them up over all blocks, the tree is grown for each group of
contexts with the same two last symbols, and every block gets back the values
of its own strings, in its own order.  No count is cut off and nothing that
grows with the corpus passes the driver, which sees two sums and the 256 x 256
counts of orders 0 and 1.

Defined cases: a null or empty text is only its end symbol and end token; rows
are scored one by one, repeated ids included (a null id counts as an empty
string for the split); an empty table gives an empty result; without training
documents every distribution is uniform.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, rebatched, small_batches, stored, texts_of, unzipped, zipped
from .flat_words import hashes, spans

DEPTH = 4
#: Bytes that no UTF-8 text holds: the end of a document, and what stands before it.
END, START = 0xFF, 0xFE
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLOCK_BYTES, PART_BYTES = 4 << 20, 1 << 20

BLOCKS = "block long, doc_ids binary, no_ids binary, lengths binary, texts binary"
COUNTS = "kind int, part int, block long, codes binary, counts binary"


def held_out(doc_id: int | None, modulus: int = 7, remainder: int = 2) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == remainder


def _as_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each few MB of documents; texts are normalised here, and
    compressed as a whole, as they are stored once and shuffled once."""
    number = TaskContext.get().partitionId() << 32
    ids: list = []
    texts: list[bytes] = []
    size = 0

    def row() -> pa.RecordBatch:
        columns = [np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], bool), np.array([len(t) for t in texts], np.int64)]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in columns), pa.array([zipped(b"".join(texts))], pa.binary())], ["block", "doc_ids", "no_ids", "lengths", "texts"])

    for batch in rebatched(batches, BLOCK_BYTES // 4):
        for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
            ids.append(i)
            texts.append(b" ".join(text.translate(LOWER).split()))
            size += len(texts[-1])
        if size >= BLOCK_BYTES:
            yield row()
            ids, texts, size, number = [], [], 0, number + 1
    if ids:
        yield row()


def _codes(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each symbol of the texts, their ends included, it and the ``DEPTH``
    symbols before it as one number.  Every text gets DEPTH start symbols before
    it and the end symbol behind it."""
    n, ends = len(lengths), np.cumsum(lengths)
    s = np.full(len(flat) + n * (DEPTH + 1), START, np.uint8)
    shift = np.repeat(np.arange(n) * (DEPTH + 1) + DEPTH, lengths)
    s[np.arange(len(flat)) + shift] = flat
    last = ends + np.arange(1, n + 1) * (DEPTH + 1) - 1
    s[last] = END
    scored = np.ones(len(s), bool)
    for k in range(DEPTH):
        scored[last - lengths - 1 - k] = False
    code = np.zeros(len(s), np.uint64)
    for k in range(DEPTH, -1, -1):
        code[DEPTH:] = (code[DEPTH:] << np.uint64(8)) | s[DEPTH - k:len(s) - k]
    return code[scored]


class Block:
    """The documents of a row, with their symbol strings and words."""

    def __init__(self, row: dict):
        ids, none = np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["no_ids"], bool)
        self.ids = [None if n else i for i, n in zip(ids.tolist(), none.tolist(), strict=True)]
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.held = np.array([held_out(i) for i in self.ids], bool)
        ends = np.cumsum(lengths)
        texts = unzipped(row["texts"], int(lengths.sum()))
        flat = np.frombuffer(texts, np.uint8)
        n = len(lengths)
        self.symbols = lengths + 1
        self.code = np.empty(len(flat) + n, np.uint64)
        # Each byte is worth several numbers of 8 on the way, so some documents at a time.
        first = 0
        while first < n:
            begin = int(ends[first] - lengths[first])
            past = max(first + 1, int(np.searchsorted(ends, begin + PART_BYTES, "right")))
            self.code[begin + first:int(ends[past - 1]) + past] = _codes(flat[begin:int(ends[past - 1])], lengths[first:past])
            first = past
        offsets = np.append(0, ends).astype(np.int32)
        _, _, a, b, self.n_words = spans(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), texts]))
        self.word = hashes(flat, a, b)

    def distinct(self, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct codes by part order, their training counts, place of each occurrence)."""
        codes, many = (self.code, self.symbols) if kind == 0 else (self.word, self.n_words)
        # A dictionary instead of a sort of all codes, which takes several copies of them.
        coded = pa.array(codes).dictionary_encode()
        found = coded.dictionary.to_numpy()
        order = np.argsort(found)
        rank = np.empty(len(found), np.int32)
        rank[order] = np.arange(len(found), dtype=np.int32)
        place = rank[coded.indices.to_numpy()]
        counts = np.bincount(place[np.repeat(~self.held, many)], minlength=len(found))
        return found[order], counts, place


def _part(codes: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = codes * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int64)


def _by_part(part: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(part, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []


def _counted(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            for kind in (0, 1):
                codes, counts, _ = block.distinct(kind)
                part = _part(codes, parts)
                at = _by_part(part)
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(at), pa.int32()), pa.array([int(part[a[0]]) for a in at], pa.int32()), pa.array([row["block"]] * len(at), pa.int64()), pa.array([codes[a].tobytes() for a in at], pa.binary()), pa.array([counts[a].astype(np.uint32).tobytes() for a in at], pa.binary())], ["kind", "part", "block", "codes", "counts"])


def _sums(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their counts over all rows."""
    codes = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["codes"], np.uint64) for r in rows)])
    counts = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(r["counts"], np.uint32) for r in rows)])
    found, place = np.unique(codes, return_inverse=True)
    return found, np.bincount(place, counts, len(found)).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> list[dict]:
    return [r for b in batches for r in b.to_pylist()]


def _totals(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct strings of a range with their counts, on their way to the
    group of contexts that end in the same two symbols."""
    codes, counts = _sums(_rows(batches))
    if not len(codes):
        return
    part = _part((codes >> np.uint64(8)) & np.uint64(0xFFFF), parts)
    at = _by_part(part)
    pairs = np.bincount((codes & np.uint64(0xFFFF)).astype(np.int64), counts, 1 << 16).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([0] * len(at) + [2], pa.int32()), pa.array([int(part[a[0]]) for a in at] + [0], pa.int32()), pa.array([-1] * (len(at) + 1), pa.int64()), pa.array([codes[a].tobytes() for a in at] + [b""], pa.binary()), pa.array([counts[a].tobytes() for a in at] + [pairs.tobytes()], pa.binary())], ["kind", "part", "block", "codes", "counts"])


def log_probabilities(codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray, mu: float, least: int, gain: float) -> np.ndarray:
    """log10 of each string's last symbol after the others.  ``codes`` holds all
    strings whose contexts end in the same two symbols; ``pairs``: counts of
    order 1, 256 x 256."""
    pairs = pairs.reshape(256, 256).astype(float)
    zero = (pairs.sum(axis=0) + 1) / (pairs.sum() + 256)
    one = (pairs + mu * zero) / (pairs.sum(axis=1, keepdims=True) + mu)
    p = one.reshape(-1)[(codes & np.uint64(0xFFFF)).astype(np.int64)]
    for order in range(2, DEPTH + 1):
        pair, at = np.unique(codes & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
        count = np.bincount(at, counts, len(pair))
        shorter = np.zeros(len(pair))
        shorter[at] = p
        context, of = np.unique(pair >> np.uint64(8), return_inverse=True)
        total = np.bincount(of, count, len(context))
        seen = np.maximum(count, 1e-300)
        gained = np.bincount(of, np.where(count > 0, count * (np.log(seen) - np.log(np.maximum(total[of], 1)) - np.log(shorter)), 0), len(context))
        kept = (total >= least) & (gained >= gain)
        longer = np.where(kept[of], (count + mu * shorter) / (total[of] + mu), shorter)
        p = longer[at]
    return np.log10(p)


def _grown(parts: int, pairs: np.ndarray, mu: float, least: int, gain: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _rows(batches)
    codes = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["codes"], np.uint64) for r in rows)])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in rows)])
    if not len(codes):
        return
    values = log_probabilities(codes, counts, pairs, mu, least, gain)
    part = _part(codes, parts)
    at = _by_part(part)
    yield pa.RecordBatch.from_arrays([pa.array([0] * len(at), pa.int32()), pa.array([int(part[a[0]]) for a in at], pa.int32()), pa.array([-1] * len(at), pa.int64()), pa.array([codes[a].tobytes() for a in at], pa.binary()), pa.array([values[a].tobytes() for a in at], pa.binary())], ["kind", "part", "block", "codes", "counts"])


def _answers(kind: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each block the values of its own strings of this range, in its order."""
    rows = _rows(batches)
    asked = [r for r in rows if r["block"] >= 0]
    if not asked:
        return
    if kind == 0:
        given = [r for r in rows if r["block"] < 0]
        codes = np.concatenate([np.frombuffer(r["codes"], np.uint64) for r in given])
        values = np.concatenate([np.frombuffer(r["counts"], np.float64) for r in given])
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
    else:
        codes, values = _sums(asked)
    blocks, out = [], []
    for r in asked:
        blocks.append(r["block"])
        out.append(values[np.searchsorted(codes, np.frombuffer(r["codes"], np.uint64))].tobytes())
    kinds, part = [kind] * len(out), [r["part"] for r in asked]
    if kind == 1:  # and how many of the words are known
        kinds, part, blocks, out = [*kinds, 3], [*part, 0], [*blocks, -1], [*out, np.array([(values > 0).sum(), values.sum()], np.int64).tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(part, pa.int32()), pa.array(blocks, pa.int64()), pa.array(out, pa.binary())], ["kind", "part", "block", "answer"])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mu: float = 4.0, least: int = 8, gain: float = 8.0) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score, n_symbols."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small_batches(docs.sparkSession)
    blocks = stored(id_text(docs, id_col, text_col).mapInArrow(_as_blocks, BLOCKS), "lm-blocks")
    counted = stored(blocks.mapInArrow(partial(_counted, parts), COUNTS), "lm-counts")
    strings, words = counted.where("kind = 0"), counted.where("kind = 1")
    totals = stored(strings.repartition(parts, "part").mapInArrow(partial(_totals, parts), COUNTS), "lm-totals")
    pairs = np.zeros(1 << 16, np.int64)
    for r in totals.where("kind = 2").select("counts").toLocalIterator():  # 512 KB a range, added one by one
        pairs += np.frombuffer(r["counts"], np.int64)
    grown = totals.where("kind = 0").repartition(parts, "part").mapInArrow(partial(_grown, parts, pairs, mu, least, gain), COUNTS)
    reply = "kind int, part int, block long, answer binary"
    values = strings.unionByName(grown).repartition(parts, "part").mapInArrow(partial(_answers, 0), reply)
    known = words.repartition(parts, "part").mapInArrow(partial(_answers, 1), reply)
    answers = stored(values.unionByName(known), "lm-answers")
    sums = [np.frombuffer(r["answer"], np.int64) for r in answers.where("kind = 3").select("answer").toLocalIterator()]
    trained = sum(int(x) for x in pairs.reshape(256, 256)[:, END].ravel())  # end symbols of training documents
    distinct, tokens = sum(int(x[0]) for x in sums) + (trained > 0), sum(int(x[1]) for x in sums) + trained
    each = answers.where("kind < 3").groupBy("block").agg(F.collect_list(F.struct("kind", "part", "answer")).alias("answers"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                sums, known = [], None
                for kind, many in ((0, block.symbols), (1, block.n_words)):
                    codes, _, place = block.distinct(kind)
                    value = np.zeros(len(codes))
                    part = _part(codes, parts)
                    got = {a["part"]: a["answer"] for a in row["answers"] or () if a["kind"] == kind}
                    for a in _by_part(part):
                        value[a] = np.frombuffer(got[int(part[a[0]])], np.float64 if kind == 0 else np.int64)
                    if kind == 1:
                        known = np.append(0, np.cumsum((value > 0)[place]))
                        value = np.log10((value + 1) / (tokens + distinct + 1))
                    upto = np.append(0, np.cumsum(many))
                    # Sums over each document alone: a running total over a block would cost digits.
                    one = np.append(value[place], 0.0)
                    here = np.add.reduceat(one, upto[:-1]) if len(many) else np.zeros(0)
                    sums.append(np.where(many > 0, here, 0.0))
                ends = np.append(0, np.cumsum(block.n_words))
                n_known = known[ends[1:]] - known[ends[:-1]] + (trained > 0)
                base = sums[1] + np.log10((trained + 1) / (tokens + distinct + 1))
                n = len(block.ids)
                yield pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), pa.array(block.held), pa.array(block.n_words + 1), pa.array(n_known.astype(np.int64)), pa.array(np.full(n, tokens, np.int64)), pa.array(base), pa.array(sums[0]), pa.array(block.symbols)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_symbols"])

    return blocks.join(each.hint("shuffle_hash"), "block", "left").mapInArrow(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_symbols long")
