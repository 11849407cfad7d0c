"""Packing by lexical retrieval.

Documents are packed into windows of ``width`` ids.  A window opens with a seed
document; its words query a BM25 inverted index, and the best documents that
are still unused follow until the window is full.  The last one is cut and its
rest opens the next window as its seed, so windows have no padding.

Document frequencies and the mean length are those of all documents.  The corpus
is written as blocks; each sends its distinct words with their counts, as
columns, to ranges of words, which add them up and send the sums back.  Then
documents are dealt by the rarest word that they share with another one, so
documents of any two places of the corpus meet.  The index is sharded: a shard
holds documents that come to about ``shard_bytes`` of text, ordered by that
word, and is built, used and dropped by one task.  A group of one word that
fills several shards is dealt to as many.  A seed still sees its own shard only:
a neighbour whose rarest shared word is another one can be in another shard.
What is left at a shard's end is cut at powers of two, which need no padding either.

Defined cases: a null or empty text is just its end id; rows that repeat an id
are packed each; of equal scores the earlier document is taken; documents that
share no word with the seed follow in the shard's order; a document longer than a
window goes on through as many windows as it needs; an empty table gives an
empty result.
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

from .common import id_text, rebatched, stored, unzipped, zipped
from .flat_words import hashes, spans
from .tokens import encoder_of

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK_BYTES = 4 << 20
BLOCKS = "block long, n_docs long, n_words long, n_bytes long, doc_ids array<long>, lengths binary, texts binary"
ROUTED = "route long, salt int, doc_id long, n_bytes int, n_words int, text binary, dfs binary"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, lower-cased; words of each text)."""
    flat, _, starts, ends, counts = spans(texts)
    return hashes(LOWER[flat], starts, ends), counts


def _texts(batch: pa.RecordBatch, row: int) -> pa.Array:
    """The texts of a block, which is stored compressed as a whole."""
    lengths = np.frombuffer(batch.column("lengths")[row].as_py(), np.int32)
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    data = pa.Codec("zstd").decompress(batch.column("texts")[row].as_py(), int(offsets[-1])) if offsets[-1] else pa.py_buffer(b"")
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), data)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for batch in rebatched(batches, BLOCK_BYTES):
        if batch.num_rows:
            texts = batch.column("text")
            raw = texts.cast(pa.binary()).to_pylist()
            lengths = np.array([len(x) for x in raw], np.int32)
            row = [block, batch.num_rows, int(spans(texts)[4].sum()), int(lengths.sum()), batch.column("doc_id").to_pylist(), lengths.tobytes(), pa.Codec("zstd", 3).compress(b"".join(raw), asbytes=True)]
            kinds = [*[pa.int64()] * 4, pa.list_(pa.int64()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], ["block", "n_docs", "n_words", "n_bytes", "doc_ids", "lengths", "texts"])
            block += 1


def _often(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words in ascending order, texts that have each of them): a stable
    sort by word leaves the texts of one word side by side."""
    order = np.argsort(words, kind="stable")
    words, doc = words[order], np.repeat(np.arange(len(counts)), counts)[order]
    new = np.append(True, words[1:] != words[:-1])
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    first = np.flatnonzero(new)
    return words[first], np.add.reduceat(other, first, dtype=np.uint32)


def _counted(parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a block that have each of its words, by range of words."""
    for batch in batches:
        for row in range(batch.num_rows):
            words, counts = _words(_texts(batch, row))
            if not len(words):
                continue
            terms, often = _often(words, counts)
            part = ((terms >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int32)
            cuts = np.flatnonzero(np.diff(part)) + 1
            columns = [pa.array([x.tobytes() for x in np.split(c, cuts)], pa.binary()) for c in (terms, often)]
            at = part[np.append(0, cuts)]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([batch.column("block")[row].as_py()] * len(at), pa.int64()), *columns], ["part", "block", "terms", "often"])


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers compressed with their four bytes apart: the higher ones are
    mostly zero.  Spark's own codec hardly shortens them."""
    return zipped(values.view(np.uint8).reshape(-1, 4).T.tobytes())


def _numbers(planes: bytes | pa.Buffer) -> np.ndarray:
    """The numbers whose four bytes lie apart."""
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.uint32)[:, 0]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The document frequency over all blocks, for each block's words of a range."""
    table = pa.Table.from_batches(held) if (held := list(batches)) else None
    if table is None or not table.num_rows:
        return
    terms = [np.frombuffer(x, np.uint64) for x in table["terms"].to_pylist()]
    often = np.concatenate([np.frombuffer(x, np.uint32) for x in table["often"].to_pylist()])
    kinds, kind = np.unique(np.concatenate(terms), return_inverse=True)
    dfs = np.bincount(kind, often, len(kinds)).astype(np.uint32)[kind]
    cut = np.split(dfs, np.cumsum([len(x) for x in terms])[:-1])
    yield pa.RecordBatch.from_arrays([table["block"].combine_chunks(), table["part"].combine_chunks(), pa.array([len(x) for x in cut], pa.int32()), pa.array([_planes(x) for x in cut], pa.binary())], ["block", "part", "n", "dfs"])


def _rarest(df: np.ndarray, term: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts with a word that another one has, the rarest of these words in each;
    of equally rare ones the first), for the frequency and the number of each word."""
    filled = np.flatnonzero(counts)
    if not len(filled):
        return filled, filled
    packed = np.where(df > 1, df, np.uint32(0xFFFFFFFF)).astype(np.uint64) << np.uint64(32) | term.astype(np.uint64)
    least = np.minimum.reduceat(packed, (np.cumsum(counts) - counts)[filled])
    shared = least >> np.uint64(32) < np.uint64(0xFFFFFFFF)
    return filled[shared], (least[shared] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _routed(mean_bytes: float, shard_bytes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with the frequencies of its words, and the rarest of those
    that another document has."""
    for batch in batches:
        for row in range(batch.num_rows):
            texts, ids = _texts(batch, row), batch.column("doc_ids")[row].values
            words, counts = _words(texts)
            terms, term = np.unique(words, return_inverse=True)
            answers = batch.column("dfs")[row].as_py() or []
            dfs = np.concatenate([np.zeros(0, np.uint32), *(_numbers(unzipped(x["dfs"], 4 * x["n"])) for x in answers)])
            df = dfs[term]
            route, many = np.zeros(len(counts), np.int64), np.ones(len(counts))
            at, kind = _rarest(df, term, counts)
            route[at], many[at] = terms[kind].view(np.int64), dfs[kind]
            salts = np.ceil(many * mean_bytes / shard_bytes).astype(np.int64)
            salt = [zlib.crc32(t) % n if n > 1 else 0 for t, n in zip((f"{i}".encode() for i in ids.to_pylist()), salts.tolist(), strict=True)]
            cut = [_planes(x) for x in np.split(df, np.cumsum(counts)[:-1])]
            raw = texts.cast(pa.binary()).to_pylist()
            sizes = [pa.array([len(x) for x in raw], pa.int32()), pa.array(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(route), pa.array(salt, pa.int32()), ids, *sizes, pa.array([zipped(x) for x in raw], pa.binary()), pa.array(cut, pa.binary())], ["route", "salt", "doc_id", "n_bytes", "n_words", "text", "dfs"])


def _unpacked(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text and dfs of dealt documents as they were before, in slices
    that hold about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        sizes, words = (batch.column(c).to_numpy() for c in ("n_bytes", "n_words"))
        step = max(1, int(batch.num_rows * max_bytes / max(int(sizes.sum()) + 4 * int(words.sum()) + 16 * batch.num_rows, 1)))
        for at in range(0, batch.num_rows, step):
            part, n_bytes = batch.slice(at, step), sizes[at:at + step].tolist()
            texts = [unzipped(x, n) for x, n in zip(part.column("text").to_pylist(), n_bytes, strict=True)]
            dfs = [unzipped(x, 4 * n).to_pybytes() for x, n in zip(part.column("dfs").to_pylist(), words[at:at + step].tolist(), strict=True)]
            offsets = pa.py_buffer(np.append(0, np.cumsum(n_bytes)).astype(np.int32))
            text = pa.StringArray.from_buffers(len(texts), offsets, pa.py_buffer(b"".join(texts)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), text, pa.array(dfs, pa.binary())], ["doc_id", "text", "dfs"])


def routed(docs: DataFrame, shard_bytes: int) -> tuple[DataFrame, int, float]:
    """(documents dealt and ordered by their rarest shared word, with ``dfs``,
    the document frequency of each word, both compressed; documents in all; mean
    words of one)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(docs.mapInArrow(_blocked, BLOCKS), "pack-blocks")
    n, words, size = (x or 0 for x in blocks.agg(F.sum("n_docs"), F.sum("n_words"), F.sum("n_bytes")).first())
    counted = blocks.mapInArrow(partial(_counted, parts), "part int, block long, terms binary, often binary")
    # Stored, so that the words' shuffle goes before the texts are dealt.
    summed = stored(counted.repartition(parts, "part").mapInArrow(_summed, "block long, part int, n int, dfs binary"), "pack-frequencies")
    answers = summed.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "n", "dfs"))).alias("dfs"))
    rows = blocks.join(answers.hint("shuffle_hash"), "block", "left").select("doc_ids", "lengths", "texts", "dfs")
    rows = rows.mapInArrow(partial(_routed, size / max(n, 1), shard_bytes), ROUTED)
    return rows.repartition(parts, "route", "salt").sortWithinPartitions("route", "salt", "doc_id", "text").select("doc_id", "n_bytes", "n_words", "text", "dfs"), n, words / max(n, 1)


class Index:
    """BM25 over the words of one shard's texts, lower-cased; ``dfs`` has the
    document frequency of each word among ``n_docs`` documents of ``mean`` words."""

    def __init__(self, texts: pa.Array, dfs: np.ndarray, n_docs: int, mean: float, k1: float = 1.2, b: float = 0.75):
        words, counts = _words(texts)
        n = len(counts)
        term = pa.array(words).dictionary_encode().indices.to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(n), counts)
        df_of = np.zeros(int(term.max()) + 1 if len(term) else 0)
        df_of[term] = dfs
        pair, often = np.unique(term * n + doc, return_counts=True) if n else (np.zeros(0, np.int64),) * 2
        term, doc = pair // max(n, 1), pair % max(n, 1)
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, int)
        df = np.diff(np.append(first, len(term)))
        idf = np.log1p((n_docs - df_of + 0.5) / (df_of + 0.5))
        length = counts / max(mean, 1e-9)
        weight = idf[np.repeat(np.arange(len(df)), df)] * often * (k1 + 1) / (often + k1 * (1 - b + b * length[doc]))
        shared = np.repeat(df > 1, df)  # a word of one document finds no other
        self.n, self.doc, self.weight = n, doc[shared], weight[shared]
        df = df[df > 1]
        self.first = np.cumsum(df) - df
        self.df = df
        kinds = max(len(df), 1)
        by_doc = np.sort(self.doc * kinds + np.repeat(np.arange(len(df)), df))
        self.terms = by_doc % kinds
        self.terms_from = np.searchsorted(by_doc, np.arange(n + 1) * kinds)

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document for the distinct words of ``seed``."""
        terms = self.terms[self.terms_from[seed]:self.terms_from[seed + 1]]
        many = self.df[terms]
        rows = np.repeat(self.first[terms] - (np.cumsum(many) - many), many)
        rows += np.arange(len(rows))
        return np.bincount(self.doc[rows], self.weight[rows], self.n)


def order(index: Index, lengths: list[int], width: int) -> list[int]:
    """The documents in the order in which they fill the windows."""
    unused = np.ones(index.n, bool)
    out: list[int] = []
    at, next_seed = 0, 0
    scores: np.ndarray | None = None
    window, seed = -1, -1

    def take(doc: int) -> None:
        nonlocal at
        unused[doc] = False
        out.append(doc)
        at += lengths[doc]

    while len(out) < index.n:
        if at // width != window or seed < 0:
            window, scores = at // width, None
            if at % width and out:
                seed = out[-1]  # its rest has opened this window
            else:
                while not unused[next_seed]:
                    next_seed += 1
                seed = next_seed
                take(seed)
                continue
        if scores is None:
            scores = index.scores(seed)
        scores[~unused] = -1.0
        best = int(scores.argmax())
        if scores[best] <= 0:
            while not unused[next_seed]:
                next_seed += 1
            best = next_seed
        take(best)
    return out


def pieces(lengths: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(document, start, length, sequence, offset) of each piece when documents
    of these lengths follow each other: full windows, then powers of two."""
    total = int(lengths.sum())
    edges = list(range(0, total + 1, width))
    rest = total - edges[-1]
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    edges = np.array(edges)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    cuts = np.unique(np.concatenate([edges, ends, [0]]))
    low, high = cuts[:-1], cuts[1:]
    doc = np.searchsorted(ends, low, "right")
    sequence = np.searchsorted(edges, low, "right") - 1
    return doc, low - starts[doc], high - low, sequence, low - edges[sequence]


def pack(docs: DataFrame, path: str, end_id: int = 1, width: int = 2048, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 6 << 20) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence_id = TaskContext.get().partitionId() << 32
        for shard in shards(batches):
            encoder = encoder_of(path)
            texts = shard.column("text")
            dfs = np.concatenate([_numbers(x) for x in shard.column("dfs").to_pylist()])
            ids = [np.append(x, np.uint32(end_id)) for x in encoder.encode(texts)]
            lengths = np.array([len(x) for x in ids], np.int64)
            picked = np.array(order(Index(texts, dfs, n_docs, mean), lengths.tolist(), width))
            doc, start, length, sequence, offset = pieces(lengths[picked], width)
            doc = picked[doc]
            crc = [zlib.crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = [start, length, crc, lengths[doc], sequence + sequence_id, offset]
            yield pa.RecordBatch.from_arrays([shard.column("doc_id").take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in columns)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            sequence_id += int(sequence[-1]) + 1

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in _unpacked(batches, shard_bytes // 8):
            if batch.num_rows:
                held.append(batch)
                size += batch.column("text").nbytes
            if size >= shard_bytes:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    rows, n_docs, mean = routed(id_text(docs, id_col, text_col), shard_bytes)
    return rows.mapInArrow(run, SCHEMA)
