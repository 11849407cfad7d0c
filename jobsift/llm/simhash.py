"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint is cut into segments; the number of set bits of each segment is
one coordinate of a vector.  Each differing bit changes one coordinate by one,
so the Manhattan distance of two vectors is at most their bit distance.  A
range join on a grid over those vectors gives the candidates; equality up to
``max_distance`` bits is then checked on the fingerprints themselves.

The grid: ``blocks`` groups of coordinates.  Vectors within distance ``d``
differ in at most ``d`` groups, so they agree in all coordinates of some choice
of ``blocks - d`` groups; each choice is one grid, its coordinates are the cell.

Copies collapse first: one row for each distinct fingerprint enters the grid.
A cell hands on only a spanning forest of its links (fewer than its members),
so a family of near copies never becomes all its pairs, and links between
classes are found as components.

Defined cases: a null or empty text, or one of white space, has fingerprint
zero and is linked like any other; a text of fewer words than a shingle is one
shingle; repeated rows share a fingerprint; a null id never becomes the
smallest of a component unless no other is there; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, rebatched, stored, texts_of
from .components import components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; a bit is
    set if it is set in over half of the shingles' hashes."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        counts += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rebatched(batches, 4 << 20):
            found = np.fromiter((fingerprint(t, shingle) for t in texts_of(batch)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def popcounts(fps: np.ndarray, width: int = 2) -> np.ndarray:
    """Set bits of each segment of ``width`` bits: one row a fingerprint."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fps), 64 // width, width).sum(axis=2, dtype=np.uint8)


def cells(fps: np.ndarray, max_distance: int, blocks: int, width: int) -> np.ndarray:
    """For each fingerprint one cell key for each choice of ``blocks - max_distance`` groups."""
    vectors = popcounts(fps, width).astype(np.uint64)
    edges = np.linspace(0, vectors.shape[1], blocks + 1).astype(int)
    out = []
    with np.errstate(over="ignore"):
        for grid, chosen in enumerate(combinations(range(blocks), blocks - max_distance)):
            key = np.full(len(fps), grid + 1, np.uint64)
            for g in chosen:
                for c in range(edges[g], edges[g + 1]):
                    key = key * np.uint64(0x9E3779B97F4A7C15) + vectors[:, c] + np.uint64(1)
                    key ^= key >> np.uint64(29)
            out.append(key)
    return np.stack(out, axis=1)


def forest(fps: np.ndarray, max_distance: int, width: int) -> np.ndarray:
    """Links of a spanning forest of one cell's fingerprints: (k, 2) places.

    Rows are compared against all rows of the cell in blocks, first by the
    Manhattan distance of the embedding, then by their bits; a link that joins
    two parts that are joined already is not handed on.
    """
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    vectors = popcounts(fps, width).astype(np.int8)
    sums = vectors.sum(axis=1, dtype=np.int16)
    order = np.argsort(sums, kind="stable")  # the sums differ by the distance at most: a band of rows is enough
    sums, fps, vectors = sums[order], fps[order], vectors[order]
    out = []
    step = 256
    for at in range(0, len(fps), step):
        to = int(np.searchsorted(sums, sums[min(at + step, len(fps)) - 1] + max_distance, "right"))
        for low in range(at, to, 8192):
            left, right = slice(at, min(at + step, len(fps))), slice(low, min(low + 8192, to))
            apart = np.bitwise_count(fps[left, None] ^ fps[None, right])
            i, j = np.nonzero(apart <= max_distance)
            i, j = i + left.start, j + right.start
            i, j = i[i < j], j[i < j]
            near = np.abs(vectors[i] - vectors[j]).sum(axis=1) <= max_distance
            for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
                a, b = root(x), root(y)
                if a != b:
                    parent[b] = a
                    out.append((order[x], order[y]))
    return np.array(out, np.int64).reshape(-1, 2)


def links(classes: DataFrame, max_distance: int = 3, blocks: int = 6, width: int = 2) -> DataFrame:
    """``(a, b)``: links that join all fingerprints within ``max_distance`` bits
    of each other.  ``classes``: distinct ``fp`` with a ``node``."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = cells(fps, max_distance, blocks, width)
            n = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(fps.view(np.int64), n)), pa.array(np.repeat(batch.column("node").to_numpy(zero_copy_only=False), n))], ["cell", "fp", "node"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by cell; a cell may go on in the next batch.
        rest = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.concatenate([rest, np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "fp", "node")], axis=1)])
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0])) if len(rows) else 0
            rest = rows[last:]
            yield from found(rows[:last])
        yield from found(rest)

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        ends = np.append(starts[1:], len(rows))
        out = []
        for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            at = forest(rows[a:b, 1].copy().view(np.uint64), max_distance, width)
            if len(at):
                out.append(rows[a:b, 2][at])
        if out:
            pairs = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    celled = classes.mapInArrow(spread, "cell long, fp long, node long")
    return celled.repartition(F.col("cell")).sortWithinPartitions("cell").mapInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3, blocks: int = 6, width: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``docs``."""
    found = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-classes")
    part = components(links(classes.where("node is not null"), max_distance, blocks, width))
    labels = stored(classes.join(part, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")), "simhash-labels")
    return found.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """``docs`` with one document of each group: the one of the smallest id.

    Rows without an id stay (nothing tells them apart); rows that share the
    smallest id of their group are one document and stay.
    """
    labels = near_duplicates(docs, id_col, text_col, shingle, max_distance)
    first = labels.where("doc_id = component_id").select(F.col("doc_id").alias("first_id")).distinct()
    return docs.join(first, docs[id_col].cast("long") == first["first_id"], "left_semi").unionByName(docs.where(F.col(id_col).isNull()))
