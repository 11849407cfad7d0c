"""Token-id files of independent zstandard frames.

A file holds one frame for each document (more for a very long one), each of
unsigned little-endian 32-bit ids.  A skippable frame then lists the documents
(id and number of frames), and a seek table closes the file in the public
seekable format: compressed size, size and checksum (low half of XXH64) of
each frame.  A reader takes the end of the file and then only the frames it
wants; any zstandard tool can decompress the whole.

Documents are range-partitioned and sorted by id, one file a partition, so the
files in order hold all ids in ascending order.  A file is written under a name
of its attempt and moved to its own name when whole: a task that runs again
puts the same bytes in the same place.

Defined cases: a null or empty text is just its end id; rows that repeat an id
follow each other, ordered by their text's hash; null ids come first and are
read back as null; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import id_text, rebatched
from .tokens import encoder_of

#: Fixed values of the public formats.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKED = 0x80
FRAME_IDS = 1 << 20
NO_ID = -(1 << 63)


def _system(path: str):  # noqa: ANN202
    from pyarrow.fs import FileSystem, LocalFileSystem

    return (LocalFileSystem(), path) if path.startswith("/") else FileSystem.from_uri(path)


class Writer:
    """Appends documents to an open binary file."""

    def __init__(self, sink, level: int = 3):  # noqa: ANN001
        self.sink, self.compressor = sink, zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.documents: list[tuple[int, int]] = []
        self.frames: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        cuts = range(0, max(len(ids), 1), FRAME_IDS)
        for at in cuts:
            raw = ids[at:at + FRAME_IDS].astype("<u4").tobytes()
            frame = self.compressor.compress(raw)
            self.sink.write(frame)
            self.frames.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.documents.append((NO_ID if doc_id is None else doc_id, len(cuts)))

    def close(self) -> None:
        listed = np.array(self.documents, "<i8").tobytes()
        self.sink.write(struct.pack("<II", SKIPPABLE, len(listed)) + listed)
        table = np.array(self.frames, "<u4").reshape(-1, 3).tobytes() + struct.pack("<IBI", len(self.frames), CHECKED, SEEKABLE)
        self.sink.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)


class Reader:
    """Reads a file's documents; ``source`` can seek."""

    def __init__(self, source):  # noqa: ANN001
        self.source = source
        size = source.seek(0, 2)
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or not flags & CHECKED:
            raise ValueError("no seek table with checksums at the end of the file")
        begin = size - 9 - 12 * n - 8
        source.seek(begin)
        if struct.unpack("<II", source.read(8)) != (SEEK_TABLE, 12 * n + 9):
            raise ValueError("damaged seek table")
        self.frames = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3)
        self.places = np.cumsum(np.append(0, self.frames[:, 0].astype(np.int64)))
        source.seek(int(self.places[-1]))
        magic, length = struct.unpack("<II", source.read(8))
        if magic != SKIPPABLE or self.places[-1] + 8 + length != begin:
            raise ValueError("damaged document list")
        self.documents = np.frombuffer(source.read(length), "<i8").reshape(-1, 2)
        self.first = np.cumsum(self.documents[:, 1]) - self.documents[:, 1]
        self.decompressor = zstandard.ZstdDecompressor()

    def _frame(self, k: int) -> bytes:
        self.source.seek(int(self.places[k]))
        raw = self.decompressor.decompress(self.source.read(int(self.frames[k, 0])))
        if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
            raise ValueError(f"frame {k} does not meet its checksum")
        return raw

    def ids(self, place: int) -> np.ndarray:
        """The ids of the document at this place of the file."""
        first, many = int(self.first[place]), int(self.documents[place, 1])
        return np.frombuffer(b"".join(self._frame(k) for k in range(first, first + many)), "<u4")

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of the documents of this id; no other frame is decompressed."""
        low, high = np.searchsorted(self.documents[:, 0], [doc_id, doc_id + 1])
        return [self.ids(k) for k in range(int(low), int(high))]


def write(docs: DataFrame, folder: str, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> DataFrame:
    """Write the files into ``folder`` (shared by all executors); returns the
    manifest: file_no, file, n_docs, n_ids, first_id, last_id."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = context.partitionId()
        system, root = _system(folder)
        system.create_dir(root, recursive=True)
        attempt, encoder, written = f"{root}/.attempt-{number}-{context.taskAttemptId()}", None, 0
        sink = writer = None
        for batch in rebatched(batches, 4 << 20):
            if not batch.num_rows:
                continue
            if writer is None:
                encoder, sink = encoder_of(path), system.open_output_stream(attempt)
                writer = Writer(sink)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                writer.add(doc_id, np.append(ids, np.uint32(end_id)))
                written += len(ids) + 1
        if writer:
            writer.close()
            sink.close()
            name = f"part-{number:05d}.zst"
            system.move(attempt, f"{root}/{name}")
            ids = [x[0] for x in writer.documents]
            yield pa.RecordBatch.from_pylist([{"file_no": number, "file": f"{folder}/{name}", "n_docs": len(ids), "n_ids": written, "first_id": ids[0], "last_id": ids[-1]}])

    ordered = id_text(docs, id_col, text_col).withColumn("key", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(files, "doc_id", "key").sortWithinPartitions("doc_id", "key").select("doc_id", "text")
    rows = ordered.mapInArrow(run, "file_no long, file string, n_docs long, n_ids long, first_id long, last_id long").collect()  # one row a file
    return spark.createDataFrame(sorted(rows), "file_no long, file string, n_docs long, n_ids long, first_id long, last_id long")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32; a task a file, a document at a time."""
    before = F.coalesce(F.sum("n_ids").over(W.orderBy("file_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row a file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, place = _system(name)
                with system.open_input_file(place) as source:
                    reader = Reader(source)
                    rows: list[tuple] = []
                    for k, doc_id in enumerate(reader.documents[:, 0].tolist()):
                        ids = reader.ids(k)
                        rows.append((None if doc_id == NO_ID else doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 8192:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.withColumn("start", before)
    n = max(1, manifest.count())
    return files.select("file_no", "file", "start").repartition(n, "file_no").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def documents_of(spark: SparkSession, manifest: DataFrame, wanted: Iterable[int]) -> dict[int, list[np.ndarray]]:
    """The ids of a few documents: only their files are opened, only their frames decompressed."""
    out: dict[int, list[np.ndarray]] = {}
    wanted = sorted(set(wanted))
    for r in manifest.collect():
        if here := [w for w in wanted if r["first_id"] <= w <= r["last_id"]]:
            system, place = _system(r["file"])
            with system.open_input_file(place) as source:
                reader = Reader(source)
                for w in here:
                    out.setdefault(w, []).extend(reader.find(w))
    return out


def shared_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_path(spark, name)}-{uuid.uuid4().hex[:12]}"
