"""Token files of independent zstandard frames with a trailing seek table.

A file holds the ids of a range of documents in ascending doc_id order:

    data frames          each an independent zstandard frame of some whole documents
    index                skippable frame 0x184D2A5D, per frame: first document's place
                         in the file, first and last doc_id
    seek table           skippable frame 0x184D2A5E, per frame: compressed size,
                         size, checksum; then frame count, descriptor, 0x8F92EAB1

The seek table is that of zstandard's seekable format: checksums are the low 32 bits
of XXH64 over the frame's content.  The content of a frame is, little-endian: number of
documents (u32), per document whether it has an id (u8), doc_id (i64) and number of token
ids (u32), then all token ids (u32).  A reader takes the two tables from the end of the
file and reads, checks and decompresses only the frames that hold what it was asked for.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_dir
from .common import as_batch, stored
from .tokens import encoder

INDEX_MAGIC, TABLE_MAGIC, END_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
TABLE_ENTRY, INDEX_ENTRY = struct.Struct("<III"), struct.Struct("<qqq")
FOOTER, SKIPPABLE = struct.Struct("<IBI"), struct.Struct("<II")
NO_ID = -(1 << 63)
DOCUMENT = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("n", "<u4")])


@dataclass(frozen=True)
class Settings:
    """``frame``: bytes of content after which a frame is closed."""

    frame: int = 1 << 17
    level: int = 3
    end_id: int = 2


class Writer:
    """Writes one file to a stream opened for writing."""

    def __init__(self, out, settings: Settings = Settings()) -> None:
        import zstandard

        self.out, self.settings = out, settings
        self.compressor = zstandard.ZstdCompressor(level=settings.level)
        self.docs: list[tuple[int | None, bytes]] = []
        self.held = self.documents = self.tokens = 0
        self.table, self.index = [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, ids))
        self.held += len(ids)
        if self.held >= self.settings.frame:
            self.close_frame()

    def close_frame(self) -> None:
        if not self.docs:
            return
        keys = [NO_ID if d is None else d for d, _ in self.docs]
        head = np.array(
            [(d is not None, k, len(x) // 4) for (d, x), k in zip(self.docs, keys)], dtype=DOCUMENT
        )
        content = struct.pack("<I", len(head)) + head.tobytes() + b"".join(x for _, x in self.docs)
        packed = self.compressor.compress(content)
        self.out.write(packed)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.index.append((self.documents, keys[0], keys[-1]))
        self.documents += len(head)
        self.tokens += int(head["n"].sum())
        self.docs, self.held = [], 0

    def close(self) -> None:
        self.close_frame()
        index = b"".join(INDEX_ENTRY.pack(*e) for e in self.index)
        table = b"".join(TABLE_ENTRY.pack(*e) for e in self.table)
        table += FOOTER.pack(len(self.table), CHECKSUMS, END_MAGIC)
        self.out.write(SKIPPABLE.pack(INDEX_MAGIC, len(index)) + index)
        self.out.write(SKIPPABLE.pack(TABLE_MAGIC, len(table)) + table)


class Reader:
    """Reads a file through a seekable stream, only what is asked for."""

    def __init__(self, source) -> None:
        import zstandard

        self.source, self.decompressor = source, zstandard.ZstdDecompressor()
        self.read_frames = 0
        size = source.seek(0, io.SEEK_END)
        n, descriptor, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != END_MAGIC or descriptor != CHECKSUMS:
            raise ValueError("not a token file")
        at = size - FOOTER.size - n * TABLE_ENTRY.size
        self.table = list(TABLE_ENTRY.iter_unpack(self._at(at, n * TABLE_ENTRY.size)))
        at -= SKIPPABLE.size + n * INDEX_ENTRY.size
        self.index = list(INDEX_ENTRY.iter_unpack(self._at(at, n * INDEX_ENTRY.size)))
        self.starts = np.concatenate([[0], np.cumsum([t[0] for t in self.table])]).astype(np.int64)

    def _at(self, at: int, size: int) -> bytes:
        self.source.seek(int(at))
        return self.source.read(size)

    def frame(self, k: int) -> Iterator[tuple[int | None, bytes]]:
        packed, size, checksum = self.table[k]
        content = self.decompressor.decompress(self._at(self.starts[k], packed), max_output_size=size)
        self.read_frames += 1
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        (n,) = struct.unpack_from("<I", content)
        head = np.frombuffer(content, DOCUMENT, n, 4)
        at = 4 + n * DOCUMENT.itemsize
        for known, doc_id, tokens in head.tolist():
            yield (doc_id if known else None), content[at : at + 4 * tokens]
            at += 4 * tokens

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """All documents, or those with a wanted doc_id, from as few frames as hold them."""
        asked = None if wanted is None else np.array(sorted(wanted), dtype=np.int64)
        for k, (_, first, last) in enumerate(self.index):
            if asked is None:
                yield from self.frame(k)
                continue
            at = np.searchsorted(asked, first)
            if at < len(asked) and asked[at] <= last:
                yield from (d for d in self.frame(k) if d[0] in wanted)


def opened(path: str):
    """The file system of a path (local or any store Arrow knows) and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_files(docs: DataFrame, folder: str, settings: Settings = Settings(), vocabulary: str | None = None) -> DataFrame:
    """Tokenize and write all documents in ascending doc_id order.

    Returns the list of files ``(file_no, path, documents, tokens)``.  A file covers the
    doc_ids of one range partition.  Each attempt of a task writes a file of its own, and
    only those of finished tasks are listed.  Documents without doc_id come first; equal
    doc_ids are ordered by a hash of their text, which also cuts the ranges, so that a
    doc_id of very many rows, or none, is dealt over several files.
    """
    end = np.array([settings.end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        encode, writer, out = encoder(vocabulary).encode, None, None
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                if writer is None:
                    store, inside = opened(folder)
                    store.create_dir(inside, recursive=True)
                    name = f"tokens-{number:06d}-{uuid.uuid4().hex}.zst"
                    out = store.open_output_stream(f"{inside}/{name}", compression=None)
                    writer = Writer(out, settings)
                writer.add(doc_id.as_py(), encode(text.as_py()) + end)
        if writer is None:
            return
        writer.close()
        out.close()
        yield pa.RecordBatch.from_pydict({
            "file_no": pa.array([number], pa.int32()), "path": [f"{folder}/{name}"],
            "documents": [writer.documents], "tokens": [writer.tokens],
        })

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("within"))
        .repartitionByRange("doc_id", "within")
        .sortWithinPartitions("doc_id", "within", "text")
        .select("doc_id", "text")
    )
    return stored(
        ordered.mapInArrow(run, "file_no int, path string, documents long, tokens long"),
        "token-files",
    )


def read_files(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the listed files.

    start counts the ids of all documents before, over all files.
    """
    number = files.count()
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file here, not per document.
    placed = files.select("file_no", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for path, base in zip(batch.column("path"), batch.column("base")):
                store, inside = opened(path.as_py())
                start, rows, held = base.as_py(), [], 0
                with store.open_input_file(inside) as source:
                    for doc_id, ids in Reader(source).documents():
                        rows.append((doc_id, start, len(ids) // 4, ids))
                        start += len(ids) // 4
                        held += len(ids)
                        if held > 1 << 23:
                            yield as_batch(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield as_batch(rows, schema)

    return placed.repartitionByRange(max(1, number), "file_no").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary"
    )


def round_trip(docs: DataFrame, settings: Settings = Settings(), vocabulary: str | None = None) -> DataFrame:
    """Write all documents and read every file back: ``(doc_id, start, n_tokens, ids)``.

    A NULL or empty text is its end id alone; repeated rows are written as often.
    """
    folder = fresh_dir(docs.sparkSession, "tokens")
    return read_files(write_files(docs, folder, settings, vocabulary))
