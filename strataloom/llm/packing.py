"""Packing by the sum-of-squares rule: token sequences of one size, little padding.

Each document goes to full windows first; what is left of it is placed online into the
fill level where the sum of squared counts of partly filled windows grows least.  A level
array holds the open windows by how full they are.  At the end of a partition, or when
very many windows are open, the open ones are poured into each other: pieces are cut and
moved from the emptiest into the fullest, so at most one window of a partition is padded.

Every partition packs its own documents, with windows numbered below the partition's
number; a task that runs again gives the same sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch
from .tokens import encoder

ID_BYTES = 4
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)
COLUMNS = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
BATCH_BYTES = 1 << 23


@dataclass(frozen=True)
class Settings:
    """``open``: windows a partition may hold open before they are poured together."""

    size: int = 1024
    end_id: int = 0
    open: int = 4096


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: at * ID_BYTES], self.doc_tokens)
        tail = Piece(self.doc_id, self.start + at, self.ids[at * ID_BYTES :], self.doc_tokens)
        return head, tail


@dataclass
class Window:
    number: int
    fill: int = 0
    pieces: list[Piece] = field(default_factory=list)

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece)


class Packer:
    def __init__(self, settings: Settings = Settings(), first: int = 0) -> None:
        self.settings, self.next = settings, first
        self.levels: list[list[Window]] = [[] for _ in range(settings.size)]
        self.counts = np.zeros(settings.size, dtype=np.int64)

    def fresh(self) -> Window:
        window = Window(self.next)
        self.next += 1
        return window

    def level_for(self, n: int) -> int:
        """The fill level to put ``n`` ids on; 0 opens a window.  Ties: the fullest."""
        counts, size = self.counts, self.settings.size
        here = counts[: size - n]
        rise = 2 * counts[n:] + 2 - 2 * here
        rise[0] = 2 * counts[n] + 1
        usable = here > 0
        usable[0] = True
        rise = np.where(usable, rise, np.iinfo(np.int64).max)
        best = len(rise) - 1 - int(np.argmin(rise[::-1]))
        exact = size - n
        if counts[exact] and 1 - 2 * counts[exact] <= rise[best]:
            return exact
        return best

    def place(self, piece: Piece) -> Iterator[Window]:
        """Put one document; yields the windows that became full."""
        size = self.settings.size
        while len(piece) >= size:
            head, piece = piece.cut(size)
            window = self.fresh()
            window.add(head)
            yield window
        if not len(piece):
            return
        level = self.level_for(len(piece))
        if level:
            window = self.levels[level].pop()
            self.counts[level] -= 1
        else:
            window = self.fresh()
        window.add(piece)
        if window.fill == size:
            yield window
            return
        self.levels[window.fill].append(window)
        self.counts[window.fill] += 1
        if self.counts.sum() > self.settings.open:
            yield from self.pour(last=False)

    def pour(self, last: bool = True) -> Iterator[Window]:
        """Fill the open windows from each other; the one left is kept unless ``last``."""
        size = self.settings.size
        left = [w for level in reversed(self.levels) for w in level]
        self.levels = [[] for _ in range(size)]
        self.counts[:] = 0
        i, j = 0, len(left) - 1
        while i < j:
            target, donor = left[i], left[j]
            piece = donor.pieces.pop()
            donor.fill -= len(piece)
            gap = size - target.fill
            if len(piece) > gap:
                head, piece = piece.cut(len(piece) - gap)
                donor.add(head)
            target.add(piece)
            if target.fill == size:
                yield target
                i += 1
            if not donor.fill:
                j -= 1
        if i == j and left[i].fill:
            if last:
                yield left[i]
            else:
                self.levels[left[i].fill].append(left[i])
                self.counts[left[i].fill] += 1


def batches_of(windows: Iterator[Window]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        (c, pa.binary() if c == "ids" else pa.int64()) for c in COLUMNS
    ])
    rows: list[tuple] = []
    held = 0
    for window in windows:
        at = 0
        for p in window.pieces:
            rows.append((p.doc_id, p.start, len(p), p.ids, p.doc_tokens, window.number, at))
            at += len(p)
            held += len(p.ids)
        if held > BATCH_BYTES:
            yield as_batch(rows, schema)
            rows, held = [], 0
    if rows:
        yield as_batch(rows, schema)


def pack(docs: DataFrame, settings: Settings = Settings(), vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents with their token ids, see ``SCHEMA``.

    A NULL or empty text is its end id alone.  A NULL doc_id is packed like any other;
    repeated rows are packed as often.  An empty table gives no piece.
    """
    end = np.array([settings.end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        packer = Packer(settings, TaskContext.get().partitionId() << 36)

        def windows() -> Iterator[Window]:
            for batch in batches:
                for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                    ids = encode(text.as_py()) + end
                    yield from packer.place(Piece(doc_id.as_py(), 0, ids, len(ids) // ID_BYTES))
            yield from packer.pour()

        yield from batches_of(windows())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def pieces(packed: DataFrame) -> DataFrame:
    """The digest of ``pack``: ids replaced by their crc32."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )
