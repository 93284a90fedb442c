"""Cross-tokenizer alignment by merge-path partitioning.

Two vocabularies cut the same bytes into tokens A and B.  Where a token of either ends at
the same byte, a group ends; all A and B tokens of a group are linked.  The groups come
from merging the two lists of token ends.  A diagonal of the merge grid fixes how many
ends lie before it, and a binary search along it finds how many of them are A's.  Evenly
spaced diagonals cut the merge into pieces of equal work, whatever the sizes of documents
and groups; each piece finds the common ends of its own two ranges, and a pair of equal
ends that falls on a border is found when the pieces are stitched together.

How many documents link a pair of ids is counted over the corpus.  Each chunk of documents
names its different pairs once, with the number of its documents; sums and the largest
sum per A id are joined back to the chunks.  Documents themselves wait in a table, with
their pairs as positions in the list of their chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch, stored
from .repeats import packed, unpacked
from .tokens import BYTES, VOCABULARY, Encoder, vocabulary_path

PIECES = "piece_bpe_32k.model"
UNDERLINE = "▁"
SLICE = 1 << 20
DOC = 40


@dataclass(frozen=True)
class Settings:
    """``work``: token ends per piece of a merge; ``chunk``: characters of texts that share
    one list of pairs; ``wide``: links above which a group's repeated ids are counted first.
    ``left`` and ``right`` are paths of the vocabularies, None for the public ones."""

    work: int = 1 << 16
    chunk: int = 16 << 20
    wide: int = 1 << 14
    left: str | None = None
    right: str | None = None


class ByteLevel:
    """Tokens of a byte-level vocabulary, of a text after one space."""

    def __init__(self, path: str | None) -> None:
        self.encoder = Encoder(path or vocabulary_path(VOCABULARY))
        byte_of = {c: b for b, c in enumerate(BYTES)}
        entries = self.encoder.tokenizer.get_vocab()
        self.bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.encoder.encode(" " + t), "<u4").astype(np.int64) for t in texts]


class Pieces:
    """Tokens of a sentencepiece vocabulary, which puts a space before the text itself."""

    def __init__(self, path: str | None) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path or vocabulary_path(PIECES))
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(UNDERLINE, " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@cache
def vocabularies(left: str | None, right: str | None) -> tuple[ByteLevel, Pieces]:
    """Loaded once in a worker process, for all its tasks."""
    return ByteLevel(left), Pieces(right)


# -- merge path ----------------------------------------------------------------


def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the first ``at`` merged ends are A's; at equal ends A's comes first."""
    lo, hi = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        before = np.zeros(len(at), bool)
        before[open_] = a[mid[open_]] <= b[at[open_] - 1 - mid[open_]]
        lo, hi = np.where(open_ & before, mid + 1, lo), np.where(open_ & ~before, mid, hi)
    return lo


def piece_overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ends that both ranges of a piece hold."""
    at = np.searchsorted(b, a)
    both = np.flatnonzero(at < len(b))
    both = both[b[at[both]] == a[both]]
    return both, at[both]


def common_ends(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and in ``b`` of all ends they share, ascending."""
    at = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    cut_a = diagonals(a, b, at)
    cut_b = at - cut_a
    found = []
    for i, to_i, j, to_j in zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:]):
        in_a, in_b = piece_overlaps(a[i:to_i], b[j:to_j])
        found.append((in_a + i, in_b + j))
        # An end of A that closes this piece, and its equal that opens the next.
        if to_i > i and to_j < len(b) and a[to_i - 1] == b[to_j]:
            found.append((np.array([to_i - 1]), np.array([to_j])))
    return tuple(np.concatenate(side) for side in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


# -- documents -------------------------------------------------------------------


def linked_pairs(a, b, size_a, size_b, doc, right: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Different (document, pair) of all groups and how often each is linked.

    ``a`` and ``b`` are the ids, ``size_a`` and ``size_b`` the tokens per group, ``doc`` its
    document.  A pair is ``a * right + b``, the document stands above its ``DOC`` bits.
    """
    start_b = np.cumsum(size_b) - size_b
    many = size_a * size_b > wide
    group = np.repeat(np.arange(len(doc)), size_a)
    some = np.flatnonzero(~many[group])
    times = size_b[group[some]]
    turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    of = np.repeat(some, times)
    pair = a[of] * right + b[start_b[group[of]] + turn]
    keys, counts = np.unique((doc[group[of]] << DOC) | pair, return_counts=True)
    if not many.any():
        return keys, counts
    start_a = np.cumsum(size_a) - size_a
    all_keys, all_counts = [keys], [counts]
    for g in np.flatnonzero(many):
        ua, ca = np.unique(a[start_a[g] : start_a[g] + size_a[g]], return_counts=True)
        ub, cb = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
        all_keys.append(((doc[g] << DOC) | (ua[:, None] * right + ub)).ravel())
        all_counts.append(np.outer(ca, cb).ravel())
    keys, inverse = np.unique(np.concatenate(all_keys), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, inverse, np.concatenate(all_counts))
    return keys, counts


@dataclass
class Aligned:
    """One document: its counts, the digest of its groups, its pairs and their links."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    digest: str = ""
    groups: str | None = ""
    pairs: np.ndarray | None = None
    times: np.ndarray | None = None


@cache
def written(left: int, right: int) -> list[str]:
    """Ids of both vocabularies as text with what follows them: A's before a comma or the
    bar, then B's before a comma or the end of the group."""
    return [f"{i}{c}" for n, ends in ((left, ",|"), (right, ",;")) for i in range(n) for c in ends]


def group_codes(a, b, size_a, size_b, left: int) -> np.ndarray:
    """Positions in ``written`` of all tokens, group by group, A's first."""
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    codes = np.empty(len(a) + len(b), np.int64)
    last = np.zeros(len(a), np.int64)
    last[end_a - 1] = 1
    codes[np.arange(len(a)) + np.repeat(end_b - size_b, size_a)] = 2 * a + last
    last = np.zeros(len(b), np.int64)
    last[end_b - 1] = 1
    codes[np.arange(len(b)) + np.repeat(end_a, size_b)] = 2 * (left + b) + last
    return codes


def align(texts: list[str | None], settings: Settings = Settings(), with_groups: bool = True) -> list[Aligned]:
    """The alignment of each text; all are merged as one list of ends."""
    left, right = vocabularies(settings.left, settings.right)
    out = [Aligned() for _ in texts]
    some = [i for i, t in enumerate(texts) if t]
    ids_a, ids_b = (v.encode([texts[i] for i in some]) for v in (left, right))
    size_a, size_b = (np.array([len(x) for x in v.bytes], np.int64) for v in (left, right))
    held, ends_a, ends_b, base = [], [], [], 0
    for i, a, b in zip(some, ids_a, ids_b):
        whole = b" " + texts[i].encode("utf-8", "replace")
        if b"".join([left.bytes[x] for x in a.tolist()]) != whole or b"".join([right.bytes[x] for x in b.tolist()]) != whole:
            continue
        held.append((i, a, b))
        ends_a.append(np.cumsum(size_a[a]) + base)
        ends_b.append(np.cumsum(size_b[b]) + base)
        base += len(whole)
    if not held:
        return out
    cut_a, cut_b = common_ends(np.concatenate(ends_a), np.concatenate(ends_b), settings.work)
    first_a = np.cumsum([0] + [len(a) for _, a, _ in held])
    first_b = np.cumsum([0] + [len(b) for _, _, b in held])
    doc = np.searchsorted(first_a, cut_a, side="right") - 1
    sizes_a, sizes_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    all_a, all_b = np.concatenate([a for _, a, _ in held]), np.concatenate([b for _, _, b in held])
    keys, times = linked_pairs(all_a, all_b, sizes_a, sizes_b, doc, len(right.bytes), settings.wide)
    codes = group_codes(all_a, all_b, sizes_a, sizes_b, len(left.bytes))
    spell = written(len(left.bytes), len(right.bytes)).__getitem__
    links = np.zeros(len(held), np.int64)
    np.add.at(links, doc, sizes_a * sizes_b)
    groups = np.searchsorted(doc, np.arange(len(held) + 1))
    bounds = np.searchsorted(keys, np.arange(len(held) + 1) << DOC)
    for k, (i, a, b) in enumerate(held):
        at = first_a[k] + first_b[k]
        text = "".join(map(spell, codes[at : at + len(a) + len(b)].tolist()))[:-1]
        mine = slice(bounds[k], bounds[k + 1])
        out[i] = Aligned(
            len(a), len(b), int(groups[k + 1] - groups[k]), int(links[k]),
            sha256(text.encode()).hexdigest(), text if with_groups else None,
            keys[mine] & ((1 << DOC) - 1), times[mine],
        )
    return out


# -- corpus -------------------------------------------------------------------------


ROW = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "groups string, which binary, times binary, pairs binary, docs binary"
)


def aligned_rows(docs: DataFrame, settings: Settings, with_groups: bool) -> DataFrame:
    """One row per document and one per chunk, the latter with ``pairs`` and ``docs``."""
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.binary()] * 4
    schema = pa.schema(list(zip([c.split()[0] for c in ROW.split(", ")], kinds)))

    def rows(chunk: int, held: list[tuple[int | None, Aligned]]) -> Iterator[tuple]:
        linked = [x.pairs for _, x in held if x.pairs is not None]
        pairs, which, docs = np.unique(
            np.concatenate([*linked, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True
        )
        at = 0
        for doc_id, x in held:
            n = 0 if x.pairs is None else len(x.pairs)
            own, at = which[at : at + n], at + n
            times = np.zeros(0) if x.times is None else x.times
            yield (
                chunk, doc_id, x.n_a, x.n_b, x.n_groups, x.n_links, x.digest, x.groups if with_groups else None, packed(np.diff(own, prepend=0).astype("<u4")),
                packed(times.astype("<u8")), None, None,
            )
        yield (chunk, *[None] * 9, packed(np.diff(pairs, prepend=0).astype("<u8")), packed(docs.astype("<u8")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, size, held = TaskContext.get().partitionId(), 0, 0, []
        ids, texts, waiting = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            out = []
            for row in rows(part << 32 | chunk, held):
                out.append(row)
                if len(out) >= 500:
                    yield as_batch(out, schema)
                    out = []
            if out:
                yield as_batch(out, schema)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids.append(doc_id.as_py())
                texts.append(text.as_py())
                waiting += len(texts[-1] or "") + 64
                if waiting >= SLICE:
                    held += zip(ids, align(texts, settings, with_groups))
                    size, ids, texts, waiting = size + waiting, [], [], 0
                if size >= settings.chunk:
                    yield from flush()
                    chunk, size, held = chunk + 1, 0, []
        held += zip(ids, align(texts, settings, with_groups))
        if held:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROW)


def pair_counts(table: DataFrame, right: int) -> DataFrame:
    """``chunk, place, a, b, docs``: every different pair of every chunk."""
    schema = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, docs in zip(*batch.columns):
                pairs = np.cumsum(unpacked(pairs.as_py(), "<u8"), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(pairs), chunk.as_py())), pa.array(np.arange(len(pairs), dtype=np.int32)),
                    pa.array((pairs // right).astype(np.int32)), pa.array((pairs % right).astype(np.int32)),
                    pa.array(unpacked(docs.as_py(), "<u8").astype(np.int64)),
                ], schema=schema)

    return table.where("pairs IS NOT NULL").select("chunk", "pairs", "docs").mapInArrow(
        run, "chunk long, place int, a int, b int, docs long"
    )


def corpus_pairs(counts: DataFrame) -> DataFrame:
    """``a, b, n, best``: documents that link a pair; ``best`` if no other b has more with a."""
    totals = counts.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    top = totals.groupBy(F.col("a").alias("of")).agg(F.max("n").alias("most"))
    return totals.join(top, F.col("a") == F.col("of")).select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


DIGEST = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, groups string"
)


def alignments(docs: DataFrame, settings: Settings = Settings(), with_groups: bool = True) -> DataFrame:
    """The alignment of every document, see ``DIGEST``; ``groups`` is NULL without ``with_groups``.

    A group is written as its A ids, ``|`` and its B ids; groups are separated by ``;``.
    ``n_best`` counts links whose pair no other B id has more documents with the same A id
    than, ``count_sum`` adds the documents of every link's pair.  A NULL or empty text has
    no tokens, nor has one that a vocabulary does not give back byte by byte: counts are
    zero and the digest is empty.  Every row is a document: repeated rows come back and are
    counted as often, and so are rows without doc_id.  Other columns are left out.
    """
    table = stored(aligned_rows(docs, settings, with_groups), "alignments")
    right = len(vocabularies(settings.left, settings.right)[1].bytes)
    counts = pair_counts(table, right)
    known = stored(corpus_pairs(counts), "corpus-pairs")
    replies = counts.join(known, ["a", "b"]).select("chunk", "place", "n", "best")
    schema = pa.schema([
        (c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DIGEST.split(", ")
    ])

    def finish(own: pa.Table, got: pa.Table) -> pa.Table:
        places = got.column("place").to_numpy()
        n, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        n[places] = got.column("n").to_numpy()
        best[places] = got.column("best").to_numpy(zero_copy_only=False)
        bests, sums = [], []
        for which, times in zip(own.column("which"), own.column("times")):
            which = np.cumsum(unpacked(which.as_py(), "<u4"), dtype=np.int64)
            times = unpacked(times.as_py(), "<u8").astype(np.int64)
            bests.append(int(times @ best[which]))
            sums.append(int(times @ n[which]))
        return pa.Table.from_arrays([
            own.column("doc_id"), *(own.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")),
            pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), own.column("groups_sha256"), own.column("groups"),
        ], schema=schema)

    texts = table.where("pairs IS NULL").drop("pairs", "docs")
    return texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(finish, DIGEST)
