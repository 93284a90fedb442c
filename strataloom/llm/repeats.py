"""Substring dedup by level-wise doubling: repeated passages leave all but one document.

Windows of words are compared level by level.  Only windows repeated at one length are
extended to twice that length (the last step overlaps, so that it ends at the length
asked for), so each level asks about far fewer windows than the one before.  The first
level need not ask about every window either: of the short windows inside a full one,
the one with the least hash stands for it.  Both copies of a full window choose the same
short one, so nothing is missed.

A level is one shuffle of packed arrays.  A task sends every hash once per chunk of
documents, with the smallest doc_id that has it; what the chunk itself decides is not
asked.  A window that a third of all documents hold is thus one entry per chunk.  Full
windows are compared by 128 bits of their text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batch, stored

KEY = ["doc_id", "tag"]
SPOTS = "doc_id long, tag long, spots binary"
NAMED = f"{SPOTS}, names binary"
CHUNK = 8 << 20


@dataclass(frozen=True)
class Settings:
    """``length``: words of a window; ``bucket``: bytes of text per bucket of hashes."""

    length: int = 13
    bucket: int = 16 << 20

    @property
    def half(self) -> int:
        return -(-self.length // 2)


class Words:
    """The words of a text, joined by one space, and where each begins and ends."""

    def __init__(self, text: bytes | None) -> None:
        self.parts = (text or b"").split()
        self.joined = b" ".join(self.parts)
        sizes = np.fromiter(map(len, self.parts), np.int64, len(self.parts))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes

    def __len__(self) -> int:
        return len(self.parts)

    def spans(self, length: int, at: np.ndarray | None = None) -> Iterator[bytes]:
        """The windows of ``length`` words, all or those that start at ``at``."""
        last = len(self) - length + 1
        if at is None:
            starts, ends = self.starts[: max(last, 0)], self.ends[length - 1 :]
        else:
            starts, ends = self.starts[at], self.ends[at + length - 1]
        joined = self.joined
        return (joined[s:e] for s, e in zip(starts.tolist(), ends.tolist()))


def least_halves(words: Words, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Per full window of a text the start of the half window that stands for it, and
    the hashes of all half windows."""
    full, half = settings.length, settings.half
    if len(words) < full:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = len(words) - half + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words.spans(half)), np.uint64, n)
    inside = np.lib.stride_tricks.sliding_window_view(hashes, full - half + 1)
    return inside.argmin(axis=1) + np.arange(len(inside)), hashes


def extendable(words: Words, repeated: np.ndarray, settings: Settings) -> np.ndarray:
    """Starts of the full windows whose half window is repeated."""
    return np.flatnonzero(np.isin(least_halves(words, settings)[0], repeated))


def rows_in(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time, so that one text is held and not all."""
    names = batch.schema.names
    for values in zip(*batch.columns):
        yield {n: v.as_py() for n, v in zip(names, values)}


# -- packed arrays -------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal rows of ``keys`` (sorted, 2-d) begins."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return np.flatnonzero(new)


def _least_first(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by key, and per entry in it the smallest and largest document of its key."""
    order = np.lexsort((docs, *keys.T[::-1]))
    starts = _runs(keys[order])
    sizes = np.diff(np.append(starts, len(keys)))
    sorted_docs = docs[order]
    return order, np.repeat(sorted_docs[starts], sizes), np.repeat(sorted_docs[starts + sizes - 1], sizes)


def _judged(docs: np.ndarray, least: np.ndarray, most: np.ndarray, later: bool) -> np.ndarray:
    """Which entries are wanted: those after the first document, or all of a repeated key."""
    return docs > least if later else most > least


def asked(
    docs: DataFrame, windows: Callable, columns: list[str], buckets: int, wide: bool, later: bool
) -> DataFrame:
    """What each task knows and asks: packed entries by bucket of their hash.

    ``windows(row)`` gives the starts and the hashes (as rows of two numbers, the
    second used if ``wide``) of one document.  Without ``wide`` 32 bits are sent besides
    the bucket, enough to choose candidates.
    """
    schema = pa.schema([
        ("bucket", pa.int32()), ("known", pa.bool_()), ("keys", pa.binary()), ("which", pa.binary()),
        ("spots", pa.binary()), ("ids", pa.binary()), ("tags", pa.binary()),
    ])

    def rows(bucket: np.ndarray, known: bool, keys, doc, spot, ids, tags) -> Iterator[tuple]:
        order = np.lexsort((spot, doc, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for part in np.split(order, cuts[1:]) if len(order) else []:
            own, which = np.unique(doc[part], return_inverse=True)
            yield (
                int(bucket[part[0]]), known, b"" if known else keys[part].tobytes(),
                packed(np.diff(which, prepend=0).astype("<u4")), packed(spot[part].astype("<u4")),
                packed(np.diff(ids[own], prepend=0)), tags[own].tobytes(),
            )

    def flush(found: dict) -> Iterator[pa.RecordBatch]:
        held = [(*key, *found[key]) for key in sorted(found)]
        ids = np.array([x[0] for x in held], np.int64)
        tags = np.array([x[1] for x in held], np.int64)
        doc = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
        spot = np.concatenate([x[2] for x in held]).astype(np.int64)
        keys = np.concatenate([x[3] for x in held])
        order, least, most = _least_first(keys, ids[doc])
        keys, doc, spot = keys[order], doc[order], spot[order]
        mine = _judged(ids[doc], least, most, later)
        ask = ids[doc] == least
        bucket = ((keys[:, 0] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        sent = keys if wide else (keys[:, :1] & np.uint64(0xFFFFFFFF)).astype("<u4")
        out = list(rows(bucket[ask], False, sent[ask], doc[ask], spot[ask], ids, tags))
        out += rows(doc[mine] % buckets, True, sent[mine], doc[mine], spot[mine], ids, tags)
        for at in range(0, len(out), 64):
            yield as_batch(out[at : at + 64], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            for row in rows_in(batch):
                key = row["doc_id"], row["tag"]
                if key in held:
                    continue
                spots, keys = windows(row)
                if len(spots):
                    held[key] = spots, keys
                    size += 32 * len(spots)
                if size > CHUNK:
                    yield from flush(held)
                    held, size = {}, 0
        if held:
            yield from flush(held)

    return docs.select(*columns).mapInArrow(
        run, "bucket int, known boolean, keys binary, which binary, spots binary, ids binary, tags binary"
    )


def answered(asks: DataFrame, wide: bool, later: bool) -> DataFrame:
    """Per document and bucket the starts of the wanted windows, see ``SPOTS``."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("spots", pa.binary())])

    def judge(table: pa.Table) -> pa.Table:
        keys, docs, tags, spots, known = [], [], [], [], []
        for row in table.to_pylist():
            own = np.cumsum(unpacked(row["ids"], np.int64))
            which = np.cumsum(unpacked(row["which"], "<u4").astype(np.uint32), dtype=np.uint32)
            docs.append(own[which])
            tags.append(np.frombuffer(row["tags"], np.int64)[which])
            spots.append(unpacked(row["spots"], "<u4"))
            width = 2 if wide else 1
            got = np.frombuffer(row["keys"], np.uint64 if wide else "<u4").reshape(-1, width)
            known.append(np.full(len(which), row["known"]))
            keys.append(np.zeros((len(which), width), got.dtype) if row["known"] else got)
        keys, docs, tags, spots, known = map(np.concatenate, (keys, docs, tags, spots, known))
        open_ = np.flatnonzero(~known)
        order, least, most = _least_first(keys[open_], docs[open_])
        wanted = open_[order[_judged(docs[open_][order], least, most, later)]]
        wanted = np.concatenate([wanted, np.flatnonzero(known)])
        wanted = wanted[np.lexsort((spots[wanted], tags[wanted], docs[wanted]))]
        pair = np.stack([docs[wanted], tags[wanted]], axis=1)
        starts = _runs(pair)
        lists = [x.astype("<u4").tobytes() for x in np.split(spots[wanted], starts[1:])] if len(wanted) else []
        return pa.Table.from_arrays(
            [pa.array(pair[starts, 0], pa.int64()), pa.array(pair[starts, 1], pa.int64()), pa.array(lists, pa.binary())],
            schema=schema,
        )

    return asks.groupBy("bucket").applyInArrow(judge, SPOTS)


def gathered(spots: DataFrame) -> DataFrame:
    """One row per text: the lists of its buckets, as long as the text at most."""
    return spots.groupBy(*KEY).agg(F.collect_list("spots").alias("lists"))


def together(lists: list[bytes]) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(lists), "<u4")).astype(np.int64)


# -- levels --------------------------------------------------------------------


def named_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, copy_of, text``: rows with a doc_id; equal texts share copy_of."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"),
        F.md5(text).alias("copy_of"), text.alias("text"),
    )


def squeezed(rows: DataFrame) -> DataFrame:
    """The texts as zstandard frames, a third of the bytes to shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts = pa.array([squeeze(t.as_py()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], texts], ["doc_id", "tag", "text"])

    return rows.select(*KEY, "text").mapInArrow(run, "doc_id long, tag long, text binary")


def released(text: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(text)


def bucket_count(rows: DataFrame, settings: Settings) -> int:
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(64, -(-size // settings.bucket))


def first_holders(rows: DataFrame) -> DataFrame:
    """``text_of, first_id, tag``: each different text with its smallest doc_id."""
    return stored(
        rows.groupBy(F.col("copy_of").alias("text_of")).agg(
            F.min("doc_id").alias("first_id"), F.first("tag").alias("tag")
        ),
        "first-holders",
    )


def candidates(rows: DataFrame, firsts: DataFrame, settings: Settings, buckets: int) -> DataFrame:
    """``doc_id, tag, text, lists``: different texts with half windows that other texts
    hold too, and where these start; equal texts are one, of the smallest doc_id."""

    def halves(row: dict) -> tuple[np.ndarray, np.ndarray]:
        stands, hashes = least_halves(Words(row["text"]), settings)
        spots = np.unique(stands)
        return spots, hashes[spots].reshape(-1, 1)

    # A full window needs at least 2 * length - 1 bytes.
    long = rows.where(F.octet_length("text") >= 2 * settings.length - 1)
    texts = long.select(F.col("tag").alias("doc_id"), F.lit(0).cast("long").alias("tag"), "text")
    asks = asked(texts, halves, [*KEY, "text"], buckets, wide=False, later=False)
    found = gathered(answered(asks, wide=False, later=False)).select(F.col("doc_id").alias("tag"), "lists")
    found = found.join(firsts.select(F.col("first_id").alias("doc_id"), "tag"), "tag")
    return stored(squeezed(long).dropDuplicates(KEY).join(found, KEY), "repeat-candidates")


def full_windows(row: dict, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 128-bit names of the full windows that may be repeated."""
    words = Words(released(row["text"]))
    at = extendable(words, together(row["lists"]), settings)
    names = b"".join(map(xxhash.xxh3_128_digest, words.spans(settings.length, at)))
    return at, np.frombuffer(names, np.uint64).reshape(-1, 2)


def removed_windows(found: DataFrame, settings: Settings, buckets: int) -> DataFrame:
    """``SPOTS`` of windows whose words also start in a document with a smaller doc_id."""
    asks = asked(
        found, lambda row: full_windows(row, settings), [*KEY, "text", "lists"], buckets, wide=True, later=True
    )
    return answered(asks, wide=True, later=True)


def covered(spots: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``length`` that starts at ``spots``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, spots, 1)
    np.add.at(steps, spots + length, -1)
    return np.cumsum(steps[:-1]) > 0


def kept_text(words: Words, gone: np.ndarray) -> bytes:
    return b" ".join([w for w, out in zip(words.parts, gone.tolist()) if not out])


def whole(text: bytes) -> tuple[int, str]:
    """Number of words, and the digest of all of them."""
    parts = text.split()
    return len(parts), sha256(b" ".join(parts)).hexdigest()


def without_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and ``kept`` per row of ``docs``.

    Words are runs of bytes other than ASCII white space, unchanged.  A word goes if a
    window of ``length`` consecutive words of its text covers it whose words also start
    in a document with a smaller doc_id.  ``kept`` is what is left, joined by one space;
    NULL where nothing was removed.  A NULL or empty text has no word.  A row without
    doc_id keeps all and takes nothing from others.  Rows that share a doc_id take
    nothing from each other; each is judged by its own text.  Other columns are left out.
    """
    rows = named_rows(docs)
    known = rows.where("doc_id IS NOT NULL")
    buckets = bucket_count(known, settings)
    firsts = first_holders(known)
    found = candidates(known, firsts, settings, buckets)
    gone = gathered(removed_windows(found, settings, buckets))
    length = settings.length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_in(batch):
                words = Words(released(row["text"]))
                mask = covered(together(row["lists"]), length, len(words))
                kept = kept_text(words, mask)
                out.append((row["doc_id"], row["tag"], int(mask.sum()), sha256(kept).hexdigest(), kept.decode()))
                if len(out) >= 500:
                    yield as_batch(out, cut_schema)
                    out = []
            if out:
                yield as_batch(out, cut_schema)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [whole(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([n for n, _ in found], pa.int64()), pa.array([d for _, d in found], pa.string())],
                ["doc_id", "tag", "copy_of", "n_words", "whole"],
            )

    cut_schema = pa.schema([
        ("doc_id", pa.int64()), ("tag", pa.int64()), ("out", pa.int64()), ("digest", pa.string()), ("kept", pa.string()),
    ])
    parted = found.drop("lists").join(gone, KEY).mapInArrow(
        cut, "doc_id long, tag long, out long, digest string, kept string"
    )
    all_rows = rows.select(*KEY, "copy_of", "text").mapInArrow(
        plain, "doc_id long, tag long, copy_of string, n_words long, whole string"
    )
    firsts = firsts.drop("tag")
    judged = all_rows.join(firsts, F.col("copy_of") == F.col("text_of"), "left").join(parted, KEY, "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= length)
    nothing = F.lit(sha256(b"").hexdigest())
    return judged.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("out", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, nothing).otherwise(F.coalesce("digest", "whole")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def longest_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, tag, words``: the greatest length, ``length`` doubled again and again, of
    a passage that another document holds too.

    Goes on until no window survives.  From a full window on a window is named by the
    names of its halves, so no text is read again.  Of equal texts the smallest doc_id
    stands for all; texts without a repeated window are left out.
    """
    known = named_rows(docs).where("doc_id IS NOT NULL")
    buckets = bucket_count(known, settings)
    found = candidates(known, first_holders(known), settings, buckets)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_in(batch):
                at, names = full_windows(row, settings)
                out.append((row["doc_id"], row["tag"], at.astype("<u4").tobytes(), names.tobytes()))
            if out:
                yield as_batch(out, pa.schema([
                    ("doc_id", pa.int64()), ("tag", pa.int64()), ("spots", pa.binary()), ("names", pa.binary())]))

    length, lengths = settings.length, []
    level = stored(found.mapInArrow(name, NAMED), "repeat-level")
    while True:
        asks = asked(level, _own_windows, [*KEY, "spots", "names"], buckets, wide=True, later=False)
        alive = gathered(answered(asks, wide=True, later=False))
        joined = level.join(alive, KEY)
        lengths.append(joined.select(*KEY, F.lit(length).alias("words")))
        level = stored(joined.mapInArrow(_doubled(length), NAMED), "repeat-level")
        if not level.where(F.octet_length("spots") > 0).take(1):
            break
        length *= 2
    every = lengths[0]
    for more in lengths[1:]:
        every = every.unionAll(more)
    return every.groupBy(*KEY).agg(F.max("words").alias("words"))


def _own_windows(row: dict) -> tuple[np.ndarray, np.ndarray]:
    spots = np.frombuffer(row["spots"], "<u4").astype(np.int64)
    return spots, np.frombuffer(row["names"], np.uint64).reshape(-1, 2)


def _doubled(length: int) -> Callable:
    """Pairs of repeated windows that follow each other, as one of twice the length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_in(batch):
                spots, names = _own_windows(row)
                own = np.isin(spots, together(row["lists"]))
                name_at = dict(zip(spots[own].tolist(), (n.tobytes() for n in names[own])))
                pairs = [(p, name_at[p] + name_at[p + length]) for p in sorted(name_at) if p + length in name_at]
                at = np.array([p for p, _ in pairs], "<u4")
                out.append((row["doc_id"], row["tag"], at.tobytes(), b"".join(xxhash.xxh3_128_digest(n) for _, n in pairs)))
            if out:
                yield as_batch(out, pa.schema([
                    ("doc_id", pa.int64()), ("tag", pa.int64()), ("spots", pa.binary()), ("names", pa.binary())]))

    return run


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM d),
g AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS g FROM s),
m AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM g JOIN m USING (g) WHERE least < doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
k AS (SELECT doc_id, len(w) AS n, CASE WHEN gone IS NULL THEN w
    ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""
