import io
import random
import zlib

import numpy as np
import pytest
import xxhash
from helpers import clashing, corpus, frame
from pyspark.sql import functions as F

from strataloom.llm import packing, tokens, tokenstore
from strataloom.session import fresh_dir


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder()


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_cached_pieces_equal_the_tokenizer(encoder):
    rng = random.Random(1)
    every = "".join(map(chr, range(0x250)))
    texts = [r[1] for r in corpus(80)] + [every, "a<|endoftext|>b", "it's  we'll\n\n x \t\n", "日本 語 ab", "\ud800"[:0]]
    texts += ["".join(rng.choices(every + "     \n\n'stx", k=60)) for _ in range(1500)]
    texts += [f"a{chr(c)}b {chr(c)} c{chr(c)}{chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for t in texts:
        assert ids_of(encoder.encode(t)) == plain(encoder, t), repr(t)


def test_slices_and_full_cache(encoder, monkeypatch):
    text = "  ".join(f"word{i} it's,\n  {i}" for i in range(300)) + "x" * 200
    want = plain(encoder, text)
    for limit in (1 << 17, 3):
        monkeypatch.setattr(tokens, "SLICE", 37)
        monkeypatch.setattr(tokens, "CACHED", limit)
        encoder.known.clear()
        assert ids_of(encoder.encode(text)) == want


def check_pieces(rows, ids_by_doc, size=1024):
    """Every id in exactly one piece, sequences gapless; returns the padded ids."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for d, want in ids_by_doc.items():
        at = 0
        for r in sorted(docs[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want))
            assert ids_of(r.ids) == want[at : at + r.length]
            at += r.length
        assert at == len(want)
    padded = 0
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
        padded += size - at
    return padded


def test_pack(spark, encoder):
    rows = [r for r in corpus() if r[0] is not None][:-2]
    df = clashing(frame(spark, rows)).repartition(3)
    out = packing.pack(df).collect()
    padded = check_pieces(out, {r[0]: plain(encoder, r[1]) + [0] for r in rows})
    assert padded < 3 * 1024


def test_pack_odd_rows(spark):
    rows = [r for r in corpus(10)]
    out = packing.pieces(packing.pack(frame(spark, rows))).collect()
    assert sum(r.start == 0 for r in out) == len(rows)
    one = next(r for r in out if r.doc_id == 12)  # NULL text
    assert (one.length, one.doc_tokens, one.ids_crc32) == (1, 1, zlib.crc32(b"\0\0\0\0"))
    assert packing.pack(frame(spark, [])).count() == 0


def test_sum_of_squares_rule():
    """Each choice has the least sum of squares of all possible ones."""
    rng = random.Random(5)
    packer = packing.Packer(packing.Settings(size=32))

    def squares(counts):
        return int((counts[1:] ** 2).sum())

    for _ in range(400):
        n = rng.randint(1, 31)
        options = []
        for h in range(0, 32 - n + 1):
            if h and not packer.counts[h]:
                continue
            after = packer.counts.copy()
            after[h] -= 1 if h else 0
            if h + n < 32:
                after[h + n] += 1
            options.append(squares(after))
        list(packer.place(packing.Piece(1, 0, bytes(4 * n), n)))
        assert squares(packer.counts) == min(options)


def test_pour_bounds_open_windows():
    """Pieces of one size that never fit together: at most one padded window at the end."""
    packer = packing.Packer(packing.Settings(size=16, open=5))
    full = [w for i in range(100) for w in packer.place(packing.Piece(i, 0, bytes(40), 10))]
    assert packer.counts.sum() <= 5
    rest = list(packer.pour())
    assert sum(w.fill < 16 for w in full + rest) <= 1
    assert sum(w.fill for w in full + rest) == 1000
    assert len({w.number for w in full + rest}) == len(full + rest)


def test_token_file_reads_only_what_is_asked():
    docs = [(None, b"\1\0\0\0")] + [(i, np.arange(i % 50 + 1, dtype="<u4").tobytes()) for i in range(500)]
    out = io.BytesIO()
    writer = tokenstore.Writer(out, tokenstore.Settings(frame=1000))
    for d in docs:
        writer.add(*d)
    writer.close()
    reader = tokenstore.Reader(io.BytesIO(out.getvalue()))
    assert list(reader.documents()) == docs and len(reader.table) > 20
    reader = tokenstore.Reader(io.BytesIO(out.getvalue()))
    assert list(reader.documents({3, 499, 1000})) == [docs[4], docs[500]]
    assert reader.read_frames == 2
    damaged = bytearray(out.getvalue())
    damaged[30] ^= 1
    with pytest.raises(Exception):
        list(tokenstore.Reader(io.BytesIO(bytes(damaged))).documents())


def test_any_zstandard_decoder_reads_the_file():
    import zstandard

    out = io.BytesIO()
    writer = tokenstore.Writer(out, tokenstore.Settings(frame=8))
    for i in range(5):
        writer.add(i, b"abcd" * 3)
    writer.close()
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True)
    assert len(reader.read()) == sum(t[1] for t in writer.table)


def test_empty_file():
    out = io.BytesIO()
    tokenstore.Writer(out).close()
    assert list(tokenstore.Reader(io.BytesIO(out.getvalue())).documents()) == []


def test_round_trip(spark, encoder):
    rows = corpus()
    out = tokenstore.round_trip(clashing(frame(spark, rows))).orderBy("start").collect()
    key = lambda r: (r[0] is not None, r[0] or 0, within(r[1]), r[1] is not None, r[1] or "")
    at = 0
    for r, want in zip(out, sorted(rows, key=key), strict=True):
        ids = plain(encoder, want[1]) + [2]
        assert (r.doc_id, r.start, r.n_tokens, ids_of(r.ids)) == (want[0], at, len(ids), ids)
        at += len(ids)
    assert tokenstore.round_trip(frame(spark, [])).count() == 0


def within(text):
    """How rows of one doc_id are ordered; Spark hashes NULL to the seed."""
    return 42 if text is None else np.array(xxhash.xxh64_intdigest(text, 42), np.uint64).view(np.int64).item()


def test_one_doc_id_over_several_files(spark):
    """Rows of one doc_id, or none, do not all go to one task."""
    rows = [(None if i % 2 else 7, f"text {i}", None, None, None) for i in range(400)]
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # so few rows would be merged into one task
    try:
        files = tokenstore.write_files(frame(spark, rows).repartition(8), fresh_dir(spark, "hot"))
    finally:
        spark.conf.set(merge, "true")
    assert files.count() > 2
    out = tokenstore.read_files(files).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None] * 200 + [7] * 200
    ends = [r.start + r.n_tokens for r in out]
    assert [r.start for r in out] == [0, *ends[:-1]]


def test_crc_is_that_of_the_bytes(spark):
    got = spark.range(1).select(F.crc32(F.lit(bytearray(b"\1\2\3\4")))).first()[0]
    assert got == zlib.crc32(b"\1\2\3\4")
