import numpy as np
import pytest
import xxhash
from helpers import clashing, corpus, frame
from pyspark.sql import functions as F

from strataloom.llm import graph, simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, budget=2):
    """Smallest id per component, by looking at every pair."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_fingerprint_matches_plain_form():
    for _, text, *_ in corpus(60):
        assert simhash.fingerprint(text.encode() if text is not None else None) == plain_fingerprint(text)


def test_fingerprint_in_slices(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    whole = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text.encode()) == whole


def test_links_find_every_near_pair(monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    flips = [np.uint64(1) << np.uint64(b) for b in rng.integers(0, 64, 400)]
    data = {int(rng.choice(centres)) ^ int(a) ^ int(b) for a, b in zip(flips, flips[1:])}
    data = np.array(sorted(data), dtype=np.uint64)
    want = {
        (i, j) for i in range(len(data)) for j in range(i + 1, len(data))
        if int(data[i] ^ data[j]).bit_count() <= 2
    }
    for chunk in (1 << 17, 50):
        monkeypatch.setattr(simhash, "FRONTIER", chunk)
        got = [p for i, j in simhash.links(data, data, 2) for p in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == want
        half = data[::2].copy()
        crossed = [p for i, j in simhash.links(half, data, 2) for p in zip(i.tolist(), j.tolist())]
        near = {(i, j) for i in range(len(half)) for j in range(len(data)) if int(half[i] ^ data[j]).bit_count() <= 2}
        assert len(crossed) == len(set(crossed)) and set(crossed) == near


@pytest.mark.parametrize("leaf", [16_384, 9])
def test_near_copies_match_all_pairs(spark, leaf):
    """A small ``leaf`` opens dense nodes of the trie over several levels."""
    rows = corpus()
    out = simhash.near_copies(clashing(frame(spark, rows)), simhash.Settings(leaf=leaf)).collect()
    assert len(out) == len(rows)
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows if r[0] is not None}
    want = plain_components(prints)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and len(r.fingerprint) == 16
        else:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id])
    assert len(set(want.values())) < len(want) - 20


def test_dense_fingerprints_over_many_nodes(spark):
    """Clusters of fingerprints that share long prefixes."""
    rng = np.random.default_rng(5)
    fps = {(0b1011 << 60) | (int(rng.integers(0, 3)) << 40) | (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c))
           for a, b, c in rng.integers(0, 60, (300, 3))}
    fps |= {int(x) for x in rng.integers(0, 2**63, 60)}
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(sorted(fps))]
    nodes = spark.createDataFrame(rows, "fp long, rep long")
    roots = dict(graph.components(simhash.trie_links(nodes, simhash.Settings(leaf=20))).collect())
    want = plain_components({i: f for i, f in enumerate(sorted(fps))})
    assert {i: roots.get(i, i) for i in want} == want


def test_empty_table(spark):
    assert simhash.near_copies(frame(spark, [])).count() == 0
    assert simhash.one_of_each(frame(spark, [])).count() == 0


def test_one_of_each_with_a_doc_id_of_two_texts(spark):
    """Both texts of the smallest doc_id stay, what is near either of them goes."""
    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five six", "quite another text of its own here")
    rows = [(1, a), (1, b), (1, a), (2, a), (3, b), (4, c), (5, c), (None, a), (None, a)]
    df = frame(spark, rows, "doc_id long, text string").selectExpr("*", "'x' AS kept_id", "doc_id AS rep")
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in out.collect())
    assert [(i, t) for (_, i), t in got] == [(1, a), (1, b), (4, c), (0, a), (0, a)]


def test_components_of_chain_and_star(spark):
    links = [(i + 1, i) for i in range(40)] + [(100 + i, 99) for i in range(1, 60)]
    edges = spark.createDataFrame(links, "a long, b long").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    got = dict(graph.components(edges).collect())
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 99 for i in range(1, 60)}
