import os
import random
import re

import corpus_pipeline
from helpers import DOCS, clashing, corpus, frame, prose
from test_simhash import plain_components, plain_fingerprint

from strataloom.llm import langid, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def folder(spark, path):
    rng = random.Random(12)
    items = [(i, prose(rng, "en", 20)) for i in range(5)]
    rows = corpus(150)
    rows += [(500 + i, prose(rng, "fr", 30) + " " + items[i][1] + " . " + prose(rng, "de", 9), "fr", "s", 1) for i in range(5)]
    rows += [(600 + i, " ".join(w + "%%%" for w in prose(rng, "en", 60).split()), "en", "s", 1) for i in range(40)]
    labels = [(i, 1, 0) for i in range(150)] + [(600 + i, 0, 0) for i in range(40)]
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    frame(spark, labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    frame(spark, items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, items


def key(rows):
    return sorted(map(repr, rows))


def test_stages_against_plain_versions(spark, tmp_path):
    """Each stage on what its predecessor kept, next to a row-by-row version."""
    rows, items = folder(spark, str(tmp_path))
    sf_dir = str(tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = [tuple(r) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        if k == 0:
            trees = langid.learn(docs)
            want = [r for r in kept if trees.name(r[1])[1] >= 0.5]
        elif k == 1:
            model = quality.fit(quality.labelled_sample(docs, labels, "quality", 5, 6000))
            want = [r for r in kept if model.score(r[1]) >= 0.3]
        elif k == 2:
            known = {r[0]: plain_fingerprint(r[1]) for r in kept if r[0] is not None}
            first = plain_components(known)
            want = [r for r in dict.fromkeys(kept) if r[0] is None or first[r[0]] == r[0]]
        elif k == 3:
            def parts(t):
                w = re.findall(r"[^\W_]+", t.lower())
                return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}
            want = [r for r in kept if all(len(parts(t) & parts(r[1])) < 0.8 * len(parts(t)) for _, t in items)]
        out = stage(spark, docs, sf_dir)
        if k == 4:
            tokens = {}
            for r in out.collect():
                tokens[r.doc_id] = r.doc_tokens
            assert set(tokens) == {r[0] for r in kept} and min(tokens.values()) > 1
            break
        assert out.columns == COLUMNS
        out.write.parquet(f"{sf_dir}/{name}")
        docs = spark.read.parquet(f"{sf_dir}/{name}")
        got = [tuple(r) for r in docs.collect()]
        assert key(got) == key(want), name
        assert 0 < len(got) < len(kept)
        kept = got
    assert corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct().count() == len({r[0] for r in kept})


def test_empty_and_clashing_input(spark, tmp_path):
    _, _ = folder(spark, str(tmp_path))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), str(tmp_path)).count() == 0
        if name != "packing":
            wide = clashing(spark.read.parquet(os.path.join(str(tmp_path), "documents.parquet")))
            out = stage(spark, wide, str(tmp_path))
            assert out.columns == wide.columns and out.count() > 0
