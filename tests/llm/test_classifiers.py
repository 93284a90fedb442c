import random

import numpy as np
import pytest
from helpers import clashing, corpus, crc, frame, prose

from strataloom.llm import langid, quality, toxicity
from strataloom.llm.common import labelled_sample

LABELS = "doc_id long, quality int, toxic int"


def labelled(n=400):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        text = prose(rng, rng.choice(["en", "de", "fr"]), rng.randint(30, 80))
        if toxic:
            text += " you blithering numskull " * 2
        if not good:
            text = " ".join(w + "%%% |" for w in text.split())
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, good, toxic))
    odd = [("", None), (None, None), ("x" * 5000, None), ("Ä" * 10, 1)]
    docs += [(n + k, t, None, None, None) for k, (t, _) in enumerate(odd)]
    docs += [(None, "no id", "en", None, None), docs[0]]
    labels += [(n + k, v, v) for k, (_, v) in enumerate(odd)] + [(None, 1, 1), labels[1], (0, None, None)]
    return docs, labels


@pytest.mark.parametrize("module, label, line", [(toxicity, 2, 0.5), (quality, 1, 0.3)])
def test_classifier_on_held_out_rows(spark, module, label, line):
    docs, labels = labelled()
    df = clashing(frame(spark, docs))
    out = module.score_documents(df, frame(spark, labels, LABELS)).collect()
    assert len(out) == len(docs)
    truth = {r[0]: r[label] for r in labels if r[0] is not None}
    right = []
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= line)
        assert r.held_out == (r.doc_id is not None and crc(r.doc_id) % 5 == 0)
        if r.held_out and truth.get(r.doc_id) is not None and r.doc_id < 400:
            right.append(r.predicted == truth[r.doc_id])
    assert np.mean(right) > 0.9
    by = {r.doc_id: r.score for r in out}
    assert by[400] == by[401]  # empty and NULL


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifier_without_labels_or_rows(spark, module):
    docs, labels = labelled(20)
    empty = frame(spark, [], LABELS)
    assert {r.score for r in module.score_documents(frame(spark, docs), empty).collect()} == {0.5}
    assert module.score_documents(frame(spark, []), frame(spark, labels, LABELS)).count() == 0


def test_repeated_rows_keep_the_bound_of_the_sample(spark):
    """A document that is most of the rows is one row of the sample."""
    docs, labels = labelled(40)
    hot = next(d for d in docs if d[0] is not None and crc(d[0]) % 5)
    df, known = (frame(spark, docs + [hot] * 300), frame(spark, labels, LABELS))
    drawn = labelled_sample(df, known, "toxic", 5, 1000)
    ids = {r[0] for r in labels if r[0] is not None and r[2] is not None and crc(r[0]) % 5}
    assert drawn.count() == len(ids)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_held_out_labels_are_never_read(spark, module):
    docs, labels = labelled(150)
    flipped = [(d, q, t) if d is None or crc(d) % 5 else (d, 1, 1) for d, q, t in labels]
    a, b = (
        {r.doc_id: r.score for r in module.score_documents(frame(spark, docs), frame(spark, x, LABELS)).collect()}
        for x in (labels, flipped)
    )
    assert a.keys() == b.keys() and np.allclose(list(a.values()), [b[k] for k in a])


def test_toxic_slices_equal_whole_text(monkeypatch):
    text = prose(random.Random(2), "en", 400)
    buckets = toxicity.Buckets(toxicity.Settings())
    whole = buckets.of(text)
    monkeypatch.setattr(toxicity, "SLICE", 50)
    assert np.array_equal(buckets.of(text), whole)


def test_quality_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, sizes, y = rng.normal(size=(7, quality.WIDTH)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])
    model = quality.fit_bags(x, sizes, y, quality.Settings(steps=2, hidden=5, gate=3))

    def loss():
        total, at = 0.0, 0
        for n, t in zip(sizes, y):
            h, _, _, e = model.represent(x[at : at + n])
            a = np.exp(e - e.max())
            p = quality.sigmoid((a / a.sum()) @ h @ model.weights["out"] + model.weights["out0"][0])
            total -= t * np.log(p) + (1 - t) * np.log(1 - p)
            at += n
        return total / len(y)

    grads = quality.gradients(model, x, sizes, y)
    for name, w in model.weights.items():
        at = tuple(rng.integers(0, s) for s in w.shape)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        down = loss()
        w[at] += 1e-5
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_quality_blocks_equal_whole_text():
    docs, labels = labelled(60)
    bags = [quality.encode_passages(quality.as_bytes(d[1]), 512) for d in docs[:60]]
    s = quality.Settings(steps=40)
    model = quality.fit_bags(np.concatenate(bags), np.array([len(b) for b in bags]), np.array([float(r[1]) for r in labels[:60]]), s)
    text = prose(random.Random(1), "de", 2000)
    whole = model.score(text)
    model.settings = quality.Settings(block=2)
    assert model.score(text) == pytest.approx(whole, rel=1e-6)


def plain_bits(text, counts, order):
    """Code length byte by byte from a plain dictionary of contexts."""
    data, total = b"\n" * order + text.lower().encode(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            followed = counts.get(data[i - k : i], {})
            n, kinds = sum(followed.values()), len(followed)
            if not n:
                continue
            if data[i] in followed:
                total += np.log2((n + kinds) / followed[data[i]])
                break
            total += np.log2((n + kinds) / kinds)
        else:
            total += 8
    return total


def test_code_lengths_match_plain_coder(spark):
    rows = [r for r in corpus(80) if r[1] and r[2] and r[0] is not None]
    trees = langid.learn(frame(spark, rows), langid.Settings(order=2))
    for language, texts in {n: [r[1] for r in rows if r[2] == n] for n in trees.languages}.items():
        counts: dict = {}
        for t in texts:
            data = b"\n\n" + t.lower().encode()
            for i in range(2, len(data)):
                for k in range(3):
                    followed = counts.setdefault(data[i - k : i], {})
                    followed[data[i]] = followed.get(data[i], 0) + 1
        for text in ("der und zebra", "qx!", "über " * 9, texts[0]):
            got = trees.lengths(text)[trees.languages.index(language)]
            assert got == pytest.approx(plain_bits(text, counts, 2))


def test_language_of_held_out_rows(spark):
    rows = corpus(400)
    out = langid.identify_documents(clashing(frame(spark, rows))).collect()
    assert len(out) == len(rows)
    truth = {r[0]: r for r in rows}
    named = []
    for r in out:
        text = truth[r.doc_id][1]
        if text is None and r.doc_id is not None or text is not None and not any(map(str.isalpha, text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.held_out and r.doc_id < 400:
            named.append(r.lang_pred == truth[r.doc_id][2])
        assert 0 <= r.score <= 1
    assert np.mean(named) > 0.97


def test_language_with_nothing_to_learn(spark):
    rows = [(i, "some text", None, None, None) for i in range(4)]
    assert {r.lang_pred for r in langid.identify_documents(frame(spark, rows)).collect()} == {"und"}
    assert langid.identify_documents(frame(spark, [])).count() == 0


def test_language_slices_equal_whole_text(monkeypatch):
    text = prose(random.Random(3), "fr", 300)
    a = langid.gram_counts(text, 3)
    monkeypatch.setattr(langid, "SLICE", 64)
    b = langid.gram_counts(text, 3)
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
