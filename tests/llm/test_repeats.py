import hashlib
import random
import re

import numpy as np
from helpers import clashing, corpus, frame, prose

from strataloom.llm import repeats

LENGTH = 13


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_kept(rows, length=LENGTH):
    """Row by row, over all windows as tuples of words."""
    least = {}
    for doc_id, text, *_ in rows:
        w = words_of(text)
        for i in range(len(w) - length + 1 if doc_id is not None else 0):
            key = tuple(w[i : i + length])
            least[key] = min(least.get(key, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - length + 1 if doc_id is not None else 0):
            if least[tuple(w[i : i + length])] < doc_id:
                gone |= set(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def with_passages(seed=3):
    """Prose in which passages of 5 to 60 words recur, also twice in one document."""
    rng = random.Random(seed)
    passages = [prose(rng, "en", n) for n in (5, 12, 13, 14, 26, 60)]
    rows = corpus(120, seed)
    for i in range(60):
        parts = [prose(rng, "fr", rng.randint(0, 20)), rng.choice(passages), rng.choice(passages), prose(rng, "de", 3)]
        rows.append((1000 + rng.randrange(40), rng.choice([" ", "\n\n", "\t "]).join(parts), "en", "s", 1))
    rows += [(2000 - i, passages[5], "en", "s", 1) for i in range(300)]
    rows += [(3000 + i, " ".join(passages[4].split()[: 10 + i]), "en", "s", 1) for i in range(8)]
    rows += [(3100, " ".join(["same"] * 500), "en", "s", 1), (3101, " ".join(["same"] * 14), "en", "s", 1)]
    rows += [(3200, "a b  c\u0085d " * 20, "en", "s", 1), (3201, "x a b  c\u0085d " + "a b  c\u0085d " * 19, "en", "s", 1)]
    return rows


def test_against_all_windows(spark):
    rows = with_passages()
    rng = random.Random(1)
    rng.shuffle(rows)
    out = repeats.without_repeats(frame(spark, rows).repartition(7))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    got = out.collect()
    assert sorted(repr(tuple(r)[:4]) for r in got) == plain_kept(rows)
    for r in got:
        if r.kept is not None:
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_other_lengths_and_small_chunks(spark, monkeypatch):
    rows = with_passages(9)
    for length in (1, 2, 6):
        out = repeats.without_repeats(frame(spark, rows).repartition(3), repeats.Settings(length=length, bucket=1 << 12))
        assert sorted(repr(tuple(r)[:4]) for r in out.collect()) == plain_kept(rows, length)


def test_chosen_halves_stand_for_full_windows():
    """Equal full windows choose equal halves, wherever they lie."""
    rng = random.Random(4)
    settings = repeats.Settings()
    shared = prose(rng, "en", LENGTH).split()
    for _ in range(30):
        texts = [" ".join(prose(rng, "de", rng.randint(0, 9)).split() + shared + prose(rng, "fr", 5).split()) for _ in "ab"]
        chosen = []
        for t in texts:
            words = repeats.Words(t.encode())
            first = next(i for i in range(len(words)) if [w.decode() for w in words.parts[i : i + LENGTH]] == shared)
            stands, hashes = repeats.least_halves(words, settings)
            spot = stands[first]
            assert first <= spot and spot + settings.half <= first + LENGTH
            assert first in repeats.extendable(words, np.array([spot]), settings)
            chosen.append((spot - first, hashes[spot]))
        assert chosen[0] == chosen[1]


def test_longest_repeats(spark):
    """Doubling goes on until no window survives: 13, 26, 52, ... words."""
    rng = random.Random(5)
    text = {n: prose(rng, "en", n).split() for n in (12, 13, 25, 26, 51, 52, 120)}
    rows = []
    for n, w in text.items():
        rows += [(n, " ".join(prose(rng, "de", 4).split() + w)), (500 + n, " ".join(w + prose(rng, "fr", 6).split()))]
    rows += [(900, "own words " * 5), (901, None), (None, " ".join(text[13]))]
    got = {r.doc_id: r.words for r in repeats.longest_repeats(frame(spark, rows, "doc_id long, text string")).collect()}
    want = {13: 13, 25: 13, 26: 26, 51: 26, 52: 52, 120: 104}
    for n, words in want.items():
        assert got.pop(n) == words and got.pop(500 + n) == words
    assert not got


def test_empty_and_clashing(spark):
    assert repeats.without_repeats(frame(spark, [])).count() == 0
    wide = clashing(frame(spark, with_passages()))
    names = ["tag", "copy_of", "text_of", "first_id", "spots", "lists", "kept", "bucket", "known", "n_words"]
    wide = wide.selectExpr("*", *[f"'x' AS {c}" for c in names])
    plain = repeats.without_repeats(frame(spark, with_passages()))
    assert sorted(map(repr, repeats.without_repeats(wide).collect())) == sorted(map(repr, plain.collect()))


def test_sql_on_a_small_table(spark, tmp_path):
    import duckdb

    rows = [r for r in dict.fromkeys(with_passages(6)) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert sorted(map(repr, con.execute(repeats.SQL).fetchall())) == plain_kept(rows)
