import random
import re

import duckdb
import numpy as np
import pytest
from helpers import clashing, corpus, frame, prose
from pyspark.sql import functions as F

from strataloom.llm import ann, decontaminate, preference, urls
from strataloom.llm.queries import ORACLE_SQL, QUERIES, URL_RULES

SF_DIR = "/root/testdata/sf0.001"
BENCH = "item_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


def against_sql(df, sql, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t.toPandas().astype(object).where(lambda x: x.notna(), None) if not isinstance(t, str) else t)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want, got = plain(cursor.fetchall(), names), plain(df.collect(), df.columns)
    assert got == want
    return got


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF_DIR)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    rows = cursor.fetchall()
    assert rows and plain(df.collect(), df.columns) == plain(rows, names)


# -- decontamination ---------------------------------------------------------


def leaks():
    rng = random.Random(9)
    items = [(i, prose(rng, "en", rng.randint(5, 60))) for i in range(30)]
    items += [(100, "two words"), (101, ""), (102, None), (103, "a b c d e a b c d e a"), (104, items[3][1]), items[5], (None, "nul id has five words here")]
    docs = corpus(60)
    for k in range(60):
        words = items[k % 30][1].split()
        for _ in range(k // 30 * rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        long = prose(rng, "de", 3000 if k % 7 == 0 else 40)
        docs.append((1000 + k, f"{long}, {' '.join(words).upper()}. {prose(rng, 'fr', 20)}", "en", "s", 1))
    docs += [(2000, "Two, words!", "en", "s", 1), (2001, "a b c d e a b c", None, None, None), (2002, "null NUL id has five words here", None, None, None)]
    return docs, items


def test_contained_items_match_brute_force(spark):
    docs, items = leaks()

    def parts(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set(), len(w) < 5

    want = set()
    for item, text in items:
        b, short = parts(text)
        for d in docs:
            s, doc_short = parts(d[1])
            if b and short == doc_short and len(b & s) >= np.ceil(0.8 * len(b) - 1e-9):
                want.add((d[0], item, len(b), len(b & s)))
    for block in (16_000_000, 900):
        found = decontaminate.contained(clashing(frame(spark, docs)), "doc_id", frame(spark, items, BENCH), decontaminate.Settings(broadcast=block))
        got = [(r.doc_id, r.item_id, r.item_shingles, r.shared) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 40


def test_clean_keeps_rows_and_columns(spark):
    docs, items = leaks()
    docs.append((None, items[0][1], None, None, None))
    df, bench = clashing(frame(spark, docs)), frame(spark, items, BENCH)
    bad = {r.doc_id for r in decontaminate.contained(df, "doc_id", bench).collect()}
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns
    rows = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, rows)) == sorted(str(d[0]) for d in docs if d[0] not in bad or d[0] is None and d[1] != items[0][1])
    assert decontaminate.clean(df, frame(spark, [], BENCH)).count() == len(docs)
    assert decontaminate.clean(frame(spark, []), bench).count() == 0


# -- neighbours --------------------------------------------------------------


def vectors(n=900, d=16, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(8, d))[rng.integers(0, 8, n)] + 0.5 * rng.normal(size=(n, d))
    x[100:140] = x[100]
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    odd = [None, [], [0.0] * d, [float("nan")] + [1.0] * (d - 1), [float("inf")] * d, [None] + [1.0] * (d - 1), [1.0, 2.0]]
    return rows, rows + [(n + 20 + k, v) for k, v in enumerate(odd)] + [(None, rows[0][1]), rows[7]]


def exact(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i, v in rows:
        if i in queries:
            s = (x * np.array(v, dtype=np.float32).astype(np.float64)).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("cell", [4096, 60])
def test_neighbours(spark, cell):
    good, rows = vectors()
    df = frame(spark, rows, "vec_id long, embedding array<float>").withColumn("part", F.lit("x")).withColumn("score", F.lit(1))
    every = ann.Settings(mass=2.0, cell=cell)
    got: dict = {}
    for r in ann.search(df.where("vec_id % 20 = 0"), df, 20, every).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = exact(good, {i for i, _ in good if i % 20 == 0}, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(a[1] == pytest.approx(b[1], rel=1e-12) for q in want for a, b in zip(got[q], want[q]))


def test_recall_of_learned_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = exact(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    got = QUERIES["op8_nearest_neighbours"](spark, "/root/testdata/sf0.1").groupBy("query_id").agg(F.collect_set("vec_id").alias("v")).collect()
    assert np.mean([len(set(r.v) & {i for i, _ in want[r.query_id]}) / 20 for r in got]) >= 0.9 and len(got) == len(want)


def test_routing_lists_hold_enough():
    """However sure the router is, the lists hold the wanted vectors, or all there are."""
    rng = np.random.default_rng(4)
    for _ in range(50):
        p = rng.dirichlet(np.full(9, 0.05), size=30)
        held = rng.integers(0, 6, 9) * rng.integers(0, 2, 9)
        for parts in ann.routed(p, ann.Settings(mass=0.01, least=1), held, 12):
            assert held[parts].sum() >= min(12, held.sum())
            if held[parts[:-1]].sum() >= min(12, held.sum()):
                assert len(parts) == 1


@pytest.mark.parametrize("n", [21, 40, 173])
def test_every_query_gets_its_neighbours(spark, n):
    """With one partition asked for at least, small and lopsided tables still give k rows."""
    rng = np.random.default_rng(n)
    x = np.concatenate([rng.normal(size=(n - n // 3, 8)), np.tile(rng.normal(size=8), (n // 3, 1))])
    df = frame(spark, [(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    out = ann.search(df, df, 20, ann.Settings(mass=0.01, least=1)).collect()
    assert len(out) == n * min(20, n - 1) and all(r.query_id != r.vec_id for r in out)
    true = {(i, j): float((x[i] * x[j]).sum()) for i in range(n) for j in range(n)}
    assert all(r.score == pytest.approx(true[r.query_id, r.vec_id], rel=1e-12) for r in out)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = frame(spark, [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [1.0, 1.0])], schema)
    out = ann.search(few.where("vec_id % 20 = 0"), few, 20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in out] == [(0, 1, 3), (0, 2, 20), (20, 1, 3), (20, 2, 0)]
    none = frame(spark, [(0, None)], schema)
    assert ann.search(none, none, 20).count() == 0


def test_double_and_repeated_vectors(spark):
    """Doubles are not rounded; of a repeated vec_id the first vector in order is taken."""
    rows = [(0, [0.1, 0.2]), (1, [0.3, 0.1]), (1, [0.2, 0.9]), (1, [0.3, 0.1]), (2, [0.7, 0.1])]
    df = frame(spark, rows, "vec_id long, embedding array<double>")
    out = ann.search(df.where("vec_id % 20 = 0"), df, 20).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(1, 0.1 * 0.2 + 0.2 * 0.9), (2, 0.1 * 0.7 + 0.2 * 0.1)]


# -- preference pairs --------------------------------------------------------


def test_preference_pairs(spark):
    u, a = "user", "assistant"
    chosen = [(1, 0, u, "hi"), (1, 1, a, "good <|end|>"), (2, 0, u, "x"), (3, 0, None, None), (3, None, a, "z"), (None, 0, u, "lost"), (4, 0, u, "s"), (4, 1, u, "s"), (4, 1, u, "s")]
    rejected = [(1, 0, u, "hi"), (1, 1, a, "bad"), (1, 2, u, "why"), (3, 0, u, ""), (3, 1, a, "z"), (4, 0, u, "s"), (4, 1, u, "s"), (4, 1, u, "s"), (5, 0, a, "only")]
    out = preference.preference_pairs(frame(spark, chosen, TURNS), frame(spark, rejected, TURNS), "conv_id")
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    r = got[1]
    assert (r.prompt_turns, r.prompt, r.chosen) == (1, "<|user|>\nhi<|end|>\n", "<|assistant|>\ngood < |end|><|end|>\n")
    assert r.rejected == "<|assistant|>\nbad<|end|>\n<|user|>\nwhy<|end|>\n"
    assert r.chosen_mask == "0:14,1:21" and r.rejected_mask == "0:14,1:11,0:9,0:11"
    assert (got[2].prompt_turns, got[2].rejected, got[2].rejected_mask) == (0, "", "")
    assert (got[3].prompt_turns, got[3].chosen, got[4].prompt_turns, got[4].chosen) == (2, "", 3, "")
    assert got[5].chosen == "" and got[5].prompt == ""
    none = frame(spark, [], TURNS)
    assert preference.preference_pairs(none, none, "conv_id").count() == 0


def test_swapped_answers_match_sql(spark):
    rng = random.Random(3)
    rows = [(rng.choice([*range(20), None]), rng.choice([0, 1, 2, 3, None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "<|x|>"])) for _ in range(150)]
    df = frame(spark, rows, TURNS)
    extra = df.withColumn("last", F.lit(1)).withColumn("turns", F.lit(2))
    out = preference.preference_pairs(extra, preference.swapped_answers(extra), "conv_id")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cursor = con.execute(preference.SQL)
    assert plain(out.collect(), out.columns) == plain(cursor.fetchall(), [d[0] for d in cursor.description])


# -- URLs --------------------------------------------------------------------


def parts_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_by_hand(host, path):
    best = None
    for verdict, rule in URL_RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return best


ODD_URLS = [None, "", "no scheme", "http://", "://x.org/", "HTTP://WWW.Example.ORG/es/1?a=b#c", "http://example.org", "http://example.org/", "http://notexample.org/es/",
            "https://a.example.org/en/12", "https://a.example.org/en/2", "http://x.com/fr", "http://x.com/fr/", "http://com/de/x", "http://x.org?q=/es/", "http://x.org#/",
            "http://x.net/a?b=1&c=2", "http://ÄÖ.org/p", "a://b://c.org/d", "http://x.org:80/", "x" * 4000 + "://y.com/de/"]


def test_urls_rules_and_parts(spark):
    rng = random.Random(6)
    rows = [(i, u) for i, u in enumerate(ODD_URLS)] + [(None, "http://x.net/"), (3, "http://x.net/")]
    rows += [(100 + i, f"http://{rng.choice(['a', 'b.c', 'example'])}.{rng.choice(['com', 'org', 'net'])}/{rng.choice(['fr', 'de', 'es', 'en'])}/{rng.randint(1, 300)}") for i in range(300)]
    pages = frame(spark, rows, "page_id long, url string").withColumn("host", F.lit("h")).withColumn("s1", F.lit(1)).withColumn("f_path", F.lit(2))
    out = urls.judge(pages, URL_RULES).collect()
    assert len(out) == len(rows)
    want = {(p, *parts_by_hand(u)) for p, u in rows}
    assert {(r.page_id, r.host, r.path) for r in out} == want
    for r in out:
        best = rule_by_hand(r.host, r.path)
        assert r.rule == (best and best[1]) and r.verdict in ("allow", "block")
        assert best is None or r.verdict == best[0]


def test_urls_learned_from_rules(spark):
    """The trees find again what a rule would say about a host it does not name."""
    rng = random.Random(8)
    rows = [(i, f"http://h{i % 40}.com/{'de' if i % 2 else 'fr'}/" + ("9" * 12 + "?a=1&b=2" if i % 2 else "story")) for i in range(400)]
    rows += [(1000 + i, f"http://h{i}.net/xx/" + ("8" * 12 + "?c=1&d=2" if i % 2 else "words")) for i in range(40)]
    rng.shuffle(rows)
    out = urls.judge(frame(spark, rows, "page_id long, url string"), URL_RULES).where("page_id >= 1000").collect()
    assert np.mean([(r.verdict == "block") == bool(r.page_id % 2) for r in out]) > 0.9


def test_suffix_statistics_leave_own_labels_out(spark):
    """Next to a row-by-row version; a URL's features do not change with its label."""
    rng = random.Random(9)
    rows = [(rng.randint(0, 5), rng.choice(["allow", "block", "block", None]), rng.randint(0, 4)) for _ in range(400)]
    rows = [(s, said, fold if said else -1) for s, said, fold in rows] + [(9, "block", 2)]
    got = urls.suffix_statistics(frame(spark, rows, "s1 int, said string, fold int"), "s1", 0.25, urls.Settings()).collect()
    assert {(r.s1, r.fold) for r in got} == {(s, fold) for s, _, fold in rows} and len(got) == len({(s, f) for s, _, f in rows})
    for r in got:
        others = [said for s, said, fold in rows if s == r.s1 and said and fold != r.fold]
        assert r.f_s1_blocked == pytest.approx((others.count("block") + 4 * 0.25) / (len(others) + 4))
        assert r.f_s1_pages == pytest.approx(np.log1p(sum(s == r.s1 for s, _, _ in rows)))
    assert [r.f_s1_blocked for r in got if r.s1 == 9] == [0.25]


@pytest.mark.parametrize("rows, verdict", [([], None), ([(1, "http://x.net/")], "allow"), ([(1, "http://x.net/"), (2, "http://x.com/de/")], "block")])
def test_urls_without_two_classes(spark, rows, verdict):
    out = urls.judge(frame(spark, rows, "page_id long, url string"), URL_RULES).collect()
    assert len(out) == len(rows) and {r.verdict for r in out} <= {verdict}
