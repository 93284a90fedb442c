"""Small inputs that hold the odd cases every operator has to stand."""

import random
import zlib

from strataloom.llm.common import importable

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LANGS = {"en": "the of and tion ing was here", "de": "der und keit ung sch ein über", "fr": "le une été que eau oi ment"}


def crc(x) -> int:
    return zlib.crc32(str(x).encode())


def prose(rng: random.Random, lang: str, words: int) -> str:
    parts = LANGS[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words))


def corpus(n: int = 240, seed: int = 1) -> list[tuple]:
    """Prose of three languages with exact and near copies and odd texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(LANGS))
        text = prose(rng, lang, rng.randint(5, 120))
        if rows and rng.random() < 0.3:
            _, text, lang, *_ = rng.choice(rows)
            words = text.split()
            if words and rng.random() < 0.6:
                words[rng.randrange(len(words))] = "changed"
                text = " ".join(words)
        rows.append((i, text, lang, "s0", len(text)))
    odd = ["", " \n\t ", None, "one", "One  two", "12 34 !!", "x" * 3000, "Ä b c", "a b c " * 4000]
    rows += [(n + k, t, "en" if k % 2 else None, None, None) for k, t in enumerate(odd)]
    rows += [(None, "no id here at all", "en", "s1", None), (None, None, None, None, None)]
    rows += [rows[0], rows[0]]
    return rows


def frame(spark, rows, schema: str = DOCS):
    return importable(spark).createDataFrame(rows, schema)


def clashing(df):
    """The same rows with columns that operators use as names of their own."""
    from pyspark.sql import functions as F

    names = ["fp", "rep", "score", "label", "prefix", "node", "root", "held_out", "component_id", "item_id", "ids"]
    return df.select("*", *(F.lit("x").alias(c) for c in names))
