"""Language ID by prediction by partial matching over bytes.

One byte context tree per language holds how often each byte followed each context of
up to ``order`` bytes.  A byte is coded in the longest context the tree knows; where it
never followed that context, the escape (method C) is paid and the next shorter context
tried, down to eight bits for any byte.  The statistics are frozen after learning, so the
code length of a byte is a fixed function of the ``order`` bytes before it: it is worked
out once per node, and the exact length of a text is the sum over its distinct
``order + 1``-grams times their counts.  The shortest code names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, sampled, share_of, stored

SLICE = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``sample``: documents to learn from per language, on average; ``nodes``: nodes
    of the longest contexts that a tree keeps over all languages, rarest dropped."""

    order: int = 3
    sample: int = 1_500
    nodes: int = 1_000_000


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_counts(text: str, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (order + 1)-grams of the lower-cased UTF-8 text, packed, and counts.

    The first bytes see line ends as their context.  Long texts go slice by slice.
    """
    data = np.frombuffer(
        b"\n" * order + text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8
    )
    codes, counts = [], []
    for start in range(0, len(data) - order, SLICE):
        piece = data[start : start + SLICE + order].astype(np.uint64)
        code = piece[: len(piece) - order]
        for k in range(1, order + 1):
            code = (code << np.uint64(8)) | piece[k : len(piece) - order + k]
        found, times = np.unique(code, return_counts=True)
        codes.append(found)
        counts.append(times)
    if len(codes) == 1:
        return codes[0], counts[0]
    return merge(codes, counts)


def merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not codes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found, at = np.unique(np.concatenate(codes), return_inverse=True)
    return found, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


@dataclass(frozen=True)
class Level:
    """Code lengths of the nodes of one context length, one column per language."""

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def position(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
    return at, hit


class Trees:
    """The frozen context trees of all languages."""

    def __init__(self, languages: list[str], order: int, grams: np.ndarray, counts: np.ndarray):
        """``counts``: one row per gram, one column per language."""
        self.languages, self.order = languages, order
        self.levels: list[Level] = []
        for k in range(order + 1):
            mask = np.uint64((1 << 8 * (k + 1)) - 1)
            found, at = np.unique(grams & mask, return_inverse=True)
            n = np.zeros((len(found), len(languages)))
            np.add.at(n, at, counts)
            contexts, at = np.unique(found >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), len(languages)))
            np.add.at(total, at, n)
            np.add.at(kinds, at, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escapes = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                direct = np.log2((total + kinds)[at] / n)
            shorter = self.code_lengths(found & (mask >> np.uint64(8)), k - 1)
            bits = np.where(n > 0, direct, escapes[at] + shorter)
            self.levels.append(Level(found, bits, contexts, escapes))

    def code_lengths(self, grams: np.ndarray, k: int) -> np.ndarray:
        """Bits of the last byte of each (k + 1)-gram after the bytes before it."""
        if k < 0:
            return np.full((len(grams), len(self.languages)), 8.0)
        level = self.levels[k]
        at, hit = position(level.grams, grams)
        out = level.bits[at] if len(level.grams) else np.zeros((len(grams), len(self.languages)))
        if not hit.all():
            rest = grams[~hit]
            mask = np.uint64((1 << 8 * k) - 1)
            at, known = position(level.contexts, rest >> np.uint64(8))
            escape = np.where(known[:, None], level.escapes[at], 0.0)
            out[~hit] = escape + self.code_lengths(rest & mask, k - 1)
        return out

    def lengths(self, text: str) -> np.ndarray:
        """Bits of the whole text under each language."""
        grams, counts = gram_counts(text, self.order)
        return counts @ self.code_lengths(grams, self.order)

    def name(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        bits = self.lengths(text)
        best = int(np.argmin(bits))
        return self.languages[best], float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def learn(docs: DataFrame, settings: Settings = Settings()) -> Trees:
    """Trees from ``docs`` (doc_id, text, lang), a bounded sample per language.

    Every document of a language is drawn with the same chance, so rare languages are
    learned from all they have and frequent ones from about ``settings.sample``.
    """
    spark = docs.sparkSession
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = sorted(
        (r["lang"], r["count"]) for r in known.groupBy("lang").count().collect()
    )  # a row per language
    languages = [name for name, _ in sizes]
    if not languages:
        return Trees([], settings.order, np.zeros(0, np.uint64), np.zeros((0, 0)))
    shares = spark.createDataFrame(
        [(i, n, share_of(settings.sample, c)) for i, (n, c) in enumerate(sizes)],
        "language int, lang string, share double",
    )
    chosen = sampled(
        known.select("doc_id", "text", "lang").join(F.broadcast(shares), "lang"),
        F.struct("doc_id", F.length("text")), F.col("share"),
    ).select("text", "language")
    order = settings.order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list, int]] = {}
        for batch in batches:
            for text, language in zip(batch.column("text"), batch.column("language")):
                codes, counts, size = held.get(language.as_py(), ([], [], 0))
                found, times = gram_counts(text.as_py(), order)
                codes.append(found)
                counts.append(times)
                size += len(found)
                if size > 1 << 20:
                    code, n = merge(codes, counts)
                    codes, counts, size = [code], [n], 0
                held[language.as_py()] = (codes, counts, size)
        for language, (codes, counts, _) in held.items():
            code, n = merge(codes, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(code), language, np.int32)),
                 pa.array(code.astype(np.int64)), pa.array(n)],
                ["language", "gram", "n"],
            )

    table = stored(
        chosen.mapInArrow(count, "language int, gram long, n long")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n")),
        "contexts",
    )
    least = 1
    while table.where(F.col("n") >= least).count() > settings.nodes:
        least *= 2
    kept = table.where(F.col("n") >= least).toPandas()  # at most ``nodes`` rows
    grams, at = np.unique(kept.gram.to_numpy().astype(np.uint64), return_inverse=True)
    counts = np.zeros((len(grams), len(languages)))
    counts[at, kept.language] = kept.n
    return Trees(languages, order, grams, counts)


def namer(spark, trees: Trees):
    """A function Column -> struct(lang_pred, score)."""
    shared = spark.sparkContext.broadcast(trees)  # bounded by Settings.nodes

    @F.pandas_udf("lang_pred string, score double")
    def name(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            yield pd.DataFrame(
                [known.name(t) for t in texts], columns=["lang_pred", "score"]
            )

    return name


def identify_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Predict the language of every document; fold 1 of 3 is never learned from.

    A text that is NULL or has no letter is ``und`` with score 0, and so is every text
    if there is nothing to learn from.  The score is the posterior of the named language
    under equal priors; equal code lengths go to the first language by name.  A NULL
    doc_id is named like any other, never learned from, and not held out.
    """
    trees = learn(docs.where(fold("doc_id", 3) != 1), settings)
    name = namer(docs.sparkSession, trees)
    return docs.select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        name("text").alias("named"),
    ).select("doc_id", "held_out", "named.lang_pred", "named.score")


def in_known_language(docs: DataFrame, least: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, all columns.

    Rejected are texts that are NULL or without a letter, and those of which no language
    has a posterior of ``least``.  With no language to learn, every text with a letter
    stays.
    """
    trees = learn(docs, settings)
    if not trees.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    name = namer(docs.sparkSession, trees)
    return docs.where(name("text")["score"] >= least)
