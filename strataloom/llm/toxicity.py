"""Toxicity: a linear model over character n-grams scaled by log-count ratios.

Features are the hashed character n-grams of the lower-cased text, present or absent.
Each has the log ratio of its (smoothed) document shares in the two classes; the ratio
scales the feature, and a logistic regression is fitted on the scaled features.

Fitting uses a bounded sample of labelled rows (``Settings.sample``), scoring covers
every text whole, long ones in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, labelled_sample, sigmoid

SLICE = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows to fit on; ``kept``: n-gram buckets with a weight."""

    shortest: int = 3
    longest: int = 5
    bits: int = 18
    sample: int = 12_000
    kept: int = 2_000
    smoothing: float = 1.0
    penalty: float = 5e-3
    rounds: int = 150


class Buckets:
    """The n-gram buckets present in a text."""

    def __init__(self, settings: Settings) -> None:
        self.settings = settings
        self.seen = np.zeros(1 << settings.bits, dtype=bool)

    def of(self, text: str) -> np.ndarray:
        s = self.settings
        padded = " " + " ".join(text.lower().split()) + " "
        overlap = s.longest - 1
        for start in range(0, max(1, len(padded) - overlap), SLICE):
            piece = padded[start : start + SLICE + overlap]
            chars = np.frombuffer(
                piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32
            ).astype(np.uint64)
            code = chars
            for n in range(2, s.longest + 1):
                if len(chars) < n:
                    break
                code = code[:-1] * np.uint64(0x100000001B3) + chars[n - 1 :]
                if n >= s.shortest:
                    mixed = (code ^ (code >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                    self.seen[mixed >> np.uint64(64 - s.bits)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


@dataclass(frozen=True)
class Model:
    settings: Settings
    weights: np.ndarray
    intercept: float

    def scores(self, texts) -> np.ndarray:
        buckets = Buckets(self.settings)
        sums = [self.weights[buckets.of(t or "")].sum() for t in texts]
        return sigmoid(np.asarray(sums, dtype=np.float64) + self.intercept)


def log_count_ratios(pos, neg, n_pos, n_neg, smoothing) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket the log-count ratio and how many standard errors it is from zero."""
    p = (pos + smoothing) / (n_pos + 2 * smoothing)
    q = (neg + smoothing) / (n_neg + 2 * smoothing)
    ratio = np.log(p / q)
    error = np.sqrt((1 - p) / (pos + smoothing) + (1 - q) / (neg + smoothing))
    return ratio, ratio / np.maximum(error, 1e-9)


def fit(sample: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on ``sample`` (text, label)."""
    totals = dict(sample.groupBy("label").count().collect())
    n_neg, n_pos = totals.get(0, 0), totals.get(1, 0)
    size = 1 << settings.bits
    if not n_pos or not n_neg:
        prior = 0.5 if not n_pos + n_neg else (n_pos + 0.5) / (n_pos + n_neg + 1)
        return Model(settings, np.zeros(size), float(np.log(prior / (1 - prior))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, held = Buckets(settings), np.zeros((2, size), dtype=np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label")):
                held[label.as_py(), buckets.of(text.as_py())] += 1
        any_ = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(any_, pa.int32()), pa.array(held[1, any_]), pa.array(held[0, any_])],
            ["bucket", "pos", "neg"],
        )

    counted = (
        sample.mapInArrow(count, "bucket int, pos long, neg long")
        .groupBy("bucket")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .toPandas()
    )  # at most 2 ** bits rows
    pos, neg = np.zeros(size), np.zeros(size)
    pos[counted.bucket], neg[counted.bucket] = counted.pos, counted.neg
    ratio, strength = log_count_ratios(pos, neg, n_pos, n_neg, settings.smoothing)
    order = np.lexsort((np.arange(size), -np.abs(strength)))[: settings.kept]
    order = np.sort(order)
    place = np.full(size, -1, dtype=np.int32)
    place[order] = np.arange(len(order))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(settings)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                at = place[buckets.of(text.as_py())]
                rows.append(at[at >= 0].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), batch.column("label").cast(pa.int32())],
                ["at", "label"],
            )

    kept = sample.mapInArrow(reduce, "at binary, label int").toPandas()
    w, b = fit_scaled(
        [np.frombuffer(x, dtype=np.int32) for x in kept["at"]],
        kept.label.to_numpy(dtype=np.float64), ratio[order], settings,
    )
    weights = np.zeros(size, dtype=np.float64)
    weights[order] = w * ratio[order]
    return Model(settings, weights, b)


def fit_scaled(bags, y, ratio, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights of ``ratio``-scaled binary features by logistic regression (Adam).

    The classes weigh alike in the loss; the intercept is set back to the class
    shares at the end.
    """
    sizes = np.array([len(x) for x in bags])
    cols = np.concatenate([*bags, np.zeros(0, np.int32)]).astype(np.int64)
    rows = np.repeat(np.arange(len(bags)), sizes)
    share = y.mean()
    importance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    w, b = np.zeros(len(ratio)), 0.0
    m, v, step = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1), 0.05
    for t in range(1, settings.rounds + 1):
        x = np.bincount(rows, weights=(w * ratio)[cols], minlength=len(y)) + b
        residual = (sigmoid(x) - y) * importance
        grad = np.bincount(cols, weights=residual[rows], minlength=len(ratio)) * ratio
        grad = np.append(grad + settings.penalty * w, residual.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def scorer(spark, model: Model):
    """A function Column -> Column with the score of a text."""
    shared = spark.sparkContext.broadcast(model)  # 2 ** bits weights

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for texts in batches:
            yield pd.Series(known.scores(texts))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Score every document; fitted on labelled rows outside fold 0 of 5.

    NULL and empty texts are scored alike, by the intercept.  A NULL doc_id is scored
    and never learned from; it counts as not held out.  Repeated rows are scored each.
    Without labels of both classes every score is the smoothed share of class 1.
    """
    model = fit(labelled_sample(docs, labels, "toxic", 5, settings.sample), settings)
    score = scorer(docs.sparkSession, model)
    return (
        docs.select(
            "doc_id",
            F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
            score(F.coalesce("text", F.lit(""))).alias("score"),
        )
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )
