"""Quality: attention over the passages of a document, learned from document labels.

Multiple-instance learning.  Each passage is encoded from the make-up of its bytes,
gated attention weighs the passages of a document, and the weighted passage
representation is scored.  Only documents have labels; the weights say which passages
speak for them.

Fitting uses a bounded sample of labelled rows (``Settings.sample``).  Scoring reads
every passage of every text; a long text goes block by block, with running sums of
the attention.
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

PAIRS = 128
CLASSES = 40
WIDTH = CLASSES + PAIRS + 2


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows to fit on; ``passage``: bytes of a passage."""

    passage: int = 512
    block: int = 2_048
    hidden: int = 24
    gate: int = 12
    sample: int = 6_000
    steps: int = 560
    batch: int = 128
    step: float = 0.01
    penalty: float = 1e-4


def byte_classes() -> np.ndarray:
    """Small letters, capitals, digits, blanks, line ends, each ASCII sign, the rest."""
    kind = np.full(256, CLASSES - 1, dtype=np.int64)
    kind[:128] = CLASSES - 2
    kind[ord("a") : ord("z") + 1], kind[ord("A") : ord("Z") + 1] = 0, 1
    kind[ord("0") : ord("9") + 1], kind[ord(" ")], kind[ord("\n")] = 2, 3, 4
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    kind[signs] = 5 + np.arange(len(signs))
    return kind


KIND = byte_classes()


def encode_passages(data: np.ndarray, size: int, before: int | None = None) -> np.ndarray:
    """One row of features per passage of ``size`` bytes; an empty text has one.

    ``before`` is the byte in front of ``data`` in a longer text.
    """
    n = max(1, -(-len(data) // size))
    out = np.zeros((n, WIDTH), dtype=np.float32)
    if not len(data):
        return out
    at = np.arange(len(data)) // size
    lengths = np.bincount(at, minlength=n)[:, None]
    kinds = np.bincount(at * CLASSES + KIND[data], minlength=n * CLASSES)
    out[:, :CLASSES] = np.sqrt(kinds.reshape(n, CLASSES) / lengths)
    shifted = np.roll(data, 1)
    shifted[0] = 0 if before is None else before
    low, front = (_small(x).astype(np.int64) for x in (data, shifted))
    pair = (front * 31 + low * 57) % PAIRS
    since = 0 if before is not None else 1  # the first byte of a text ends no pair
    pairs = np.bincount((at * PAIRS + pair)[since:], minlength=n * PAIRS)
    out[:, CLASSES : CLASSES + PAIRS] = np.sqrt(pairs.reshape(n, PAIRS) / lengths)
    blanks = kinds.reshape(n, CLASSES)[:, 3:5].sum(axis=1, keepdims=True)
    out[:, -2:-1] = np.log1p(lengths) / np.log1p(size)
    out[:, -1:] = np.log1p(lengths / (1 + blanks)) / 4
    return out


def _small(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return data | np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


@dataclass
class Model:
    settings: Settings
    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def represent(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Passage representations, the two halves of the gate, attention logits."""
        p = self.weights
        h = np.tanh(((x - self.centre) / self.scale) @ p["enc"] + p["enc0"])
        t, s = np.tanh(h @ p["tan"]), sigmoid(h @ p["sig"])
        return h, t, s, (t * s) @ p["att"]

    def score(self, text: str | None) -> float:
        data = as_bytes(text)
        step = self.settings.passage * self.settings.block
        top, total, mixed = -np.inf, 0.0, 0.0
        for start in range(0, max(1, len(data)), step):
            before = int(data[start - 1]) if start else None
            x = encode_passages(data[start : start + step], self.settings.passage, before)
            h, _, _, e = self.represent(x)
            peak = max(top, float(e.max()))
            a = np.exp(e - peak)
            fade = np.exp(top - peak) if total else 0.0
            total, mixed, top = total * fade + a.sum(), mixed * fade + a @ h, peak
        return float(sigmoid((mixed / total) @ self.weights["out"] + self.weights["out0"][0]))


def fit_bags(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, settings: Settings) -> Model:
    """Fit encoder, gated attention and output together by Adam on batches of bags."""
    rng = np.random.default_rng(7)
    d, k = settings.hidden, settings.gate
    weights = {
        "enc": rng.normal(0, WIDTH**-0.5, (WIDTH, d)), "enc0": np.zeros(d),
        "tan": rng.normal(0, d**-0.5, (d, k)), "sig": rng.normal(0, d**-0.5, (d, k)),
        "att": rng.normal(0, k**-0.5, k), "out": rng.normal(0, d**-0.5, d),
        "out0": np.zeros(1),
    }
    model = Model(settings, x.mean(axis=0), x.std(axis=0) + 1e-2, weights)
    first = {n: np.zeros_like(v) for n, v in weights.items()}
    second = {n: np.zeros_like(v) for n, v in weights.items()}
    starts = np.concatenate([[0], np.cumsum(sizes)])
    t = 0
    while t < settings.steps:
        for chosen in np.array_split(rng.permutation(len(y)), max(1, len(y) // settings.batch)):
            t += 1
            rows = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in chosen])
            grads = gradients(model, x[rows], sizes[chosen], y[chosen])
            for n, g in grads.items():
                g = g + settings.penalty * weights[n]
                first[n] += 0.1 * (g - first[n])
                second[n] += 0.01 * (g * g - second[n])
                weights[n] -= (
                    settings.step * (first[n] / (1 - 0.9**t))
                    / (np.sqrt(second[n] / (1 - 0.99**t)) + 1e-8)
                )
    return model


def gradients(model: Model, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict:
    """Gradient of the mean log loss of some bags; rows of ``x`` lie bag after bag."""
    p = model.weights
    bag = np.repeat(np.arange(len(sizes)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    h, t, s, e = model.represent(x)
    a = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a /= np.add.reduceat(a, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first)
    wrong = (sigmoid(z @ p["out"] + p["out0"][0]) - y) / len(y)
    dz = wrong[:, None] * p["out"]
    da = (h * dz[bag]).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, first)[bag])
    dt = (de[:, None] * p["att"]) * s * (1 - t * t)
    ds = (de[:, None] * p["att"]) * t * s * (1 - s)
    dh = a[:, None] * dz[bag] + dt @ p["tan"].T + ds @ p["sig"].T
    dx = dh * (1 - h * h)
    return {
        "enc": ((x - model.centre) / model.scale).T @ dx, "enc0": dx.sum(axis=0),
        "tan": h.T @ dt, "sig": h.T @ ds, "att": (t * s).T @ de,
        "out": z.T @ wrong, "out0": np.array([wrong.sum()]),
    }


def fit(sample: DataFrame, settings: Settings = Settings()) -> Model | float:
    """Fit on ``sample`` (text, label); a constant where one class is missing."""
    totals = dict(sample.groupBy("label").count().collect())
    if len(totals) < 2:
        return (totals.get(1, 0) + 0.5) / (sum(totals.values()) + 1)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [
                encode_passages(as_bytes(t.as_py()), settings.passage).astype(np.float16)
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.tobytes() for b in bags], pa.binary()),
                 batch.column("label").cast(pa.int32())],
                ["bag", "label"],
            )

    rows = sample.mapInArrow(encode, "bag binary, label int").toPandas()
    rows = rows.sort_values(["label", "bag"], kind="stable")  # the same fit on every run
    bags = [np.frombuffer(b, np.float16).reshape(-1, WIDTH) for b in rows.bag]
    sizes = np.array([len(b) for b in bags])
    x = np.concatenate(bags).astype(np.float32)
    return fit_bags(x, sizes, rows.label.to_numpy(dtype=np.float64), settings)


def scorer(spark, model: Model | float):
    """A function Column -> Column with the score of a text."""
    shared = spark.sparkContext.broadcast(model)  # a few thousand weights

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for texts in batches:
            if isinstance(known, float):
                yield pd.Series(np.full(len(texts), known))
            else:
                yield pd.Series([known.score(t) for t in texts], dtype=np.float64)

    return score


def learned_scorer(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()):
    """Fit on labelled rows of ``docs`` outside fold 0 of 5, return the scorer."""
    sample = labelled_sample(docs, labels, "quality", 5, settings.sample)
    return scorer(docs.sparkSession, fit(sample, settings))


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Score every document; fitted on labelled rows outside fold 0 of 5.

    NULL and empty texts are one empty passage and share one score.  A NULL doc_id is
    scored, never learned from and not held out.  Repeated rows are scored each.
    Without labels of both classes every score is the smoothed share of class 1.
    """
    score = learned_scorer(docs, labels, settings)
    return docs.select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        score(F.coalesce("text", F.lit(""))).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
