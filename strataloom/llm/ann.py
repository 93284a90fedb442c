"""Nearest neighbours by learned partitions.

On a bounded sample of vectors a neighbour graph is built and cut into partitions of
balanced size that keep neighbours together.  A small network learns to name the
partitions in which a vector's neighbours lie.  It then assigns every vector of the table
to its most probable partition, and routes a query to the several most probable ones,
where all vectors are ranked by exact inner products.  The list of partitions of a query goes
on until they hold as many vectors as it asks for, however uneven the partitions are.

A partition is laid out in slices of bounded size, and the queries routed to it in blocks,
so that a partition that holds most vectors (many copies of one vector, say) is searched
by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sampled, share_of, stored

CLOSE = 1e-6


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors to fit on; ``cell``: vectors or queries that meet in one task;
    ``mass``: probability a query's partitions must have together, ``least`` at least."""

    sample: int = 5_000
    partitions: int = 16
    neighbours: int = 20
    slack: float = 1.2
    rounds: int = 15
    hidden: int = 96
    steps: int = 500
    mass: float = 0.95
    least: int = 3
    cell: int = 4_096


def usable(vector: Column) -> Column:
    """Not NULL, empty or zero, all components finite."""
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_of(x: np.ndarray, k: int) -> np.ndarray:
    """Positions of each row's ``k`` largest inner products with other rows."""
    out = []
    for at in range(0, len(x), 512):
        s = x[at : at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(near: np.ndarray, x: np.ndarray, parts: int, settings: Settings) -> np.ndarray:
    """A partition of the neighbour graph into parts of at most slack times the mean.

    Starts from halving along principal directions; then nodes move to the part most of
    their neighbours are in, best gain first, as long as there is room.
    """
    n = len(x)
    part = np.zeros(n, dtype=np.int64)
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups.sort(key=len)
        own = groups.pop()
        centred = x[own] - x[own].mean(axis=0)
        _, _, axes = np.linalg.svd(centred.T @ centred)
        order = own[np.argsort(centred @ axes[0], kind="stable")]
        groups += [order[: len(order) // 2], order[len(order) // 2 :]]
    for p, own in enumerate(groups):
        part[own] = p
    rows = np.concatenate([np.repeat(np.arange(n), near.shape[1]), near.ravel()])
    cols = np.concatenate([near.ravel(), np.repeat(np.arange(n), near.shape[1])])
    room = int(np.ceil(settings.slack * n / parts))
    sizes = np.bincount(part, minlength=parts)
    for _ in range(settings.rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (rows, part[cols]), 1.0)
        to = votes.argmax(axis=1)
        gain = votes[np.arange(n), to] - votes[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[to[i]] < room:
                sizes[part[i]] -= 1
                sizes[to[i]] += 1
                part[i] = to[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer: the partitions a vector's neighbours lie in."""

    weights: list[np.ndarray]

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.weights[0] + self.weights[1], 0.0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.hidden(x) @ self.weights[2] + self.weights[3]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit_router(x: np.ndarray, settings: Settings = Settings()) -> Router:
    """Partition the neighbour graph of ``x`` and learn to name the partitions."""
    rng = np.random.default_rng(11)
    n, parts = len(x), min(settings.partitions, max(1, len(x) // 8))
    if parts == 1:
        d = x.shape[1]
        return Router([np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])
    near = nearest_of(x, min(settings.neighbours, n - 1))
    part = balanced_parts(near, x, parts, settings)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), near.shape[1]), part[near.ravel()]), 1.0)
    target[np.arange(n), part] += 1.0
    target /= target.sum(axis=1, keepdims=True)
    d, h = x.shape[1], settings.hidden
    scale = np.sqrt(d) / np.linalg.norm(x, axis=1).mean()
    w = [rng.normal(0, np.sqrt(2 / d), (d, h)) * scale, np.zeros(h), rng.normal(0, np.sqrt(1 / h), (h, parts)), np.zeros(parts)]
    router, m, v = Router(w), [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for t in range(1, settings.steps + 1):
        rows = rng.choice(n, min(n, 512), replace=False)
        xb = x[rows]
        a = router.hidden(xb)
        dz = (router.probabilities(xb) - target[rows]) / len(rows)
        da = (dz @ w[2].T) * (a > 0)
        for k, g in enumerate((xb.T @ da, da.sum(axis=0), a.T @ dz, dz.sum(axis=0))):
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            w[k] -= (0.01 / (1 + t / 200)) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    return router


def routed(p: np.ndarray, settings: Settings, held: np.ndarray, wanted: int) -> list[list[int]]:
    """The most probable partitions of each row, until ``mass`` is reached and they hold
    ``wanted`` vectors or all there are; ``held`` is the number in each partition."""
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
    within = np.cumsum(held[order], axis=1)
    short = within < min(wanted, int(held.sum()))
    need = 1 + np.maximum((before < settings.mass).sum(axis=1), short.sum(axis=1))
    return [o[: max(settings.least, k)].tolist() for o, k in zip(order, need)]


def best_in_cell(queries: pd.DataFrame, vectors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of each query among ``vectors``, exact, ties to smaller ids."""
    out = []
    if len(queries) and len(vectors):
        ids = vectors.vec_id.to_numpy()
        x = np.stack(vectors.vector.to_numpy()).astype(np.float64)
        for at in range(0, len(queries), 256):
            own = queries.iloc[at : at + 256]
            q = np.stack(own.vector.to_numpy()).astype(np.float64)
            rough = q @ x.T
            for row, query_id, vector in zip(rough, own.vec_id, q):
                row[ids == query_id] = -np.inf
                keep = min(k, len(row))
                edge = np.partition(row, len(row) - keep)[len(row) - keep]
                close = np.flatnonzero((row >= edge - CLOSE * max(1.0, abs(edge))) & (row > -np.inf)) if np.isfinite(edge) else np.flatnonzero(row > -np.inf)
                # Row sums do not depend on a vector's place, so copies score alike.
                score = (x[close] * vector).sum(axis=1)
                best = np.lexsort((ids[close], -score))[:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[close][best], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def search(queries: DataFrame, vectors: DataFrame, k: int, settings: Settings = Settings()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: ``k`` nearest of each query, all if fewer.

    Both tables have vec_id and embedding; a row is never its own neighbour.  Vectors that
    are NULL, zero, not finite, without vec_id, or of another length than most take no
    part.  A repeated vec_id is kept once, with the first of its vectors in order.
    """
    spark = vectors.sparkSession
    keep = lambda df: df.select(F.col("vec_id").cast("long"), F.col("embedding").alias("vector")).where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    base = keep(vectors)
    sizes = base.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = sizes["d"]
    one = lambda df: df.where(F.size("vector") == d).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    base = stored(one(base), "vectors")
    ids = sampled(base, F.col("vec_id"), share_of(settings.sample, base.count())).toPandas()  # ``sample`` rows
    ids = ids.sort_values("vec_id")
    x = np.stack(ids.vector.to_numpy()).astype(np.float64) if len(ids) else np.zeros((0, d))
    router = fit_router(x, settings) if len(x) > 1 else fit_router(np.ones((1, d)), settings)
    shared = spark.sparkContext.broadcast(router)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                p = shared.value.probabilities(np.stack(b.vector.to_numpy()).astype(np.float64))
                yield b.assign(part=p.argmax(axis=1).astype(np.int32))

    schema = f"vec_id long, vector {base.schema['vector'].dataType.simpleString()}, part int"
    index = stored(base.mapInPandas(assign, schema), "index")
    held = np.zeros(len(router.weights[3]), dtype=np.int64)
    for row in index.groupBy("part").count().collect():  # a row per partition
        held[row["part"]] = row["count"]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                p = shared.value.probabilities(np.stack(b.vector.to_numpy()).astype(np.float64))
                yield b.assign(part=routed(p, settings, held, k + 1)).explode("part").astype({"part": np.int32})

    asked = stored(one(keep(queries)).mapInPandas(route, schema), "routed")
    # A row per partition: how many slices of vectors and blocks of queries it has.
    cells = lambda df, name: df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / settings.cell).cast("int").alias(name))
    grid = stored(cells(index, "slices").join(cells(asked, "blocks"), "part"), "grid")
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(F.broadcast(grid), "part").select("part", every("slices").alias("slice"), spread("blocks").alias("block"), "vec_id", "vector")
    right = index.join(F.broadcast(grid), "part").select("part", spread("slices").alias("slice"), every("blocks").alias("block"), "vec_id", "vector")
    key = ["part", "slice", "block"]

    def best(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        return best_in_cell(q, v, k)

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
