"""SimHash near copies, linked by a self-join of the binary trie of fingerprints.

The trie of all distinct fingerprints is joined with itself from the root.  A pair of
nodes carries how many bits its two paths differ in; it is followed into the children
and dropped once the bits exceed the budget.  The upper part of the trie is a table of
nodes and the pairs are expanded by joins; a node of at most ``Settings.leaf``
fingerprints is not opened there, and each surviving pair of such nodes is finished in
one task, on sorted arrays.  Larger nodes are opened further, so a dense region of
fingerprints is spread over more pairs.

A task reports the links it found as a spanning forest: every link keeps its two ends
connected, and the output stays below the number of fingerprints read.  Documents with
equal fingerprints are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored
from .graph import components

STRIDE = 4
SLICE = 1 << 16
FRONTIER = 1 << 17


@dataclass(frozen=True)
class Settings:
    """``leaf``: fingerprints of a trie node that one task may hold; ``budget``: bits."""

    words: int = 3
    budget: int = 2
    leaf: int = 16_384
    seed: int = 42


def fingerprint(text: bytes | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of UTF-8 ``text``, as an unsigned number.

    A-Z in lower case, words between ASCII white space.  A bit is set if it is set in
    over half of the shingles' hashes, repeats included.
    """
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    hashed = xxhash.xxh64_intdigest
    joined = b" ".join(parts)
    if len(parts) <= words:
        return hashed(joined, seed)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    ones, n = np.zeros(64, np.int64), len(parts) - words + 1
    for at in range(0, n, SLICE):
        to = min(n, at + SLICE)
        spans = zip(starts[at:to].tolist(), ends[at + words - 1 : to + words - 1].tolist())
        hashes = np.array([hashed(joined[s:e], seed) for s, e in spans], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, fp)``, fp as a signed long."""
    words, seed = settings.words, settings.seed

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = [fingerprint(t.as_py(), words, seed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array(np.array(found, dtype=np.uint64).view(np.int64))],
                ["doc_id", "fp"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        of, "doc_id long, fp long"
    )


# -- upper part of the trie --------------------------------------------------


def prefix(depth: int) -> Column:
    """The first ``depth`` bits of a fingerprint."""
    return F.shiftrightunsigned("fp", 64 - depth)


def grow(nodes: DataFrame, settings: Settings) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """Put every fingerprint in a trie node of at most ``leaf`` fingerprints.

    Returns the members ``(fp, rep, node, depth)`` and the levels below the root, each
    ``(prefix, open)``; open nodes are those with children on the next level.
    """
    depth, total = STRIDE, nodes.count()
    while total >> depth > settings.leaf:
        depth += STRIDE
    members, levels, active = [], [], nodes
    while True:
        # A level of one count per node; the counts are far fewer than fingerprints.
        counts = active.groupBy(prefix(depth).alias("prefix")).count()
        level = stored(
            counts.select("prefix", ((F.col("count") > settings.leaf) & F.lit(depth < 64)).alias("open")),
            "trie",
        )
        levels.append((depth, level))
        placed = active.withColumn("prefix", prefix(depth)).join(level, "prefix")
        members.append(
            placed.where(~F.col("open"))
            .select("fp", "rep", F.col("prefix").alias("node"), F.lit(depth).alias("depth"))
        )
        if not level.where("open").take(1):
            break
        active = stored(placed.where("open").select("fp", "rep"), "open")
        depth += STRIDE
    first, base = levels[0]
    above = []
    for d in range(first - STRIDE, 0, -STRIDE):
        base = base.select(F.shiftrightunsigned("prefix", STRIDE).alias("prefix")).distinct()
        above.append((d, base.withColumn("open", F.lit(True))))
    return _union(members), above[::-1] + levels


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out


def node_pairs(spark, levels: list[tuple[int, DataFrame]], budget: int) -> DataFrame:
    """Pairs of closed nodes whose paths differ in at most ``budget`` bits.

    Columns a, a_depth, b, b_depth, bits.  Both nodes are followed down together; a
    closed node waits while its partner is opened.
    """
    pairs = spark.range(1).selectExpr(
        "0L AS a", "0 AS a_depth", "true AS a_open", "0L AS b", "0 AS b_depth",
        "true AS b_open", "0 AS bits",
    )  # the root with itself
    done = []
    for depth, level in levels:
        for side in "ab":
            kids = level.select(
                F.shiftrightunsigned("prefix", STRIDE).alias("up"),
                F.col("prefix").alias("kid"), F.col("open").alias("kid_open"),
            )
            opened = pairs.join(
                kids, (F.col(side) == F.col("up")) & F.col(f"{side}_open"), "left"
            )
            pairs = opened.withColumns({
                f"{side}_at": F.coalesce("kid", side),
                f"{side}_to": F.when(F.col("kid").isNotNull(), F.lit(depth)).otherwise(F.col(f"{side}_depth")),
                f"{side}_on": F.coalesce("kid_open", F.lit(False)),
            }).drop("up", "kid", "kid_open")
        both = (F.col("a_to") == depth) & (F.col("b_to") == depth)
        differing = F.bit_count(F.col("a_at").bitwiseXOR(F.col("b_at")).bitwiseAND((1 << STRIDE) - 1))
        pairs = pairs.withColumn("bits", F.col("bits") + F.when(both, differing).otherwise(0)).where(
            (F.col("bits") <= budget)
            & (~((F.col("a") == F.col("b")) & (F.col("a_depth") == F.col("b_depth")))
               | (F.col("a_at") <= F.col("b_at")))
        ).selectExpr(
            "a_at AS a", "a_to AS a_depth", "a_on AS a_open",
            "b_at AS b", "b_to AS b_depth", "b_on AS b_open", "bits",
        )
        done.append(pairs.where("NOT a_open AND NOT b_open"))
        pairs = pairs.where("a_open OR b_open")
    return _union(done).drop("a_open", "b_open")


# -- lower part, in one task per pair of nodes -------------------------------


def links(left: np.ndarray, right: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) with at most ``budget`` differing bits; both arrays sorted.

    Walks the two tries together from the first bit, pairs of nodes as ranges of the
    arrays.  If both arrays are the same one, each link is found once (i < j).
    """
    same = left is right
    stack = [(0, *(np.array([x]) for x in (0, len(left), 0, len(right), 0)))]
    zeros: dict[tuple[int, int], np.ndarray] = {}

    def before(side: int, data: np.ndarray, bit: int) -> np.ndarray:
        if (side, bit) not in zeros:
            unset = (data >> np.uint64(63 - bit)) & np.uint64(1) == 0
            zeros[side, bit] = np.concatenate([[0], np.cumsum(unset)])
        return zeros[side, bit]

    while stack:
        bit, al, ah, bl, bh, d = stack.pop()
        if len(al) > FRONTIER:
            for at in range(0, len(al), FRONTIER):
                cut = slice(at, at + FRONTIER)
                stack.append((bit, al[cut], ah[cut], bl[cut], bh[cut], d[cut]))
            continue
        single = (ah - al == 1) & (bh - bl == 1)
        if single.any() or bit == 64:
            i, j = al[single], bl[single]
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            if same:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            al, ah, bl, bh, d = (x[~single] for x in (al, ah, bl, bh, d))
            if not len(al):
                continue
        za, zb = before(0, left, bit), before(0 if same else 1, right, bit)
        am, bm = al + za[ah] - za[al], bl + zb[bh] - zb[bl]
        twin = (al == bl) & (ah == bh) if same else np.zeros(len(al), bool)
        parts = (
            (al, am, bl, bm, d, None), (am, ah, bm, bh, d, None),
            (al, am, bm, bh, d + 1, None), (am, ah, bl, bm, d + 1, ~twin),
        )
        kept = []
        for p0, p1, q0, q1, bits, also in parts:
            ok = (p1 > p0) & (q1 > q0) & (bits <= budget)
            if also is not None:
                ok &= also
            kept.append([x[ok] for x in (p0, p1, q0, q1, bits)])
        following = [np.concatenate(x) for x in zip(*kept)]
        if len(following[0]):
            stack.append((bit + 1, *following))


def forest(ids: np.ndarray, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links between positions as (id, smallest id of its tree); ``ids`` ascending."""
    label = np.arange(len(ids))
    for i, j in found:
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := label[label], label):
                label = up
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


def trie_links(nodes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Spanning links (a > b) between the ``rep`` of near fingerprints.

    ``nodes``: distinct ``fp`` with a unique ``rep`` each.
    """
    members, levels = grow(nodes, settings)
    pairs = node_pairs(nodes.sparkSession, levels, settings.budget)
    pairs = stored(pairs, "node-pairs")
    at = {s: members.withColumnsRenamed({"node": s, "depth": f"{s}_depth"}) for s in "ab"}
    key = ["a", "a_depth", "b", "b_depth"]
    other = ~((F.col("a") == F.col("b")) & (F.col("a_depth") == F.col("b_depth")))
    laid = pairs.join(at["a"], ["a", "a_depth"]).select(*key, F.lit(0).alias("side"), "fp", "rep")
    laid = laid.unionAll(
        pairs.where(other).join(at["b"], ["b", "b_depth"]).select(*key, F.lit(1).alias("side"), "fp", "rep")
    )
    budget = settings.budget

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep")
        ids = group.rep.to_numpy()
        fps = group.fp.to_numpy().view(np.uint64)
        side = group.side.to_numpy()
        parts = []
        for s in (0, 1):
            own = np.flatnonzero(side == s)
            own = own[np.argsort(fps[own], kind="stable")]
            parts.append((own, fps[own]))
        (ia, fa), (ib, fb) = parts
        if not len(ib):
            ib, fb = ia, fa
        a, b = forest(ids, ((ia[i], ib[j]) for i, j in links(fa, fb, budget)))
        return pd.DataFrame({"a": a, "b": b})

    return laid.groupBy(*key).applyInPandas(finish, "a long, b long")


def near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per document, whole corpus.

    component_id is the smallest doc_id reachable over links of at most
    ``settings.budget`` differing bits, the document included.  A NULL, empty or blank
    text has fingerprint zero and is linked like any other.  A document without doc_id
    has its fingerprint and component_id NULL; it links nothing.  Repeated rows come
    back as often.
    """
    prints = stored(fingerprints(docs, settings), "fingerprints")
    nodes = stored(
        prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")),
        "nodes",
    )
    roots = components(trie_links(nodes, settings))
    named = nodes.join(roots, nodes.rep == roots.node, "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")
    )
    return prints.join(named, "fp", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The row with the smallest doc_id of each component, all columns of ``docs``.

    A repeated row is one document and stays once.  Rows that share a doc_id but not the
    text are parts of one document: if the doc_id is the smallest of a component that one
    of its texts is in, each of its different texts stays once.  Rows without doc_id can be
    told neither from copies nor from each other and all stay.
    """
    found = near_copies(docs.select("doc_id", "text"), settings).where("doc_id = component_id")
    kept_id = free_name(docs, "kept_id")
    kept = stored(found.select(F.col("doc_id").alias(kept_id)).distinct(), "kept")
    first = docs.join(kept, F.col("doc_id") == F.col(kept_id), "left_semi").dropDuplicates(["doc_id", "text"])
    return first.unionByName(docs.where("doc_id IS NULL"))
