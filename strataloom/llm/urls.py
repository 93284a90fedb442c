"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host with its subdomains and a start of the path; the longest rule that
fits decides.  The URLs that rules decide are the labelled URLs: trees learn from their
length, depth, digit ratio, entropy, number of parameters and suffix statistics, and judge
the URLs no rule fits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled, share_of, stored

ALLOW, BLOCK = "allow", "block"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled URLs to fit on, on average; ``buckets``: hashed suffixes;
    ``folds``: parts of the URLs, each described by the labels of the other parts."""

    sample: int = 20_000
    buckets: int = 4_096
    trees: int = 20
    depth: int = 4
    prior: float = 4.0
    folds: int = 5


def parts_of(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z in lower case), path, and what follows the first ``?`` up to ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path, F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]], value) -> Column:
    """``value(verdict, rule)`` of the longest fitting rule, else NULL."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        out = F.when(fits, F.lit(value(verdict, rule))).otherwise(out)
    return out


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def lexical(url: Column, host: Column, path: Column, query: Column) -> dict[str, Column]:
    n = F.length(url)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / n
    entropy = F.aggregate(
        F.array_distinct(F.split(url, "")), F.lit(0.0), lambda a, c: a - F.when(c != "", share(c) * F.log2(share(c))).otherwise(0.0)
    )
    count = lambda text, mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    return {
        "f_length": n, "f_host": F.length(host), "f_path": F.length(path),
        "f_depth": count(path, "/"), "f_labels": count(host, "."), "f_hyphens": count(host, "-"),
        "f_digits": ratio(digits, n), "f_entropy": entropy,
        "f_params": F.when(F.length(query) > 0, count(query, "&") + 1).otherwise(F.lit(0)),
    }


def suffix_statistics(seen: DataFrame, suffix: str, base: float, settings: Settings) -> DataFrame:
    """``suffix, fold`` with the pages of a suffix and its smoothed share of blocked ones.

    A labelled URL belongs to a fold by its hash and is described by the labels of the other
    folds, so neither its own label nor that of a copy is in its features; fold -1, that of
    the URLs to judge, sees all labels.  At most buckets times (folds + 1) rows; pages are
    counted before they are shuffled.
    """
    blocked = (F.col("said") == BLOCK).cast("double")
    counted = stored(
        seen.groupBy(suffix, "fold").agg(
            F.count(F.lit(1)).alias("pages"),
            F.coalesce(F.sum(blocked), F.lit(0.0)).alias("b"), F.count("said").alias("n"),
        ),
        "suffixes",
    )
    whole = counted.groupBy(suffix).agg(
        F.sum("pages").alias("pages"), F.sum("b").alias("all_b"), F.sum("n").alias("all_n")
    )
    # What a fold must not see: its own labels, nothing for the URLs to judge.
    own = counted.select(suffix, "fold", F.when(F.col("fold") >= 0, F.col("b")).otherwise(0.0).alias("b"),
                         F.when(F.col("fold") >= 0, F.col("n")).otherwise(0).alias("n"))
    share = (F.col("all_b") - F.col("b") + settings.prior * base) / (F.col("all_n") - F.col("n") + settings.prior)
    return own.join(whole, suffix).select(
        suffix, "fold", F.log1p("pages").alias(f"f_{suffix}_pages"), share.alias(f"f_{suffix}_blocked")
    )


def judge(pages: DataFrame, rules: list[tuple[str, str]], settings: Settings = Settings()) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page.

    A NULL url or one without ``://`` has empty host and path, fits no rule and is judged
    by the trees on what there is.  Repeated and NULL page_ids are judged each.  Where the
    rules decide no URL, or all alike, the trees say ``allow``, or what the rules say.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    url = F.coalesce("url", F.lit(""))
    host, path, query = parts_of(F.col("url"))
    labels = F.slice(F.reverse(F.split("host", r"\.")), 1, 2)
    seen = pages.select(
        "page_id", url.alias("url"), host.alias("host"), path.alias("path"), query.alias("query")
    ).select(
        "*",
        longest_rule(F.col("host"), F.col("path"), rules, lambda v, r: r).alias("rule"),
        longest_rule(F.col("host"), F.col("path"), rules, lambda v, r: v).alias("said"),
        F.pmod(F.xxhash64(F.element_at(labels, 1)), F.lit(settings.buckets)).alias("s1"),
        F.pmod(F.xxhash64(F.array_join(labels, ".")), F.lit(settings.buckets)).alias("s2"),
    )
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("url")), F.lit(settings.folds)).cast("int")
    seen = seen.withColumn("fold", F.when(F.col("said").isNull(), F.lit(-1)).otherwise(fold))
    blocked = (F.col("said") == BLOCK).cast("double")
    totals = seen.where("said IS NOT NULL").agg(
        F.count(F.lit(1)).alias("n"), F.sum(blocked).alias("b")
    ).first()
    n, b = totals["n"], totals["b"] or 0.0
    if not 0 < b < n:
        only = F.lit(BLOCK if n and b == n else ALLOW)
        return seen.select("page_id", "host", "path", "rule", F.coalesce("said", only).alias("verdict"))
    features = seen.select("page_id", "host", "path", "rule", "said", "url", "s1", "s2", "fold",
        *(c.cast("double").alias(k) for k, c in lexical(F.col("url"), F.col("host"), F.col("path"), F.col("query")).items()))
    names = [c for c in features.columns if c.startswith("f_")]
    for s in ("s1", "s2"):
        stats = stored(suffix_statistics(seen, s, b / n, settings), "suffix-statistics")
        features = features.join(F.broadcast(stats), [s, "fold"])
        names += [f"f_{s}_pages", f"f_{s}_blocked"]
    vector = VectorAssembler(inputCols=names, outputCol="features")
    # A repeated row is drawn once, so the sample keeps its bound.
    known = sampled(
        features.where("said IS NOT NULL"), F.struct("page_id", "url"), share_of(settings.sample, n)
    ).dropDuplicates(["page_id", "url"]).select(*names, blocked.alias("label"))
    known = stored(known.coalesce(8), "labelled-urls")
    if known.agg(F.countDistinct("label")).first()[0] < 2:
        return features.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit(BLOCK if b > n / 2 else ALLOW)).alias("verdict"))
    model = GBTClassifier(maxIter=settings.trees, maxDepth=settings.depth, seed=7).fit(vector.transform(known))
    judged = model.transform(vector.transform(features))
    learned = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", learned).alias("verdict"))
