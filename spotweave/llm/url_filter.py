"""URL filter: rules first, then gradient-boosted trees on lexical features.

The trees are trained on labelled URLs, a bounded sample; suffix statistics are
counted over all URLs, one row per suffix, and joined to the rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.session import settle

#: Fixed values: (verdict, rule), a rule being a host and a path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Words of a host that mark a URL as unwanted, for labels where none are given.
UNWANTED = ("ads", "adult", "bet", "bets", "casino", "cheap", "farm", "pills", "poker", "porn", "spam", "track", "win", "xxx")

SAMPLE = 20_000  # labelled URLs the trees are trained on at most
TREES, DEPTH, RATE, BINS = 60, 3, 0.3, 32
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "longest_label", "hyphens", "digit_ratio", "host_digit_ratio",
    "host_entropy", "url_entropy", "parameters", "marks", "suffix_count", "suffix_rate",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null if none does."""
    found = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # longer ones override
        name, start = rule.split("/", 1)
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def weak_label(host: Column) -> Column:
    """1 for a host with an unwanted word between dots and hyphens, else 0; null without a host."""
    unwanted = F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, UNWANTED)))
    return F.when(host != "", unwanted.cast("int"))


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def features(urls: list[str | None], hosts: list[str], paths: list[str], counts: list[int], rates: list[float]) -> np.ndarray:
    """One row of ``FEATURES`` per URL; a null URL counts as empty."""
    rows = np.zeros((len(urls), len(FEATURES)))
    for i, (url, host, path, count, rate) in enumerate(zip(urls, hosts, paths, counts, rates)):
        url = url or ""
        labels = host.split(".")
        query = url.partition("#")[0].partition("?")[2]
        digits = sum(c.isdigit() for c in url)
        rows[i] = (
            len(url), len(host), len(path), path.count("/"), len(labels), max(map(len, labels)), host.count("-"),
            digits / max(1, len(url)), sum(c.isdigit() for c in host) / max(1, len(host)), _entropy(host), _entropy(url),
            len([p for p in query.split("&") if p]), sum(not c.isalnum() for c in url), math.log1p(count), rate,
        )
    return rows


@dataclass
class Trees:
    """Boosted trees as arrays: split feature and value per inner node, a score per leaf."""

    base: float
    feature: np.ndarray
    value: np.ndarray
    leaf: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for feature, value, leaf in zip(self.feature, self.value, self.leaf):
            node = np.zeros(len(x), dtype=int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > value[node])
            z += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-z))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting for the logistic loss on binned features; with one label only, its rate."""
    rate = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    base, inner, leaves = float(np.log(rate / (1 - rate))), 2**DEPTH - 1, 2**DEPTH
    trees = Trees(base, np.zeros((TREES, inner), dtype=int), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves)))
    if not 0 < y.sum() < len(y):
        return trees
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)  # bin b: value <= edges[b]
    z = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-z))
        slope, bend = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), dtype=int)
        for level in range(DEPTH):
            for own in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == own)
                best = _best_split(binned[rows], slope[rows], bend[rows], edges)
                if best:
                    trees.feature[t, own], trees.value[t, own] = best
                right = x[rows, trees.feature[t, own]] > trees.value[t, own]
                node[rows] = 2 * own + 1 + right
        place = node - inner
        gain = np.bincount(place, weights=slope, minlength=leaves) / (np.bincount(place, weights=bend, minlength=leaves) + 1.0)
        trees.leaf[t] = -RATE * gain
        z += trees.leaf[t][place]
    return trees


def _best_split(binned: np.ndarray, slope: np.ndarray, bend: np.ndarray, edges) -> tuple[int, float] | None:
    """The feature and value that lower the loss most, if any does."""
    best, found = 1e-6, None
    total, mass = slope.sum(), bend.sum()
    for f, own in enumerate(edges):
        if not len(own):
            continue
        s = np.cumsum(np.bincount(binned[:, f], weights=slope, minlength=len(own) + 1))[:-1]
        h = np.cumsum(np.bincount(binned[:, f], weights=bend, minlength=len(own) + 1))[:-1]
        gain = s**2 / (h + 1) + (total - s) ** 2 / (mass - h + 1) - total**2 / (mass + 1)
        if len(gain) and gain.max() > best:
            best, found = gain.max(), (f, own[gain.argmax()])
    return found


FOLDS = 5  # parts of the labelled URLs; a part's suffix rates come from the others


def fold_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(url, F.lit(""))), F.lit(FOLDS)).cast("int")


def with_suffix(rows: DataFrame) -> DataFrame:
    """The rows with ``count``, all URLs of the suffix, and ``rate``, its smoothed rate of label 1.

    A labelled row's rate leaves out the labels of its own fold, so that no
    label reaches its own row; without other labels the rate is -1, missing.
    """
    fold = fold_of(F.col("url"))
    parts = rows.groupBy("suffix", fold.alias("fold")).agg(F.count(F.lit(1)).alias("count"), F.count("label").alias("known"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
    by_fold = F.map_from_entries(F.collect_list(F.struct("fold", F.struct("known", "bad"))))  # FOLDS entries
    table = parts.groupBy("suffix").agg(F.sum("count").alias("count"), F.sum("known").alias("known"), F.sum("bad").alias("bad"), by_fold.alias("by_fold"))
    table = settle(table, "suffixes")
    total = table.agg(F.sum("known").alias("known"), F.sum("bad").alias("bad")).first()
    rate = (total["bad"] or 0) / max(1, total["known"] or 0)
    joined = rows.join(table, "suffix")  # a hot suffix has one row there, so its split partitions repeat little
    own = F.when(F.col("label").isNotNull(), F.element_at("by_fold", fold))
    known = F.col("known") - F.coalesce(own["known"], F.lit(0))
    bad = F.col("bad") - F.coalesce(own["bad"], F.lit(0))
    smoothed = F.when(known > 0, (bad + 20 * rate) / (known + 20)).otherwise(-1.0)
    return joined.withColumn("rate", smoothed).drop("known", "bad", "by_fold")


def train(rows: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from rows of ``with_suffix``; at most ``sample`` labelled ones, by hash of the URL, reach the driver."""
    order = [F.xxhash64("url"), "url"]
    some = rows.where("label IS NOT NULL").orderBy(*order).limit(sample).toArrow().to_pylist()
    x = features(*([r[k] for r in some] for k in ("url", "host", "path", "count", "rate")))
    return boost(x, np.array([r["label"] for r in some], dtype=float))


def judge(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", label: Column | None = None, threshold: float = 0.5, rules=RULES
) -> DataFrame:
    """One row per row of ``df``: ``id_col, host, path, rule, verdict, p_block``.

    The longest fitting rule decides; without one, a URL is blocked if the
    trees give it a probability of ``threshold`` or more.  ``label`` is a 0/1
    column of ``df`` (null: not labelled); by default hosts with unwanted words
    are 1.  Null URLs and those without ``://`` have an empty host and path and
    are judged as such.  Other columns are ignored.
    """
    url = F.col(url_col)
    host = host_of(url)
    rows = df.select(F.col(id_col), url.alias("url"), host.alias("host"), path_of(url).alias("path"), (weak_label(host) if label is None else label).alias("label"))
    rows = rows.withColumn("suffix", suffix_of(F.col("host")))
    rows = with_suffix(rows)
    sent = df.sparkSession.sparkContext.broadcast(train(rows))

    @F.pandas_udf("double")
    def blocked(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(sent.value.probability(features(*(c.tolist() for c in part))))

    ruled = rows.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules)).withColumn("p_block", blocked("url", "host", "path", "count", "rate"))
    method = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return ruled.select(
        id_col, "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), method).alias("verdict"), "p_block"
    )
