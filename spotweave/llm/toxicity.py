"""Toxic documents by a chain of linear classifiers.

The categories stand in an order.  Each has a logistic regression on the words
present in a text and on the probabilities of the categories before it.  In
training these are out-of-fold predictions, so that a later model sees them as
unsure as they will be for new texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spotweave.llm import wordbytes

SAMPLE = 20_000  # labelled rows a model is trained on at most, taken by hash
FOLDS = 5
KEPT = 300  # words a category's model looks at
LEAST = 3  # texts a word must occur in
BEYOND_CHANCE = 20.0  # chi-squared a word must reach; chance gives it to about one word in 100,000
BANDS, ROWS = 4, 6  # labelled texts that agree in a band of minimum hashes count once
AT_ONCE = 1024  # rows multiplied at once in a Newton step
THRESHOLD = 0.35  # probability from which a document counts as toxic
CATEGORIES = ("quality", "toxic")
_SALTS = np.random.default_rng(3).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)


@dataclass
class Link:
    """One category's model: intercept, weights of its words, weights of the categories before it."""

    intercept: float
    words: np.ndarray
    weights: np.ndarray
    before: np.ndarray


@dataclass
class Chain:
    categories: tuple[str, ...]
    links: list[Link] = field(default_factory=list)


def word_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Per slice of rows: (row, feature) of the distinct words of whole texts, first row, number of rows.

    Words are lower-cased runs of letters and digits; a feature is a word's whole 64-bit fingerprint.
    """
    for first, data, ends in wordbytes.slices(texts):
        hashed, stops = wordbytes.words(data, ends, wordbytes.MARKS)
        rows = np.repeat(np.arange(len(ends)), np.diff(stops, prepend=0))
        features = hashed.view(np.int64)
        order = np.lexsort((features, rows))
        rows, features = rows[order], features[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (features[1:] != features[:-1])
        yield rows[new], features[new], first, len(ends)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.drop_columns(["text"])
        for rows, features, first, n in word_features(batch.column("text")):
            offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(features))
            bands = [_bands(features[a:b]) for a, b in zip(offsets, offsets[1:])]
            part = labels.slice(first, n)
            columns = [*part.columns, lists, pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "features", "bands"])


def _bands(features: np.ndarray) -> np.ndarray:
    """One key per band of minimum hashes of a set of words."""
    if not len(features):
        return np.zeros(0, dtype=np.int64)
    lows = wordbytes.mix(features.view(np.uint64)[:, None] ^ _SALTS).min(axis=0).reshape(BANDS, ROWS)
    return wordbytes.mix(lows @ _SALTS[:ROWS] + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _one_of_copies(table):
    """Rows that share no band with an earlier row, so that a copied text does not speak for its words many times."""
    seen, keep = set(), []
    for bands in table["bands"]:
        own = set(bands.tolist())
        keep.append(not own & seen)
        seen |= own
    return table[np.array(keep, dtype=bool)].reset_index(drop=True)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _dense(rows: np.ndarray, features: np.ndarray, kept: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A column of ones, a 0/1 column per kept feature, and the columns of the categories before."""
    at = np.searchsorted(kept, features)
    hit = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == features) if len(kept) else np.zeros(len(features), bool)
    out = np.zeros((len(before), 1 + len(kept) + before.shape[1]))
    out[:, 0] = 1
    out[rows[hit], 1 + at[hit]] = 1
    out[:, 1 + len(kept) :] = before
    return out


def _telling(rows: np.ndarray, features: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The words whose presence tells most about ``y`` (chi-squared), in order of feature."""
    n, positive = len(y), y.sum()
    seen = np.bincount(features).astype(float)
    both = np.bincount(features, weights=y[rows])
    expected = seen * positive / n
    spread = expected * (1 - positive / n) * (1 - seen / n)
    score = np.where((seen >= LEAST) & (spread > 0), (both - expected) ** 2 / np.maximum(spread, 1e-12), 0)
    best = np.argsort(-score, kind="stable")[:KEPT]
    return np.sort(best[score[best] > BEYOND_CHANCE])


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 25) -> np.ndarray:
    """Intercept and weights of a logistic regression by Newton steps; the intercept is not penalised.

    The first column of ``x`` is all ones.  Products are added up over a few
    rows at a time, so that no second matrix of that size is held.
    """
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    w = np.zeros(x.shape[1])
    rate = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    w[0] = np.log(rate / (1 - rate))
    for _ in range(steps):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        bend, spread = np.diag(ridge), p * (1 - p)
        for at in range(0, len(x), AT_ONCE):
            part = x[at : at + AT_ONCE]
            bend += (part * spread[at : at + AT_ONCE, None]).T @ part
        move = np.linalg.solve(bend, slope)
        w -= np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-6:
            break
    return w


def _link(rows, features, before: np.ndarray, y: np.ndarray) -> Link:
    kept = _telling(rows, features, y)
    w = _fit(_dense(rows, features, kept, before), y)
    return Link(w[0], kept, w[1 : 1 + len(kept)], w[1 + len(kept) :])


def _probability(link: Link, rows, features, before: np.ndarray, n: int) -> np.ndarray:
    z = np.full(n, link.intercept) + before @ link.before if len(link.before) else np.full(n, link.intercept)
    if len(link.words):
        at = np.minimum(np.searchsorted(link.words, features), len(link.words) - 1)
        z += np.bincount(rows, weights=np.where(link.words[at] == features, link.weights[at], 0), minlength=n)
    return _sigmoid(z)


def train(labelled: DataFrame, categories: Sequence[str] = CATEGORIES, sample: int = SAMPLE) -> Chain:
    """Fit the chain on rows ``id, text`` with a 0/1 column per category.

    Rows with a null label or text are left out; exact and near copies of a
    text count once.  At most ``sample`` rows reach the driver, as lists of hashed words.  A
    category with one label only is its rate.
    """
    known = labelled.dropna(subset=["text", *categories]).withColumn("_hash", F.xxhash64("text"))
    picked = known.select("text", "_hash", *[F.col(c).cast("double").alias(c) for c in categories])
    schema = "_hash long, " + ", ".join(f"`{c}` double" for c in categories) + ", features array<long>, bands array<long>"
    table = picked.mapInArrow(_listed, schema).limit(sample).toArrow().to_pandas()
    table = table.sort_values(["_hash", *categories]).drop_duplicates("_hash")
    return fit_chain(_one_of_copies(table), categories)


def numbered(lists) -> tuple[np.ndarray, list[np.ndarray]]:
    """The words in ``LEAST`` texts or more, in order, and each list as its words' numbers; no model looks at others."""
    known, seen = np.unique(np.concatenate([np.zeros(0, np.int64), *lists]), return_counts=True)
    known = known[seen >= LEAST]
    out = []
    for words in lists:
        at = np.searchsorted(known, words).astype(np.int32)
        held = at < len(known)
        held[held] = known[at[held]] == np.asarray(words)[held]
        out.append(at[held])
    return known, out


def fit_chain(table, categories: Sequence[str]) -> Chain:
    """The chain from a table of 0/1 categories and lists of features."""
    n = len(table)
    known, features = numbered(table["features"])
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in features])
    features = np.concatenate([np.zeros(0, np.int32), *features])
    fold = np.arange(n) % FOLDS
    chain, before = Chain(tuple(categories)), np.zeros((n, 0))
    for category in categories:
        y = table[category].to_numpy(dtype=float)
        if not 0 < y.sum() < n:
            rate = np.clip(y.mean() if n else 0.0, 1e-4, 1 - 1e-4)
            chain.links.append(Link(np.log(rate / (1 - rate)), np.zeros(0, np.int64), np.zeros(0), np.zeros(before.shape[1])))
            before = np.hstack([before, np.full((n, 1), rate)])
            continue
        out = np.zeros(n)
        for k in range(FOLDS):
            inside, outside = fold != k, fold == k
            place = np.cumsum(inside, dtype=np.int32) - 1
            own = inside[rows]
            part = _link(place[rows[own]], features[own], before[inside], y[inside]) if inside.any() else None
            if part is not None and outside.any():
                place = np.cumsum(outside, dtype=np.int32) - 1
                rest = outside[rows]
                out[outside] = _probability(part, place[rows[rest]], features[rest], before[outside], int(outside.sum()))
        link = _link(rows, features, before, y)
        link.words = known[link.words]  # in order, as the numbers are
        chain.links.append(link)
        before = np.hstack([before, out[:, None]])
    return chain


def probabilities(chain: Chain, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
    """One column per category; each feeds the next ones."""
    before = np.zeros((n, 0))
    for link in chain.links:
        before = np.hstack([before, _probability(link, rows, features, before, n)[:, None]])
    return before


def score(df: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``df``) and ``p``, a struct of one probability per category, from whole texts.

    A null text counts as empty.
    """
    sent = df.sparkSession.sparkContext.broadcast(chain)  # a few hundred weights per category

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, features, first, n in word_features(batch.column(0).field(text_col)):
                found = probabilities(sent.value, rows, features, n)
                columns = [pa.array(np.ascontiguousarray(c)) for c in found.T]
                scores = pa.StructArray.from_arrays(columns, list(sent.value.categories))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), scores], ["row", "p"])

    rows = df.select(F.struct("*").alias("row"))
    kinds = T.StructType([T.StructField(c, T.DoubleType()) for c in chain.categories])
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("p", kinds)]))


def labelled_texts(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES, sample: int = SAMPLE) -> DataFrame:
    """Rows ``id, text`` and categories for at most ``sample`` labelled documents, chosen by hash of the id."""
    some = labels.select(F.col("doc_id").alias("id"), *categories).dropna()
    # A bounded sample, so it may be broadcast and the texts need not move.
    some = some.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    return texts.join(F.broadcast(some), "id")


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, p_quality, p_toxic, toxic``; a null text counts as empty."""
    chain = train(labelled_texts(docs, labels))
    scored = score(docs.select("doc_id", "text"), chain)
    found = [F.col(f"p.{c}").alias(f"p_{c}") for c in chain.categories]
    return scored.select("row.doc_id", *found, (F.col("p.toxic") >= threshold).alias("toxic"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not toxic, with their columns."""
    chain = train(labelled_texts(docs, labels))
    return score(docs, chain).where(F.col("p.toxic") < threshold).select("row.*")
