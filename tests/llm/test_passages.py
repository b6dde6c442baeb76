"""Phrases, hard negatives and repeated passages against plain Python, with the odd cases."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spotweave.llm import hard_negatives, phrases, suffixes, wordbytes

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, slice long, ends string, data string, page string, range int, n long, a long"
VECTORS = "vec_id long, embedding array<float>, label int, id long, vector string, cell int, rank int, score long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x", "y", "z", 2, 3, 4) for i, t, lang in rows], DOCS).repartition(3)


def listed(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.toArrow().to_pylist()), key=str)


def phrase_rows(rows, least, inside, top):
    counts, words = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            words[lang or "und"] += len(w)
            for m in (1, 2, 3):
                counts[lang or "und"].update(" ".join(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        for phrase, a in f.items():
            w = phrase.split(" ")
            if a < least or len(w) < 2:
                continue
            cuts = [(1_000_000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            longer = [n for other, n in f.items() if n >= least and len(other.split(" ")) > len(w) and f" {phrase} " in f" {other} "]
            if not any(100 * n >= inside * a for n in longer):
                kept.append((-score, -a, phrase.encode(), phrase, f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase, -a, left, right, words[lang], -score))
    return sorted(out, key=str)


PHRASE = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def test_collocations(spark):
    rng = np.random.default_rng(3)
    rows = [(None, None, None), (1, "", "en"), (2, " \t\n.,", "en"), (2, " \t\n.,", "en")]
    for i in range(60):
        words = rng.choice(["New", "york", "city", "é", "x\x0by", "Tree\tHouse", "a.b", "go", "  go", "ÉA"], 40)
        rows.append((i if i % 7 else None, " ".join(words), ["en", "de", None][i % 3]))
    rows.append((99, "new york city " * 4000, "en"))
    for top in (2000, 3):
        found = phrases.collocations(documents(spark, rows), least=4, top=top)
        assert listed(found, *PHRASE) == phrase_rows(rows, 4, 50, top)
    assert phrases.collocations(documents(spark, [])).count() == 0


def test_colliding_fingerprints_are_parted_by_text(spark, monkeypatch):
    rows = [(i, "one two three one two", "en") for i in range(12)]
    data = np.frombuffer(b"one two one six", np.uint8)
    begin, end = wordbytes.bounds(data, np.array([len(data)]))
    same = phrases.word_numbers(data, begin, end, np.zeros(4, np.uint64))
    assert same[0] == same[2] and len(set(same.tolist())) == 3
    whole = phrase_rows(rows, 10, 50, 2000)
    assert listed(phrases.collocations(documents(spark, rows)), *PHRASE) == whole


def negative_rows(rows, every, positives=5, negatives=3):
    valid = [(i, label, np.floor(256 * np.array(v, dtype=np.float32).astype(float))) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(v) for *_, v in valid), default=0)
    valid = [(i, label, np.pad(v, (0, width - len(v)))) for i, label, v in valid]
    out, asked = [], {}
    for i, label, v in valid:
        if i % every == 0:
            asked[i] = min(asked.get(i, ((np.inf,),)), (tuple(v), label)) if i in asked else (tuple(v), label)
    for i, (v, label) in asked.items():
        scored = sorted((-int(np.dot(v, w)), j, other) for j, other, w in valid if j != i)
        for ps, j in [(-s, j) for s, j, other in scored if other == label][:positives]:
            near = [(-s, k) for s, k, other in scored if other != label and 50 * ps <= -100 * s <= 95 * ps][:negatives]
            out += [(i, j, rank, k, ps, ns) for rank, (ns, k) in enumerate(near, 1)]
    return sorted(out, key=str)


NEGATIVE = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("sizes", [{}, {"LEAF": 4, "SPLITS": 5, "SAMPLE": 9, "ANCHORS": 20}])
def test_hard_negatives(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.4 * rng.normal(size=12)).tolist(), int(rng.integers(3))) for i in range(500)]
    rows += [(600 + i, rows[5][1], i % 3) for i in range(200)]  # the same vector again and again
    rows += [(900, None, 1), (905, [1.0, None], 1), (910, [float("nan")], 1), (915, [1.0], None), (None, [1.0], 1), (920, [], 1), (925, [2.0, 1.0], 2)]
    rows += [rows[10], (10, rows[11][1], 2), rows[7]]
    table = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], VECTORS).repartition(3)
    found = hard_negatives.hard_negatives(table.where("vec_id % 5 = 0"), table)
    assert listed(found, *NEGATIVE) == negative_rows(rows, 5)


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(none, none).count() == 0


def test_siblings_are_only_eliminated_without_candidates():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(size=(400, 6)) * 50)
    anchors = np.floor(rng.normal(size=(30, 6)) * 50)
    space = hard_negatives.Space(float((points**2).sum(axis=1).max()))
    splits = hard_negatives.spread(points, 8, space)
    gaps, to_splits = space.between(points, points[splits]), space.to(anchors, points[splits])
    true = space.to(anchors, points)
    near, far = np.quantile(true, 0.01, axis=1), np.quantile(true, 0.03, axis=1)
    cut = 0
    for j in range(8):
        own = gaps.argmin(axis=1) == j
        alive = hard_negatives.survives(near, far, to_splits, gaps[own].min(axis=0), gaps[own].max(axis=0), gaps[splits[j]], j, space)
        holds = ((true[:, own] >= near[:, None]) & (true[:, own] <= far[:, None])).any(axis=1)
        assert not (holds & ~alive).any()
        cut += (~alive).sum()
    assert cut > 0


def repeat_rows(rows, length=50):
    first, last = {}, suffixes.NO_ID
    for i, text, _ in rows:
        b, k = (text or "").encode(), last if i is None else i
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(first.get(b[p : p + length], k), k)
    out = []
    for i, text, _ in rows:
        b, k = (text or "").encode(), last if i is None else i
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < k:
                gone[p : p + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(np.diff(gone.astype(int), prepend=0).clip(0).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


REPEAT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("sizes", [{}, {"RANGE": 40, "SLICE": 3000, "PAGE": 5000}])
@pytest.mark.parametrize("hot", [suffixes.HOT, 2])
def test_without_repeats(spark, monkeypatch, sizes, hot):
    for name, value in sizes.items():
        monkeypatch.setattr(suffixes, name, value)
    rng = np.random.default_rng(4)
    letters = list("abcdefgh é\n")
    draw = lambda n: "".join(rng.choice(letters, n))
    passages = [draw(n) for n in (49, 50, 51, 70, 300)]
    rows = [(None, None, None), (7, "", "en"), (8, "a" * 400, "en"), (9, "b" + "a" * 70, "en"), (10, "\0" * 90, "en"), (11, "x" + "\0" * 60, "en")]
    for i in range(60):
        parts = [draw(int(rng.integers(0, 60))) for _ in range(4)]
        for p in rng.integers(0, 5, 3):
            parts.insert(int(rng.integers(len(parts))), passages[p])
        rows.append((int(rng.integers(12, 60)) if i % 9 else None, "".join(parts), "en"))
    rows += [rows[20], (200, rows[20][1], "en"), (-5, rows[21][1], "en"), (300, passages[4][10:80] + draw(9000) + passages[3], "en")]
    rows += [(400 + i, rows[30][1], "en") for i in range(40)]
    found = suffixes.without_repeats(documents(spark, rows), hot=hot)
    assert listed(found, *REPEAT) == repeat_rows(rows)


def test_without_repeats_of_nothing_and_kept_text(spark):
    assert suffixes.without_repeats(documents(spark, [])).count() == 0
    rows = [(1, "start " + "0123456789" * 6, None), (2, "other " + "0123456789" * 6 + " end", None)]
    kept = dict(listed(suffixes.without_repeats(documents(spark, rows), texts=True), "doc_id", "kept"))
    assert kept == {1: rows[0][1].encode(), 2: b"other end"}


def test_merge_compares_only_what_is_not_known():
    rng = np.random.default_rng(2)
    runs = [sorted(rng.choice([b"aaaa", b"aaab", b"aaba", b"abbb", b"baaa", b"bbbb"], n).tolist()) for n in (5, 1, 9, 30)]
    coded = []
    for keys in runs:
        shared, tails = suffixes.front_coded(np.array([list(k) for k in keys], dtype=np.uint8), np.array([0]))
        assert suffixes.decoded(shared, tails.tobytes(), 4) == keys
        coded.append((keys, shared.tolist()))
    origin, shared = suffixes.merge(coded, 4)
    heads = [iter(k) for k in runs]
    out = [next(heads[r]) for r in origin]
    assert out == sorted(k for keys in runs for k in keys)
    for a, b, n in zip(out, out[1:], shared[1:]):
        assert a[:n] == b[:n] and (n == 4 or a[n] != b[n])
