"""Column functions and the traps of their semantics."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from spotweave.functions import names, vectors as v


def one(spark, expr, **values):
    cols = [F.lit(x).alias(k) for k, x in values.items()]
    return spark.range(1).select(*cols).select(expr.alias("x")).first()["x"]


def test_first_channel_wins_a_tie(spark):
    assert one(spark, v.called_channel(["a", "b", "c", "d"]), a=3, b=7, c=7, d=1) == 2
    assert one(spark, v.called_channel(["a", "b", "c", "d"]), a=0, b=0, c=0, d=0) == 1


def test_undefined_score(spark):
    assert one(spark, v.call_score(["a", "b"]), a=0, b=0) == 0.5
    assert one(spark, v.call_score(["a", "b"], undefined=0.0), a=0, b=0) == 0.0
    assert one(spark, v.call_score(["a", "b"]), a=3, b=4) == pytest.approx(0.8)


@pytest.mark.parametrize("x,want", [(2.5, 2), (3.5, 4), (-1.0, 0), (70000.0, 65535), (0.5, 0)])
def test_sixteen_bits_round_half_to_even(spark, x, want):
    assert one(spark, v.to_uint16("x0"), x0=x) == want


def test_kth_lowest_takes_the_highest_of_a_short_list(spark):
    assert one(spark, v.kth_lowest(F.array(F.lit(0.9), F.lit(0.1)), 3)) == 0.9
    assert one(spark, v.kth_lowest(F.array(*[F.lit(x) for x in (0.9, 0.1, 0.5, 0.7)]), 3)) == 0.7


@pytest.mark.parametrize("a,b,d", [("1234", "1234", 0), ("1234", "1244", 1), ("12", "2234", 1), ("", "11", 0)])
def test_hamming(spark, a, b, d):
    assert one(spark, v.hamming("a", "b"), a=a, b=b) == d
    assert one(spark, v.hamming("b", "a"), a=a, b=b) == d


def usage(s):
    n = len(s)
    return [len({s[k : k + i] for k in range(n - i + 1)}) / min(4**i, n - i + 1) for i in range(1, n + 1)]


@pytest.mark.parametrize("s", ["1", "1111", "1234", "121212121212121", "123412431324134"])
def test_complexity(spark, s):
    assert one(spark, v.complexity_score("s"), s=s) == pytest.approx(math.log10(math.prod(usage(s))))
    assert one(spark, v.complexity_score("s"), s=s) <= 1e-12


@pytest.mark.parametrize("a,b,want", [(0, 0, 1.0), (0, 3, 0.25), (3, 0, 0.25), (2, 3, 0.667), (5, 5, 1.0)])
def test_similarity(spark, a, b, want):
    assert one(spark, v.similarity("a", "b"), a=a, b=b) == want


def test_one_hot(spark):
    code = one(spark, v.one_hot("s", ["G", "T", "A", "C"], 3), s="GCAT")
    assert code == [1, 0, 0, 0, 0, 0, 0, 1, 0, 0, 1, 0]


def test_natural_order(spark):
    tiles = [f"Pos{p}_{c:03d}" for p in (1, 2, 10) for c in (0, 11, 2)]
    df = spark.createDataFrame([(t,) for t in reversed(tiles)], "t string").orderBy(names.natural_key("t"))
    assert [r.t for r in df.collect()] == [f"Pos{p}_{c:03d}" for p in (1, 2, 10) for c in (0, 2, 11)]


def test_first_pattern_wins_and_digits_may_be_two(spark):
    patterns = [r"MAX_(Pos\d+)_", r"(Pos)\d"]
    assert one(spark, names.first_match("s", patterns, 1), s="MAX_Pos12_000_001") == "Pos12"
    assert one(spark, names.first_match("s", patterns, 1), s="Pos3") == "Pos"
    assert one(spark, names.first_match("s", patterns, 1), s="nothing") is None


def test_path_parts(spark):
    path = "hyb/MAX_Pos1_003_000.cp.mask.tif"
    base, label = names.long_label("p")
    long_base, short = names.last_label("p")
    row = spark.createDataFrame([(path,), ("hyb/plain.tif",), ("hyb/bare",)], "p string").select(
        base.alias("base"), label.alias("label"), long_base.alias("lb"), short.alias("sl"), names.extension("p").alias("e")
    ).collect()
    assert tuple(row[0]) == ("MAX_Pos1_003_000", "cp.mask", "MAX_Pos1_003_000.cp", "mask", "tif")
    assert tuple(row[1]) == ("plain", None, "plain", None, "tif")
    assert tuple(row[2]) == ("bare", None, "bare", None, None)


def test_outputs_keep_each_own_extension(spark):
    df = spark.createDataFrame([("a/x.tif",), ("a/y.csv",)], "p string")
    got = [r.o for r in df.select(names.output_path("p", label="n").alias("o")).collect()]
    assert got == ["a/x.n.tif", "a/y.n.csv"]
    merged = [r.o for r in df.select(names.merged_output_path("p", "m", label="all", strip_base=True).alias("o")).collect()]
    assert merged == ["m/all.tif", "m/all.csv"]


def test_all_classes(spark):
    from spotweave.operators.expression import cell_class

    def expected(e, i, t):
        if e < 2 and i < 2 and t < 2:
            return "unassigned", "unassigned"
        if e > 3 and i > 3:
            return "unassigned", "unassigned"
        if e > i:
            return "excitatory", "IT" if t > 1 else "unassigned"
        return ("inhibitory", "unassigned") if i > e else ("unassigned", "unassigned")

    counts = list(itertools.product(range(6), range(6), range(4)))
    df = spark.createDataFrame(counts, "excite_count int, inhib_count int, it_count int")
    kind, sub = cell_class()
    for row in df.select("*", kind.alias("k"), sub.alias("s")).collect():
        assert (row.k, row.s) == expected(row.excite_count, row.inhib_count, row.it_count)
