"""Pixels meet rows per plane or per place of the frame without being sent."""

import pytest

from spotweave.operators import lookup, pixels as px
from spotweave.session import configured


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def frames(spark):
    rows = [(f, t, r, c, 10 * r + c + t) for f in (0, 1, None) for t in (1, 2) for r in range(3) for c in range(4)]
    rows += [(0, 1, 2, 2, 50), (0, 1, None, 2, 5), (1, 2, 1, 1, None)]
    return spark.createDataFrame(rows, "fov int, cycle int, r int, c int, v int")


def flat(spark, pixels):
    profile = [(r, c, 1.0 + r, 0.5 * c) for r in range(3) for c in range(3)] + [(1, 1, 0.0, 2.0), (None, 1, 1.0, 1.0)]
    return px.flat_field(pixels, spark.createDataFrame(profile, "r int, c int, dark double, flat double"), ["v"])


def ranged(spark, pixels):
    return px.normalise_range(pixels, ["v"])


def shifted(spark, pixels):
    shifts = spark.createDataFrame([(0, 1, 1, 0), (0, 1, 0, 1), (1, 2, -1, 2), (None, 1, 0, 0)], "fov int, cycle int, dr int, dc int")
    return px.apply_shift(pixels, shifts, 3, 4)


@pytest.mark.parametrize("step", [flat, ranged, shifted])
def test_pixels_are_never_the_side_that_is_sent(spark, frames, step, monkeypatch):
    few = step(spark, frames.hint("merge"))  # as when the sizes speak against a broadcast
    assert "BuildRight" in planned(few) and "BuildLeft" not in planned(few)
    monkeypatch.setattr(lookup, "SENT", 0)  # as with more planes than may be sent
    with configured(spark, {"spark.sql.autoBroadcastJoinThreshold": "10MB"}):
        many = step(spark, frames)
        assert "ShuffledHashJoin" in planned(many) and "BuildRight" in planned(many) and "Broadcast" not in planned(many)
    got = sorted(map(str, few.collect()))
    assert got == sorted(map(str, many.collect()))
    monkeypatch.setattr(px, "looked_up", lambda df, table, keys: df.join(table, list(keys)))
    assert got and got == sorted(map(str, step(spark, frames).collect()))


def test_a_repeated_or_unknown_key_is_joined_as_such(spark):
    left = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "k int, w string")
    got = lookup.looked_up(left, right, ["k"])
    assert got.columns == ["k", "v", "w"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, "a"), (1, 1, "b"), (1, 2, "a"), (1, 2, "b")]
