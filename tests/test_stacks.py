"""Blocks handled many at a time against the same images one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.operators import blocks, brightness, registration


def images(spark, frames, nulls=()):
    """``frames`` by (fov, cycle) as rows; pixels at ``nulls`` are null."""
    rows = [(*key, r, c, None if (*key, r, c) in nulls else float(v)) for key, frame in frames.items() for (r, c), v in np.ndenumerate(frame)]
    return spark.createDataFrame(rows, "fov int, cycle int, r int, c int, v double")


def counted(spark, monkeypatch, module, name):
    calls, plain = spark.sparkContext.accumulator(0), getattr(module, name)

    def noted(*args):
        calls.add(1)
        return plain(*args)

    monkeypatch.setattr(module, name, noted)
    return calls


@pytest.mark.parametrize("rows", [40, 1 << 16])
def test_small_blocks_are_sharpened_many_at_a_time(spark, monkeypatch, rows):
    rng = np.random.default_rng(3)
    frames = {(f if f else None, t): rng.random((9, 7)) for f in range(20) for t in (1, 2)}
    monkeypatch.setattr(blocks, "STACK_ROWS", rows)
    df = images(spark, frames, {(3, 1, 4, 4), (3, 2, 0, 0)}).repartition(2)
    calls = counted(spark, monkeypatch, brightness, "gauss_weights")
    sharp = lambda block: {tuple(x[:4]): x.v for x in brightness.difference_of_gaussians(df, 0.5, 1.0, block=block, reach=2).collect()}
    got = sharp(4)
    if rows > 40:
        assert 0 < calls.value < 40  # 240 blocks, two calls each
    want = sharp(16)  # a frame is a block
    assert got.keys() == want.keys() and len(got) == 20 * 2 * 63 - 2
    assert np.allclose([got[k] for k in want], list(want.values()), atol=1e-12)


@pytest.mark.parametrize("rows", [40, 1 << 16])
def test_small_blocks_vote_many_at_a_time(spark, monkeypatch, rows):
    rng = np.random.default_rng(4)
    still = {(f, 1): rng.integers(0, 9, (9, 7)) for f in range(1, 15)}
    moving = {(f, t): rng.integers(0, 9, (9, 7)) for f in (*range(3, 20), None) for t in (2, 3)}
    monkeypatch.setattr(blocks, "STACK_ROWS", rows)
    calls = counted(spark, monkeypatch, registration, "shifted_products")
    template = images(spark, still).drop("cycle").unionByName(spark.createDataFrame([(None, 1, 1, 5.0)], "fov int, r int, c int, v double"))
    null = (5, 3, 4, 3)
    found = registration.vote_arrays(template, images(spark, moving, {null}), 2, block=4)
    got = {(x.fov, x.cycle): np.reshape(x.votes, (5, 5)) for x in found.collect()}
    if rows > 40:
        assert 0 < calls.value < 40  # 600 blocks
    assert got.keys() == moving.keys() and np.isnan(got.pop(null[:2])).all()
    for key, votes in got.items():
        fixed = np.pad(still.get((key[0], 1), np.zeros((9, 7))), 2)
        want = [[(fixed * np.roll(np.pad(moving[key], 2), (-dr, -dc), (0, 1))).sum() for dc in range(-2, 3)] for dr in range(-2, 3)]
        assert votes.tolist() == want


def test_a_template_is_held_once_for_all_cycles(spark):
    df = images(spark, {(0, t): np.ones((4, 4)) for t in (1, 2, 3)})
    plan = registration.vote_arrays(df.where("cycle = 1").drop("cycle"), df.where("cycle > 1"), 1, block=4)._jdf.queryExecution()
    assert "Join" not in plan.executedPlan().toString()


def test_a_block_is_never_cut(spark, monkeypatch):
    monkeypatch.setattr(blocks, "STACK_ROWS", 10)
    df = spark.range(300).select(F.when(F.col("id") > 50, F.floor(F.sqrt("id"))).alias("k"), "id").repartition(2, "k")
    seen = blocks.by_stacks(df, ["k"], lambda rows, number: rows.append_column("n", [number]).select(["k", "id", "n"]), "k bigint, id bigint, n bigint")
    with_part = seen.withColumn("p", F.spark_partition_id()).collect()
    for k in {x.k for x in with_part}:
        assert len({(x.p, x.n) for x in with_part if x.k == k}) == 1
    assert sorted(x.id for x in with_part) == list(range(300))
