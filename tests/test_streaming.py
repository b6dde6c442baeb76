"""Counts that follow arriving files, and the folder tables settle in."""

import os

import pytest
from pyspark.sql import functions as F

from spotweave.operators import expression
from spotweave.operators.assign import IN_PLACE
from spotweave.plans.files import incremental_counts
from spotweave.plans.registry import Inputs
from spotweave.session import configured, settle, shared_folder
from spotweave.streaming import incremental
from spotweave.streaming.incremental import read_counts, update_counts

SCHEMA = "fov int, cell_num bigint, gene_id int"


def test_restart_counts_every_file_once(spark, tmp_path):
    source, counts, checkpoint = (str(tmp_path / n) for n in ("in", "counts", "checkpoint"))
    cells = spark.createDataFrame([(0, 1), (1, 1)], "fov int, cell_num bigint")

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)

    def update():
        update_counts(
            spark, source, spark.createDataFrame([], SCHEMA).schema, lambda b: expression.cell_gene_counts(b, cells), counts, checkpoint, 1
        )
        return {tuple(r) for r in read_counts(spark, counts, ["fov", "cell_num", "gene_id"]).collect()}

    arrive([(0, 1, 5), (0, 1, 5), (0, 0, 5)])
    arrive([(0, 1, 5)])
    assert update() == {(0, 1, 5, 3)}
    assert update() == {(0, 1, 5, 3)}
    arrive([(1, 1, 6), (0, 1, 5)])
    assert update() == {(0, 1, 5, 4), (1, 1, 6, 1)}


class Session:
    """Stands in for a session with or without a named folder."""

    def __init__(self, master, named=None):
        self.sparkContext = self
        self.master, self.named, self.applicationId = master, named, f"{master}-{named}"
        self.conf = self

    def get(self, key, default=None):
        return self.named or default

    def getConf(self):
        return self


def test_named_folder_is_used_and_required_on_a_cluster():
    assert shared_folder(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_settled_tables_go_to_the_folder(spark):
    table = settle(spark.range(10))
    assert table.count() == 10
    assert all(shared_folder(spark) in f for f in table.inputFiles())


def uncommit(checkpoint, number):
    """As if the job had died before it noted the batch as done."""
    for name in (str(number), f".{number}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


def test_batches_are_merged_into_few_files(spark, tmp_path):
    source, counts, checkpoint = (str(tmp_path / n) for n in ("in", "counts", "checkpoint"))
    schema = spark.createDataFrame([], SCHEMA).schema
    count = lambda b: b.groupBy("fov", "cell_num", "gene_id").agg(F.count("*").alias("n"))

    def update():
        update_counts(spark, source, schema, count, counts, checkpoint, files_per_batch=1, merge_every=3)
        return {tuple(r) for r in read_counts(spark, counts, ["fov", "cell_num", "gene_id"]).collect()}

    for _ in range(11):
        spark.createDataFrame([(0, 1, 5), (1, 1, 6)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    want = {(0, 1, 5, 11), (1, 1, 6, 11)}
    assert update() == want
    store = incremental._Store(spark, counts)
    assert store.versions() == [5, 8] and store.parts() == [6, 7, 8, 9, 10]
    assert [s.rsplit("/", 1)[1] for s in store.sources()] == ["upto=8", "batch=9", "batch=10"]
    # A version whose writing was cut off does not count, and what it was made from is still there.
    os.remove(f"{counts}/merged/upto=8/_SUCCESS")
    assert {tuple(r) for r in read_counts(spark, counts, ["fov", "cell_num", "gene_id"]).collect()} == want
    # The last batch is played again after a crash.
    uncommit(checkpoint, 10)
    assert update() == want


def test_a_replayed_merge_counts_once(spark, tmp_path):
    source, counts, checkpoint = (str(tmp_path / n) for n in ("in", "counts", "checkpoint"))
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame([(0, 1, 5)], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    count = lambda b: b.groupBy("gene_id").agg(F.count("*").alias("n"))
    for _ in range(2):
        update_counts(spark, source, schema, count, counts, checkpoint, merge_every=1)
        assert read_counts(spark, counts, ["gene_id"]).first().n == 1
        uncommit(checkpoint, 0)


def test_only_rows_of_the_batch_are_read(spark, tmp_path):
    table = str(tmp_path / "mask")
    spark.range(100).selectExpr("CAST(id % 10 AS INT) AS fov", "id").write.partitionBy("fov").parquet(table)
    batch = spark.createDataFrame([(3, 1, 1), (5, 1, 1), (5, 2, 2)], SCHEMA)
    rows = incremental.rows_of_tiles(spark.read.parquet(table), batch)
    assert {r.fov for r in rows.collect()} == {3, 5} and rows.count() == 20
    assert "PartitionFilters: [isnotnull(fov" in rows._jdf.queryExecution().executedPlan().toString()
    assert incremental.rows_of_tiles(spark.read.parquet(table), batch.limit(0)).count() == 0


def test_a_batch_lists_the_pixels_of_its_tiles_and_sorts_none(spark):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    batch = inputs.spots.where("fov IN (1, 3)")
    with configured(spark, IN_PLACE):
        rows = incremental.rows_of_tiles(inputs.mask, batch)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
        assert plan.index("HashAggregate(keys=[fov") < plan.index("LeftSemi")  # tiles are chosen before pixels are put together
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, inputs.mask.where("fov IN (1, 3)").collect()))


def test_arriving_files_hold_whole_tiles_and_batches_the_cells_of_theirs(spark, monkeypatch):
    seen = {}

    def noted(session, source, schema, transform, *args, **kwargs):
        seen["source"] = source

        def counted(batch):
            out = transform(batch)
            seen.setdefault("parts", []).append(batch.select("fov").distinct().count())
            return out

        return update_counts(session, source, schema, counted, *args, **kwargs)

    monkeypatch.setitem(incremental_counts.__globals__, "update_counts", noted)
    found = incremental_counts(Inputs(spark, "/root/testdata/sf0.001"))
    tiles = spark.read.parquet(seen["source"]).select("fov", F.input_file_name().alias("f")).distinct()
    assert tiles.select("f").distinct().count() > 1 and tiles.count() == tiles.select("fov").distinct().count()
    assert sum(seen["parts"]) == tiles.count() and found.count() > 0
