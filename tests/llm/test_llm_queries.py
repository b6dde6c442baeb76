"""Registered training-data queries and the pipeline on the smallest data."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from spotweave.llm import mixing, queries

FOLDER = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert queries.QUERIES.keys() | {"pipeline"} <= entry.queries().keys() and queries.SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, FOLDER).toArrow().to_pylist(), db.sql(queries.SQL[name]).to_arrow_table().to_pylist()
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    assert sorted(got, key=key) == sorted(want, key=key)


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, FOLDER).cache()
        out[name] = now
        assert name == "packing" or now.columns == docs.columns
    held = {name: {r["doc_id"]: r["text"] for r in df.collect()} for name, df in out.items() if name != "packing"}
    toxic = {r["doc_id"] for r in queries.op4_toxicity(spark, FOLDER).where("toxic").collect()}
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert held["toxicity"] == {k: v for k, v in whole.items() if k not in toxic}
    last = {}
    for k in sorted(held["toxicity"]):
        last[held["toxicity"][k].translate(UPPER)] = k
    assert set(held["exact_dedup"]) == set(last.values())
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", v.translate(UPPER)) for k, v in held["exact_dedup"].items()}
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for k, w in words.items()}
    label = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    assert set(held["jaccard_join"]) == set(label.values())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(out["jaccard_join"]).collect()}
    assert Counter(r["doc_id"] for r in out["mixing"].collect()) == +Counter(copies)
    pieces = out["packing"].collect()
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == +Counter(copies)
    used = Counter()
    for r in pieces:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048
