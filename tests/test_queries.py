"""Every registered query against its SQL on the smallest data."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from spotweave.plans import REGISTRIES
from spotweave.plans.inputs import TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query for registry in REGISTRIES for name, query in registry.queries.items()}
SQL = {name: sql for registry in REGISTRIES for name, sql in registry.sql.items()}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def ordered(table):
    df = table.to_pandas()
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def same(a, b):
    if list(a.columns) != list(b.columns) or len(a) != len(b):
        return False
    return all(((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all() for c in a.columns)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_no_name_is_registered_twice():
    assert QUERIES.items() <= entry.queries().items()
    assert sum(len(r.queries) for r in REGISTRIES) == len(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    query = QUERIES[name](spark, FOLDER)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = query.toArrow()
    want = db.sql(SQL[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    a, b = ordered(got), ordered(want)
    assert len(b) > 0
    assert same(a, b), f"{name}: {len(a)} rows against {len(b)}"


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_derived_numbers_are_not_nan(db):
    # Comparisons above treat missing values as equal; the key inputs must not hide behind that.
    assert not np.isnan(db.sql(SQL["base_threshold"]).limit(1).fetchall()[0][0])
