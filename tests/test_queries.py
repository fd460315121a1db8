import glob
import os

import duckdb
import pytest

from groovemill.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def norm(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, DATA)
    want = db.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert norm(got.columns, got.collect()) == norm(names, want.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
