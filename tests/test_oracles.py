"""Every registered query against its SQL oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from promptloom.registry import ORACLES, QUERIES
from tests.conftest import TESTDATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()



@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, bool) or v is None or not isinstance(v, (int, float)):
            return repr(v)
        return "nan" if math.isnan(v) else f"{float(v):.6f}"

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, TESTDATA)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert len(set(df.columns)) == len(df.columns)
    if name in ORACLES:
        result = db.execute(ORACLES[name])
        assert got == canonical([c[0] for c in result.description], result.fetchall())
    else:
        assert got[1]


def test_names():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"classifier_train_metrics", "classifier_proba", "classifier_predict"}


def test_entry(spark):
    assert entry.entry(spark).columns == ["vec_id", "prompt"]
