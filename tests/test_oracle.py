"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import hashlib
import json

import duckdb
import pytest

import __spark_entry__ as E
from logledger.queries import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted(json.dumps([_norm(r[i]) for i in order], default=str)
                                         for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for n in TABLES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{SF_SMALL}/{n}.parquet')")
    return c


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    o = con.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in o.description], o.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, cols) == _digest(orows, ocols)
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == theirs


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["resource", "control_sum", "candidate_sum", "difference", "flag"]
    assert df.count() > 0
