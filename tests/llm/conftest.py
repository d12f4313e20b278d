import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for n in TABLES:
        c.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{os.path.join(SF, n)}.parquet')")
    return c


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, ties, repeated rows, a long text, clashing extra columns."""
    rows = [(1, "alpha beta gamma delta epsilon", "a", 1), (1, "alpha beta gamma delta epsilon", "a", 1),
            (2, None, "a", None), (3, "", None, 3), (4, " \t\r\n ", "b", 4), (None, "one two", "b", 5),
            (6, "x" * 50_000 + " " + "lorem ipsum " * 20_000, None, 6), (7, "one two", "b", 7),
            (8, "Straße und Ωmega \x1c\x85 \U0001f600 ÀÉ", "c", 8), (9, "one\ntwo\none\ntwo\n", "c", 9)]
    return spark.createDataFrame([(*r, 0, "z") for r in rows],
                                 "doc_id long, text string, source string, n_chars long, kept int, component_id string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def compare_with_oracle(con, sql, df):
    got = rows(df.select(*sorted(df.columns)))
    o = con.execute(sql)
    names = [d[0] for d in o.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[i] for i in order) for r in o.fetchall()), key=repr)
    assert got == want
