"""Every discovery query against its SQL, on the smallest tables."""

import decimal

import duckdb
import pytest

from filingloom.plans import oracle, queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    return round(float(v), 6) if isinstance(v, (int, float, decimal.Decimal)) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query(spark, db, name):
    got = queries.QUERIES[name](spark, DIR)
    found = db.sql(oracle.ORACLE[name])
    assert sorted(got.columns) == sorted(found.columns)
    assert rows(got.columns, got.collect()) == rows(found.columns, found.fetchall())


def test_frontier_is_bounded(spark):
    got = queries.crawl_frontier_exact(spark, DIR)
    assert got.columns == ["url", "found_on_page", "depth"] and 0 < got.count() < 40


def test_entry():
    import __spark_entry__ as e

    assert set(oracle.ORACLE) <= set(e.oracle_sql()) <= set(e.queries())
