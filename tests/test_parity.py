"""Every registered query against its SQL twin in an independent engine."""

import duckdb
import pytest

from reviewlens.plans.catalog import all_queries, all_sql

TABLES = ("documents", "part", "pages", "events", "embeddings")


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_without_sql_is_known():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_same_rows(spark, engine, sf_dir, name):
    got = all_queries()[name](spark, sf_dir)
    cursor = engine.execute(all_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    expected = sorted(repr(r) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == expected
