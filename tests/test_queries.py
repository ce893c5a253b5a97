"""Every registered query that has SQL gives the same rows as DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__
from framesieve.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(records):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert normal(tuple(r) for r in got.select(*names).collect()) == normal(want.fetchall())


def test_every_query_has_a_row_and_sql_belongs_to_queries(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
