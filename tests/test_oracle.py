"""Every registered query against its SQL, on the smallest test tables."""

from collections import Counter

import duckdb
import pytest
from conftest import SMALL, TABLES

import __spark_entry__ as entry_points

# The optional part has its own tests.
OPTIONAL = set(entry_points._llm_queries())
QUERIES = {n: q for n, q in entry_points.queries().items() if n not in OPTIONAL}
SQL = {n: s for n, s in entry_points.oracle_sql().items() if n not in OPTIONAL}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def as_rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(v[i] for i in order) for v in values)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SMALL)
    result = database.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert as_rows(df.columns, df.collect()) == as_rows(names, result.fetchall())


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_returns_the_flagship(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 35 and df.count() > 0


@pytest.mark.parametrize("partitions", [1, 13])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    name = "line_item_bookings"
    expected = Counter(QUERIES[name](spark, SMALL).collect())
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert Counter(QUERIES[name](spark, SMALL).collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
