"""Registered queries of this part against their SQL, and their entry points."""

from collections import Counter

import duckdb
import pytest

from bookledger.llm.oracle import SQL
from bookledger.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in "documents pages benchmark conversations embeddings".split():
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = database.execute(SQL[name])
    names = [c[0] for c in result.description]
    df = QUERIES[name](spark, SMALL)
    order = sorted(names)
    assert order == sorted(df.columns)
    expected = Counter(tuple(dict(zip(names, row, strict=True))[c] for c in order) for row in result.fetchall())
    assert Counter(tuple(r) for r in df.select(*order).collect()) == expected


def test_queries_are_registered():
    import __spark_entry__

    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(SQL) <= set(__spark_entry__.oracle_sql())
