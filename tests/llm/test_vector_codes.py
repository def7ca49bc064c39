"""Vector codes against a plain version with full searches, and the active search against the full one."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException

from bookledger.llm.vector_codes import active_search, full_search, trained_codes, vector_codes
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, label int, v string, entry int, distance int, code string, n int"
SMALL = "/root/testdata/sf0.001"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA).repartition(partitions)


def result(df, **options):
    return Counter(tuple(r) for r in vector_codes(df, **options).collect())


def vectors(n, width=8, seed=1, grid=64):
    """Components on a coarse grid, so that distances tie."""
    rng = random.Random(seed)
    return [(i, [rng.randrange(-grid, grid) / 32 for _ in range(width)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("n, entries", [(400, 16), (300, 256), (40, 256), (3, 256), (1, 4)])
def test_equals_plain_version(spark, n, entries):
    rows = vectors(n, grid=4 if n == 400 else 64)
    assert result(table(spark, rows), entries=entries) == Counter(brute.vector_codes(rows, entries))


def test_hard_rows(spark):
    rows = vectors(60)
    rows += [(100, None, 1), (101, [0.5] * 7 + [None], 1), (102, [0.5] * 7 + [math.nan], 1), (103, [math.inf] * 8, None)]
    rows += [(104, [-math.inf] * 8, None), (105, [0.25] * 8, None), (106, [-0.0003] * 8, None), (None, [0.1] * 8, 2)]
    rows += [(7, [0.3] * 8, 1), (7, [0.2] * 8, 1), (7, [0.2] * 8, 1)]  # repeated ids and rows
    rows += [(200 + i, [1.0] * 8, 0) for i in range(100)]  # a common vector
    rows += [(400, [200000.0] * 8, 5)]
    assert result(table(spark, rows), entries=16) == Counter(brute.vector_codes(rows, 16))


def test_other_lengths_go_and_bad_lengths_and_sizes_are_errors(spark):
    rows = vectors(20)
    expected = Counter(brute.vector_codes(rows, 4))
    assert result(table(spark, [*rows, (50, [1.0] * 4, 1), (51, [], 1)]), entries=4) == expected
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes(table(spark, [(1, [1.0] * 6, 1)]))
    with pytest.raises(PySparkException, match="beyond"):
        vector_codes(table(spark, [*rows, (52, [1e30] * 8, 1)]))


def test_empty_tables(spark):
    assert result(table(spark, vectors(1)).where("false")) == Counter()
    assert result(table(spark, [(1, None, 1)])) == Counter()


def test_whole_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert result(df) == Counter(brute.vector_codes(rows))


def test_active_search_equals_full_search():
    rng = np.random.default_rng(5)
    for trial in range(60):
        x = rng.integers(-3, 4, (200, 4))  # many ties
        book = rng.integers(-3, 4, (12, 4))
        entry, distance = full_search(x, book)
        moved = rng.random(12) < trial / 60
        fresh = np.where(moved[:, None], rng.integers(-3, 4, (12, 4)), book)
        found = active_search(x, fresh, moved, entry, distance)
        expected = full_search(x, fresh)
        assert (found[0] == expected[0]).all() and (found[1] == expected[1]).all()


def test_active_search_looks_at_moved_entries_only(monkeypatch):
    from bookledger.llm import vector_codes as module

    seen = []
    own = module._distances
    monkeypatch.setattr(module, "_distances", lambda x, e: seen.append((len(x), len(e))) or own(x, e))
    x, book = np.array([[0], [1], [10], [20]]), np.array([[0], [10], [20]])
    entry, distance = full_search(x, book)
    seen.clear()
    fresh = np.array([[0], [10], [19]])
    active_search(x, fresh, np.array([False, False, True]), entry, distance)
    assert seen == [(1, 3), (3, 1)]  # the row of the moved entry; the others against that entry


def test_large_components_are_exact():
    x = np.array([[2**28, -(2**28)], [2**28 - 1, 3]])
    entry, distance = full_search(x, np.array([[-(2**28), 2**28], [2**28, -(2**28) + 1]]))
    assert entry.tolist() == [1, 1] and distance.tolist() == [1, 1 + (2**28 + 2) ** 2]


def test_assignments_and_books_come_back(spark):
    rows, books = trained_codes(table(spark, vectors(50)), entries=8)
    assert books.shape == (4, 8, 2)
    for r in rows.collect():
        for p in range(4):
            d = [sum((a - b) ** 2 for a, b in zip(r["v"][2 * p : 2 * p + 2], e, strict=True)) for e in books[p].tolist()]
            assert (r["entry"][p], r["distance"][p]) == (d.index(min(d)), min(d))
