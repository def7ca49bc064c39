"""Statistics, rules from trees, the fit, and held-out accuracy on the test tables."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookledger.llm.quality import (
    STATISTICS, Condition, Rule, RuleModel, fit, held_out, lasso_logistic, quality_scores, statistics, training_sample,
    tree_rules,
)

FOLDER = "/root/testdata/sf0.01"


def test_statistics():
    found = dict(zip(STATISTICS, statistics("AA bb, bb!\n\nAA bb, bb!\n"), strict=True))
    assert found["distinct_words"] == 3 / 6 and found["top_word"] == 2 / 6 and found["distinct_lines"] == 0.5
    assert found["words_a_line"] == 3 and found["upper_words"] == 2 / 6 and found["sentence_ends"] == 2 / 6
    for text in ("", " \n", "!", "é", "\x00", "a" * 100_000, "𝔘 😀"):
        values = statistics(text)
        assert len(values) == len(STATISTICS) and all(v == v and abs(v) < 1e9 for v in values)


def test_rules_are_the_paths_of_a_tree():
    values = np.zeros((200, len(STATISTICS)))
    values[:, 1] = np.arange(200) / 200
    labels = ((values[:, 1] > 0.25) & (values[:, 1] <= 0.5)).astype(float)
    rules = [r for _ in range(40) for r in tree_rules(values, labels, np.random.default_rng(len(STATISTICS) + _), 2)]
    assert {c.statistic for r in rules for c in r.conditions} == {"upper"}
    both = [r for r in rules if len(r.conditions) == 2]
    # Below the split at one end there is one at the other; the path between holds both.
    assert any(abs(r.conditions[0].border - 0.5) < 0.03 and abs(r.conditions[1].border - 0.25) < 0.03 for r in both)
    assert all(len({(c.statistic, c.above) for c in r.conditions}) == len(r.conditions) for r in rules)


def test_lasso_finds_the_rules_that_matter():
    rng = np.random.default_rng(3)
    fired = rng.random((4000, 30)) < 0.4
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(3.0 * fired[:, 4] - 2.0 * fired[:, 9] - 0.5)))).astype(float)
    intercept, weights = lasso_logistic(fired, labels, 0.01)
    assert set(np.flatnonzero(np.abs(weights) > 0.2)) == {4, 9} and weights[4] > 1.5 and weights[9] < -0.8
    # At the minimum no gradient of a zero weight exceeds the penalty.
    miss = 1 / (1 + np.exp(-(intercept + fired @ weights))) - labels
    gradient = fired.T @ miss / len(labels)
    assert np.all(np.abs(gradient) <= 0.01 + 1e-3) and abs(miss.mean()) < 1e-3


def test_model_compiles_to_a_column(spark):
    model = RuleModel(-1.0, ((Rule((Condition("upper", True, 0.5), Condition("digit", False, 0.1))), 2.0),))
    rows = spark.createDataFrame([(0.6, 0.0), (0.6, 0.2), (0.5, 0.0)], "upper double, digit double")
    scores = [round(r[0], 6) for r in rows.select(model.score()).collect()]
    assert scores == [0.731059, 0.268941, 0.268941]


def test_held_out_fold(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")))
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in rows.collect())


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_accuracy(tables):
    docs, labels = tables
    scored = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in scored)
    assert len(scored) > 80 and right >= 0.95 * len(scored)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    good = sorted((r["score"], r["quality"]) for r in scored)
    bad = sum(q == 0 for _, q in good)
    assert sum(q == 0 for _, q in good[:bad]) >= 0.9 * bad


def test_sample_is_bounded_and_outside_the_held_out_fold(tables):
    docs, labels = tables
    rows = training_sample(docs, labels, 50).collect()
    assert len(rows) == 50
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in rows)


def test_hard_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "text"), (3, "x " * 100_000), (1, None)])
    labels = spark.createDataFrame([(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == 5 and {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}
    assert quality_scores(docs.where("false"), labels).collect() == []


def test_one_label_only(spark, documents):
    docs = documents([(i, f"some text {i}") for i in range(20)])
    labels = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, quality int")
    assert {r["predicted"] for r in quality_scores(docs, labels).collect()} == {0}
    assert fit(training_sample(docs, labels)).weighted == ()
