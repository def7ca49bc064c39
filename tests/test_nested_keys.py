"""Where each line item has one invoice, all is done by invoice; results stay the same."""

import itertools
import re
from collections import Counter

import pytest
from builders import at, credit, discount, line, payment_hist, pipeline
from conftest import SMALL

from bookledger.config import BookingsConfig
from bookledger.operators import history
from bookledger.operators.skew import HotKeys, by_row, deal_out, lies_within, lookup_within, measure_hot_keys
from bookledger.plans import table_operators
from bookledger.plans.pipeline import BookingsPipeline
from bookledger.sources.driver_tables import driver_inputs
from bookledger.sources.sinks import Storage

STAGES = ("classify_line_items", "classify_discounts", "fill_line_item_dimensions", "line_item_bookings")


def rows_of(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def prepared(spark, tmp_path, stage, inputs=None):
    inputs = inputs or driver_inputs(spark, SMALL)
    return BookingsPipeline(inputs, Storage(spark, str(tmp_path))).prepare(stage)


def test_keys_without_a_heavy_hash_value_are_not_counted_one_by_one(spark):
    rows = spark.range(800).selectExpr("id % 200 AS key")

    def keep(df):
        raise AssertionError("nothing is heavy")

    assert not measure_hot_keys({"k": [(rows, "key")]}, 100, keep).has("k")


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(1, 5), (1, 5), (2, 5), (None, 6)], True),
        ([(1, 5), (1, 6)], False),
        ([(None, 5), (None, 6)], False),
        ([(1, 5), (2, None)], False),
        ([], True),
    ],
)
def test_keys_lie_within_an_outer_key(spark, rows, expected):
    df = spark.createDataFrame(rows, "key long, outer long")
    assert lies_within([(df, "key", "outer")]) is expected


def test_a_key_may_not_span_two_tables(spark):
    one = spark.createDataFrame([(1, 5)], "a long, x long")
    other = spark.createDataFrame([(1, 6)], "b long, y long")
    assert not lies_within([(one, "a", "x"), (other, "b", "y")])


def test_a_hot_outer_key_ends_the_nesting(spark):
    nested = {"line_item": ("invoice_id", "invoice")}
    assert HotKeys(nested=nested).grouping("line_item_id", "line_item") == ["invoice_id", "line_item_id"]
    hot = HotKeys({"invoice": spark.range(1)}, nested=nested)
    assert hot.within("line_item") is None
    assert hot.grouping("line_item_id", "line_item") == ["line_item_id"]


def test_lookup_within_repeats_rows_as_a_join_does(spark):
    left = spark.createDataFrame([(1, 7, "a"), (1, 7, "a"), (2, 7, "b"), (2, None, "c"), (3, 9, "d")], "o long, k long, v string")
    right = spark.createDataFrame([(7, "x"), (7, "y"), (None, "z")], "k long, r string")
    found = lookup_within(left, right, "k", HotKeys(), "", "o")
    plain = lookup_within(left, right, "k", HotKeys(), "", None)
    assert found.columns == plain.columns and rows_of(found) == rows_of(plain)


@pytest.mark.parametrize("stage", ["line_item_changes", "classify_discounts", "fill_line_item_dimensions"])
def test_versions_are_not_shuffled_by_line_or_discount(spark, tmp_path, stage):
    made = prepared(spark, tmp_path, stage)
    assert made.hot.within("line_item") == "invoice_id"
    plan = plan_of(getattr(made, stage))
    windows = [w for w in plan.split("Window")[1:] if "windowspecdefinition(line_item_id" in w or "windowspecdefinition(discount_id" in w]
    assert not windows
    assert "hashpartitioning(invoice_id" in plan
    assert not [x for x in plan.split("Exchange hashpartitioning(")[1:] if x.startswith("discount_id")]


@pytest.mark.parametrize("stage", STAGES)
def test_same_rows_by_invoice_and_by_line(spark, tmp_path, stage):
    made = prepared(spark, tmp_path / "a", stage)
    inputs = driver_inputs(spark, SMALL)
    inputs._given_hot_keys = HotKeys()
    other = prepared(spark, tmp_path / "b", stage, inputs)
    assert made.hot.within("line_item") and not other.hot.within("line_item")
    assert rows_of(getattr(made, stage)) == rows_of(getattr(other, stage))


def test_a_line_item_of_two_invoices_keeps_its_history(spark, tmp_path):
    made = pipeline(
        spark,
        line_item_hist=[line(1, at(1), invoice_id=1), line(2, at(3), amount=70, invoice_id=2)],
        payment_hist=[payment_hist(settled=at(2))],
    )
    made.inputs._given_hot_keys = None
    plain = rows_of(made.classify_line_items)
    made = BookingsPipeline(made.inputs, Storage(spark, str(tmp_path))).prepare("classify_line_items")
    assert made.hot.within("line_item") is None
    assert rows_of(made.classify_line_items) == plain


def test_credits_and_allocated_discounts_are_grouped_where_they_lie(spark, tmp_path):
    """Whole bookings are not shuffled on the way to the counters, only ids that ask for something."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = prepared(spark, tmp_path, "gross_order_item_volume")
        rows = plan_of(made.gross_order_item_volume).split("\n")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    depth = [len(re.match(r"^[\s:|+\-]*", row)[0]) for row in rows]
    assert any("AS booking_category_detail" in row for row in rows)
    for i, row in enumerate(rows):
        if "Exchange hashpartitioning" in row:
            below = itertools.takewhile(lambda j: depth[j] > depth[i], range(i + 1, len(rows)))
            assert not [rows[j] for j in below if "booking_category_detail" in rows[j]]


def test_lineitem_is_shuffled_once(spark, tmp_path):
    """What derives from it reads the stored table, by invoice."""
    made = prepared(spark, tmp_path, "fill_line_item_dimensions")
    for stage in ("fill_line_item_dimensions", "classify_discounts", "store_credit_bookings"):
        assert "lineitem.parquet" not in plan_of(getattr(made, stage)), stage
    alone = prepared(spark, tmp_path / "alone", "line_item_changes")
    assert "lineitem.parquet" in plan_of(alone.line_item_changes)


def test_stored_lines_make_the_same_inputs(spark, tmp_path):
    plain, made = driver_inputs(spark, SMALL), prepared(spark, tmp_path, "bookings_grouped")
    for name in ("line_item_hist", "discount_hist", "line_item_hierarchy", "line_item", "store_credits"):
        assert rows_of(made.inputs[name]) == rows_of(plain[name]), name


LINEITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


@pytest.fixture
def line_versions(spark, tmp_path):
    """Two versions each of line 1 of order 5, which changes its flag, and line 2, which doesn't."""
    rows = [
        (5, 1, 1, n, 10.0, 0.0, flag, "F", at(day))
        for n, day, flag in ((1, 0, "N"), (1, 3, "R"), (2, 0, "A"), (2, 4, "A"))
    ]
    spark.createDataFrame(rows, LINEITEM).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_changes_of_rows_without_their_invoice(spark, line_versions):
    """Each line lies within an order here, but the rows don't have it."""
    found = table_operators.keep_changes(spark, line_versions)
    assert Counter((r.line_item_id, r.previous_flag, r.l_returnflag) for r in found.collect()) == Counter(
        [(51, None, "N"), (51, "N", "R"), (52, None, "A")]
    )


def test_validity_of_rows_without_their_invoice(spark, line_versions):
    found = table_operators.validity_intervals(spark, line_versions).collect()
    assert Counter(r.line_item_id for r in found if r.expires_at is None) == Counter([51, 52])
    started = {(r.line_item_id, r.started_at): r for r in found}
    for r in found:
        assert r.expires_at is None or (r.line_item_id, r.expires_at) in started
    assert len(found) == 4


def test_rows_with_their_outer_key_stay_where_they_lie(spark):
    hot = HotKeys(nested={"line_item": ("invoice_id", "invoice")})
    rows = spark.createDataFrame([(1, 11, 0), (1, 11, 1)], "invoice_id long, line_item_id long, n long")
    for with_invoice in (True, False):
        given = rows.repartition("invoice_id") if with_invoice else rows.drop("invoice_id")
        found = history.add_validity(given, "line_item_id", "n", [], "started", "expires", hot, "line_item")
        assert ("windowspecdefinition(invoice_id" in plan_of(found)) is with_invoice
        assert Counter((r.started, r.expires) for r in found.collect()) == Counter([(0, 1), (1, None)])


def test_stored_tables_of_equal_keys_are_grouped_together(spark, tmp_path):
    """Only columns of stored tables are read here."""
    storage = Storage(spark, str(tmp_path))
    rows = spark.createDataFrame([(k, 10 * k, k) for k in range(20)] * 2, "k long, l long, v long")
    one, other = (storage.keep_in_buckets(rows, "k").select("k", "l") for _ in range(2))
    grouped = by_row(one.unionByName(other), "k", "l").groupBy("k", "l").count()
    assert "Exchange" not in plan_of(grouped)
    assert rows_of(grouped) == Counter({(4, k, 10 * k): 1 for k in range(20)})


def test_quality_of_stored_parts_that_are_joined_by_sorting(spark, tmp_path):
    """Bookings, credits and allocated discounts are stored; the checks read their keys only."""
    made = pipeline(
        spark,
        payment_hist=[payment_hist(i, settled=at(2)) for i in range(1, 6)],
        line_item_hist=[line(10 * i + n, at(n), 10 * i, i) for i in range(1, 6) for n in (1, 3)],
        discount_hist=[discount(i, at(1), invoice_id=i) for i in range(1, 6)],
        store_credits=[credit(at(4), invoice_id=i, line_item_id=10 * i) for i in range(1, 6)],
    )
    made.inputs._given_hot_keys = None
    made.storage = Storage(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made.prepare("bookings_quality")
        assert made.hot.within("line_item") and "allocated" in made._shared
        found = {r.check_name: r.failures for r in made.bookings_quality.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 9 and not any(found.values())


def test_partitions_follow_the_rows(spark, tmp_path):
    """40 versions and credits of invoices; the session asks for four partitions."""
    rows = dict(
        payment_hist=[payment_hist(i, settled=at(2)) for i in range(10)],
        line_item_hist=[line(10 * i + n, at(n), 10 * i, i) for i in range(10) for n in (1, 3, 5)],
        store_credits=[credit(at(4), invoice_id=i, line_item_id=10 * i) for i in range(10)],
    )
    expected = rows_of(pipeline(spark, **rows).line_item_bookings)
    made = pipeline(spark, BookingsConfig(rows_per_partition=7), **rows)
    made.inputs._given_hot_keys = None
    made.storage = Storage(spark, str(tmp_path))
    try:
        made.prepare("line_item_bookings")
        assert made.hot.rows == 40 and made.hot.within("line_item")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "6"
        buckets = {spark.sql(f"DESC EXTENDED {t}").filter("col_name = 'Num Buckets'").first().data_type for t in made.storage._tables}
        assert buckets == {"6"}
        assert rows_of(made.line_item_bookings) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_fewer_partitions_than_the_session_asks_for(spark):
    deal_out(spark, 40, 40)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
