"""What moves when the ledger is grouped and counted: plans, and rows that are shuffled."""

import re
from collections import Counter

import pytest
from builders import at, discount, line, payment_hist, pipeline
from conftest import SMALL
from pyspark.sql import functions as F

from bookledger.plans import volume
from bookledger.plans.pipeline import BookingsPipeline
from bookledger.sources.driver_tables import driver_inputs
from bookledger.sources.sinks import Storage


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """Runs that are prepared for stages before and after the ledger is stored; plans are final at once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    runs = {}
    for stage in ("bookings_grouped", "bookings_quality"):
        folder = str(tmp_path_factory.mktemp(stage))
        runs[stage] = BookingsPipeline(driver_inputs(spark, SMALL), Storage(spark, folder)).prepare(stage)
    yield runs
    spark.conf.unset("spark.sql.adaptive.enabled")


def nodes(df):
    """(depth, text) of the physical plan's lines."""
    text = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for row in text.split("\n"):
        found = re.match(r"^([\s:|+\-]*)(?:\*\(\d+\) )?(.*)", row)
        out.append((len(found[1]), found[2]))
    return out


def below(plan, at):
    """The lines of the subtree whose root is line ``at``."""
    depth = plan[at][0]
    for deeper, text in plan[at + 1 :]:
        if deeper <= depth:
            return
        yield text


def exchanges(plan):
    return [(i, text) for i, (_, text) in enumerate(plan) if text.startswith("Exchange hashpartitioning")]


def test_bookings_are_grouped_where_they_lie(prepared):
    """Stored bookings and what is added by line item are summed in one task each, without a shuffle of either's sums."""
    plan = nodes(prepared["bookings_grouped"].bookings_grouped)
    for i, _ in exchanges(plan):
        assert not any("initial_gbnf" in text and "Bucketed: true" in text for text in below(plan, i))
    assert any("initial_gbnf" in text and "Bucketed: true" in text for _, text in plan)


def test_the_ledger_is_shuffled_once(prepared):
    """Its line items' counters and lineage need no shuffle; the one by invoice at the end takes all."""
    run = prepared["bookings_quality"]
    for stage in ("volume_eligibility", "gross_order_item_volume"):
        found = exchanges(nodes(getattr(run, stage)))
        # Bookings of the free product go to their invoice and back.
        assert not [text for _, text in found if "line_item_id" in text and "ENSURE" in text], stage
    plan = nodes(run.line_item_bookings)
    whole = [text for i, text in exchanges(plan) if any(t.startswith("Union") for t in below(plan, i))]
    assert len(whole) == 1 and whole[0].startswith("Exchange hashpartitioning(invoice_id")


def test_line_items_are_summed_before_they_go_to_their_invoice(prepared):
    plan = nodes(prepared["bookings_quality"].item_allocation_percentages)
    above = [i for i, _ in exchanges(plan) if any("Bucketed: true" in text for text in below(plan, i))]
    assert above
    for i in above:
        assert any(text.startswith("HashAggregate") and "sum(" in text for text in below(plan, i))
    # The discounts lie by invoice already.
    assert sum("Bucketed: true" in text for _, text in plan) == 2 and len(above) == 1


def shuffled_records(spark, df):
    """Rows written to shuffles by the plan's exchanges, after it has run."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    total = 0
    stack = [execution.executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_repeated_bookings_are_combined_without_a_shuffle(spark, tmp_path):
    """2,000 rows of ten bookings that lie by line item."""
    run = pipeline(spark, payment_hist=[payment_hist()], line_item_hist=[line(1, at(0))])
    own = run.fill_line_item_dimensions
    many = own.crossJoin(spark.range(2000)).withColumn("gb", F.lit("1.00").cast("decimal(18,2)"))
    many = many.withColumn("line_item_id", F.col("id") % 10).drop("id").withColumns(volume.no_spread(own))
    columns = [*volume.GROUP_KEYS, *volume.SUMMED, *volume.SPREAD]
    stored = Storage(spark, str(tmp_path)).keep_in_buckets(many.select(*columns), "line_item_id")
    none = stored.limit(0).repartition("line_item_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lying = volume.bookings_grouped(stored.unionByName(none))
        scattered = volume.bookings_grouped(many.select(*columns).repartition(3).unionByName(stored.limit(0)))
        # One task's rows each are combined before they are shuffled, if they have to be.
        assert shuffled_records(spark, lying) < 10 and 2000 <= shuffled_records(spark, scattered) < 2100
        as_set = lambda df: Counter(tuple(r) for r in df.select(*volume.GROUP_KEYS, "gb").collect())
        assert as_set(lying) == as_set(scattered) and lying.count() == 10
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_stored_and_computed_ledgers_give_the_same(spark, prepared):
    """A run that stores nothing takes the invoice's amounts from a window."""
    bare = BookingsPipeline(driver_inputs(spark, SMALL))
    for stage in ("volume_eligibility", "gross_order_item_volume", "gross_order_volume", "line_item_bookings"):
        a, b = getattr(bare, stage), getattr(prepared["bookings_quality"], stage)
        assert set(a.columns) == set(b.columns)
        order = sorted(a.columns)
        assert Counter(map(tuple, a.select(order).collect())) == Counter(map(tuple, b.select(order).collect()))


def test_deduplicated_schedule_of_a_hot_invoice(spark, tmp_path):
    """One invoice holds nearly all discount times; it is booked once, at the first, by partial aggregation."""
    from bookledger.config import BookingsConfig

    rows = dict(
        payment_hist=[payment_hist(settled=at(90))],
        line_item_hist=[line(n, at(0), line_item_id=100 + n, amount=10 + n) for n in range(5)],
        discount_hist=[discount(n, at(1 + n), amount=1) for n in range(60)],
    )
    expected = pipeline(spark, BookingsConfig(dedupe_initial_allocation=True), **rows)
    made = pipeline(spark, BookingsConfig(dedupe_initial_allocation=True, max_rows_per_task=20), **rows)
    made.inputs._given_hot_keys = None
    made.storage = Storage(spark, str(tmp_path))
    stage = "allocate_initial_invoice_discounts"
    made.prepare(stage)
    assert made.hot.has("invoice")
    assert "Window" not in made._invoice_discounts.heavy._jdf.queryExecution().optimizedPlan().toString()
    as_set = lambda df: Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    assert as_set(getattr(made, stage)) == as_set(getattr(expected, stage))
    assert len(getattr(made, stage).collect()) == 5
