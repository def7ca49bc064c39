"""What must hold on the test tables whatever the amounts are."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from bookledger.plans.pipeline import BookingsPipeline
from bookledger.sources.driver_tables import driver_inputs


@pytest.fixture(scope="module")
def built(spark):
    return BookingsPipeline(driver_inputs(spark, SMALL))


def test_counters_are_set_at_most_once_per_line_item(built):
    counted = built.line_item_bookings.groupBy("line_item_id").agg(
        F.sum("gross_order_item_volume").alias("items"), F.sum("gross_order_volume").alias("orders")
    )
    worst = counted.agg(F.max("items"), F.max("orders"), F.sum("items"), F.sum("orders")).first()
    assert worst[0] == 1 and worst[1] == 1 and worst[2] >= worst[3] > 0


def test_result_has_one_row_per_grouped_booking(built):
    assert built.line_item_bookings.count() == built.bookings_grouped.count()


def test_later_discounts_are_allocated_in_full(built):
    booked = built.allocate_additional_invoice_discounts.groupBy("invoice_id").agg(
        F.sum("nbnf").alias("booked")
    )
    given = built.additional_invoice_discounts.groupBy("invoice_id").agg(
        F.sum("nbnf_discount_amount").alias("given")
    )
    both = booked.join(given, "invoice_id")
    assert both.count() > 0
    assert both.filter("abs(booked - given) > 0.05").count() == 0


def test_initial_discounts_are_allocated_once_per_discount_row(built):
    booked = built.allocate_initial_invoice_discounts.groupBy("invoice_id").agg(
        F.sum("nbnf").alias("booked")
    )
    given = built.initial_invoice_discounts.groupBy("invoice_id").agg(
        (F.sum("nbnf_discount_amount") * F.count(F.lit(1))).alias("given")
    )
    both = booked.join(given, "invoice_id")
    assert both.count() > 0
    assert both.filter("abs(booked - given) > 0.05").count() == 0


def test_no_python_functions_in_the_plan(built):
    plan = built.line_item_bookings._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
