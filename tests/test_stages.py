"""Stages on hand-written rows, one case per branch."""

from datetime import date, datetime

import pytest
from builders import FEE, at, credit, discount, line, payment_hist, pipeline, pt, rows

from bookledger import fixed_values as fv
from bookledger.config import BookingsConfig

FPA = "invoice_first_payment_approved_at_pt"


def test_first_payment_approved_takes_earliest_approved_payment(spark):
    p = pipeline(spark, payment_hist=[
        payment_hist(1, at(3)), payment_hist(1, at(2)),
        payment_hist(1, at(0), status="Declined"), payment_hist(1, at(1), kind="Refund"),
        payment_hist(2, at(0), status="Declined"),
    ])
    got = p.first_payment_approved.collect()
    assert [r.asDict() for r in got] == [{
        "invoice_id": 1,
        "invoice_first_payment_approved_at_utc": at(2),
        FPA: pt(at(2)),
        "invoice_first_payment_approved_date_utc": date(2024, 1, 12),
        "invoice_first_payment_approved_date_pt": date(2024, 1, 11),
    }]


def test_changes_keep_first_and_changed_versions(spark):
    p = pipeline(spark, line_item_hist=[
        line(1, at(0)), line(2, at(1)), line(3, at(2), amount=120),
        line(4, at(3), amount=120), line(5, at(4), amount=120, cancelled=True),
    ])
    assert rows(p.line_item_changes, "line_item_hist_id") == [(1,), (3,), (5,)]


def test_intervals_end_at_next_remaining_version(spark):
    p = pipeline(spark, line_item_hist=[
        line(1, at(0)), line(2, at(1)), line(3, at(2), amount=120),
    ])
    got = rows(p.line_item_intervals, "line_item_hist_id", "record_started_at_pt",
               "record_expires_at_pt")
    assert got == [(1, pt(at(0)), pt(at(2))), (3, pt(at(2)), None)]


def test_classification_around_the_cutoff(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[
            line(1, at(0)),
            line(2, at(2), amount=120, created=at(0)),
            line(3, at(3), line_item_id=12, price_point_id=6),
        ],
    )
    got = rows(p.classify_line_items, "line_item_hist_id", "is_initial_line_item",
               "is_counted_in_initial_gbnf", "is_after_fpa_date", "extended_price_without_ff")
    assert got == [
        (1, True, True, False, 100.0),
        (2, True, False, True, 120.0),
        (3, False, False, True, 0.0),
    ]


def test_record_expires_date(spark):
    p = pipeline(spark, line_item_hist=[
        line(1, at(0)),
        line(2, at(3), amount=120),
        line(3, at(3, 1), cancelled=True, amount=120, is_current_record=True),
    ])
    got = rows(p.classify_line_items, "line_item_hist_id", "record_expires_date_pt")
    # One day before the next version, but not before its own day; own day if cancelled now.
    assert got == [(1, date(2024, 1, 11)), (2, date(2024, 1, 12)), (3, date(2024, 1, 12))]


def test_invoice_level_totals(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[
            line(1, at(0)),
            line(2, at(2), created=at(0), cancelled=True),
            line(3, at(2, 1), line_item_id=12, amount=30),
            line(4, at(2, 2), line_item_id=13, amount=7, cancelled=True),
        ],
    )
    got = rows(
        p.invoice_level_totals, "record_updated_date_pt", "initial_invoice_cancelled_amount",
        "initial_invoice_amount", "cancelled_invoice_amount", "additional_invoice_amount",
    )
    assert got == [
        (date(2024, 1, 9), 0.0, 100.0, 0.0, 0.0),
        (date(2024, 1, 11), 100.0, 0.0, 107.0, 30.0),
    ]


def test_initial_bookings_are_booked_at_the_fpa(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[
            line(1, at(0)),
            line(2, at(0), line_item_id=12, price_point_id=6, amount=40),
            line(3, at(0), line_item_id=13, amount=9, cancelled=True),
        ],
    )
    got = rows(p.initial_line_item_bookings, "line_item_id", "booking_at_pt",
               "booking_category_detail", "filing_fee", "initial_gbnf", "initial_gb", "gbnf",
               "nb")
    assert got == [
        (11, pt(at(1)), fv.INITIAL_BOOKING, 0.0, 100.0, 100.0, 100.0, 100.0),
        (12, pt(at(1)), fv.INITIAL_BOOKING, 40.0, 0.0, 40.0, 0.0, 40.0),
        (13, pt(at(1)), fv.CANCELLED_INITIAL_BOOKING_BEFORE, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_additional_bookings_categories_and_signs(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[
            line(1, at(0)),
            line(2, at(5), created=at(0), cancelled=True, amount=20),
            line(3, at(5), line_item_id=12, amount=50),
            line(4, at(7), line_item_id=12, created=at(5), amount=50, cancelled=True),
            line(5, at(5), line_item_id=13, amount=3, price_point_id=6),
        ],
    )
    got = rows(p.additional_line_item_bookings, "line_item_id", "booking_at_pt",
               "booking_category_detail", "booking_category", "filing_fee", "gbnf", "nbnf",
               "gb", "nb")
    assert got == [
        (11, pt(at(5)), fv.CANCELLED_INITIAL_BOOKING_AFTER, fv.CANCELLED_LINE_ITEM_BOOKING,
         0.0, -20.0, -20.0, -20.0, -20.0),
        (12, pt(at(5)), fv.ADDITIONAL_BOOKING, fv.LINE_ITEM_BOOKING, 0.0, 50.0, 50.0, 50.0,
         50.0),
        (12, pt(at(7)), fv.CANCELLED_ADDITIONAL_BOOKING, fv.CANCELLED_LINE_ITEM_BOOKING, 0.0,
         0.0, -50.0, 0.0, -50.0),
        (13, pt(at(5)), fv.ADDITIONAL_BOOKING, fv.LINE_ITEM_BOOKING, 3.0, 0.0, 0.0, 3.0, 3.0),
    ]


def test_line_item_discount_categories(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        discount_hist=[
            discount(1, at(0), line_item_id=11),
            discount(2, at(0), line_item_id=12, cancelled=True),
            discount(3, at(2), line_item_id=13, created=at(0), cancelled=True),
            discount(4, at(2), line_item_id=14, created=at(0)),
            discount(5, at(2), line_item_id=15, cancelled=True),
            discount(6, at(2), line_item_id=16),
        ],
    )
    columns = ("line_item_id", "booking_at_pt", "booking_category_detail", "initial_gbnf",
               "additional_discount_amount", "gbnf", "nbnf", "gb", "nb")
    assert rows(p.initial_line_item_discounts, *columns) == [
        (11, pt(at(1)), fv.INITIAL_DISCOUNT_BEFORE, -10.0, 0.0, -10.0, -10.0, -10.0, -10.0),
        (12, pt(at(1)), fv.CANCELLED_INITIAL_DISCOUNT_BEFORE, 10.0, 0.0, 10.0, 10.0, 10.0,
         10.0),
    ]
    assert rows(p.additional_line_item_discounts, *columns) == [
        (13, pt(at(2)), fv.CANCELLED_INITIAL_DISCOUNT_AFTER, 0.0, 10.0, 10.0, 10.0, 10.0, 10.0),
        (14, pt(at(2)), fv.INITIAL_DISCOUNT_AFTER, 0.0, -10.0, 0.0, -10.0, 0.0, -10.0),
        (15, pt(at(2)), fv.CANCELLED_ADDITIONAL_DISCOUNT, 0.0, 10.0, 0.0, 10.0, 0.0, 10.0),
        (16, pt(at(2)), fv.ADDITIONAL_DISCOUNT, 0.0, -10.0, 0.0, -10.0, 0.0, -10.0),
    ]


def test_discount_keeps_cart_line_of_hierarchy_or_its_own_line(spark):
    p = pipeline(
        spark,
        discount_hist=[discount(1, at(0), line_item_id=11), discount(2, at(0), line_item_id=12)],
        line_item_hierarchy=[dict(line_item_id=11, cart_line_item_id=99)],
    )
    assert rows(p.discount_changes, "line_item_id", "cart_line_item_id") == [(11, 99), (12, 12)]


def test_fill_takes_previous_then_next_value(spark):
    p = pipeline(
        spark,
        line_item_hist=[line(1, at(2), subscription_id=70), line(2, at(4), amount=5,
                                                                 subscription_id=71)],
        discount_hist=[discount(n, at(n), line_item_id=11) for n in (1, 3, 5)],
    )
    got = rows(p.fill_line_item_dimensions, "booking_at_pt", "subscription_id", "user_id",
               "price_point_id")
    assert got == [
        (pt(at(1)), 70, 7, 5), (pt(at(2)), 70, 7, 5), (pt(at(3)), 70, 7, 5),
        (pt(at(4)), 71, 7, 5), (pt(at(5)), 71, 7, 5),
    ]


# Four paid items: a product, a fee, standard shipping, and one of unknown type.
ITEMS = [
    line(1, at(0), line_item_id=11, amount=100, price_point_id=5),
    line(2, at(0), line_item_id=12, amount=50, price_point_id=6),
    line(3, at(0), line_item_id=13, amount=30, price_point_id=8),
    line(4, at(0), line_item_id=14, amount=20, price_point_id=10),
]


@pytest.mark.parametrize(
    "rule,expected",
    [
        (fv.APPLY_TO_PRODUCTS, {11: -10.0}),
        (fv.APPLY_TO_EVERYTHING, {11: -5.0, 12: -2.5, 13: -1.5, 14: -1.0}),
        (fv.APPLY_TO_ALL_BUT_FILING_FEES, {11: -7.692308, 13: -2.307692}),
        (fv.APPLY_TO_PRODUCTS_AND_STANDARD_SHIPPING, {11: -7.692308, 13: -2.307692}),
        (77, {}),
    ],
)
def test_allocation_rules_before_the_fpa(spark, rule, expected):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=ITEMS,
        discount_hist=[discount(1, at(0), rule=rule)],
    )
    got = rows(p.allocate_initial_invoice_discounts, "line_item_id", "gbnf", "nbnf",
               "booking_category_detail", "booking_category", "booking_at_pt")
    assert {r[0]: round(r[1], 6) for r in got} == expected
    assert all(r[1] == r[2] for r in got)
    assert all(
        r[3:] == (fv.INITIAL_INVOICE_DISCOUNT_BEFORE, fv.INVOICE_LEVEL_DISCOUNT, pt(at(1)))
        for r in got
    )


def test_cancelled_initial_invoice_discount(spark):
    p = pipeline(
        spark, payment_hist=[payment_hist(1, at(1))], line_item_hist=ITEMS[:1],
        discount_hist=[discount(1, at(0), cancelled=True)],
    )
    got = rows(p.allocate_initial_invoice_discounts, "gbnf", "booking_category_detail",
               "booking_category")
    assert got == [(10.0, fv.CANCELLED_INITIAL_INVOICE_DISCOUNT_BEFORE,
                    fv.CANCELLED_INVOICE_LEVEL_DISCOUNT)]


def test_additional_invoice_discounts_share_by_unsigned_amount(spark):
    p = pipeline(
        spark, payment_hist=[payment_hist(1, at(1))], line_item_hist=ITEMS[:1],
        discount_hist=[discount(1, at(2), amount=30), discount(2, at(3), amount=10)],
    )
    got = rows(p.additional_invoice_discounts, "discount_hist_updated_at_pt",
               "gbnf_discount_amount", "nbnf_discount_amount", "share_of_additional")
    assert got == [(pt(at(2)), 0.0, -30.0, 0.75), (pt(at(3)), 0.0, -10.0, 0.25)]
    got = rows(p.allocate_additional_invoice_discounts, "booking_at_pt", "gbnf", "nbnf",
               "additional_discount_amount", "booking_category_detail", "booking_category")
    assert got == [
        (pt(at(2)), 0.0, -30.0, -30.0, fv.ADDITIONAL_INVOICE_DISCOUNT,
         fv.INVOICE_LEVEL_DISCOUNT),
        (pt(at(3)), 0.0, -10.0, -10.0, fv.ADDITIONAL_INVOICE_DISCOUNT,
         fv.INVOICE_LEVEL_DISCOUNT),
    ]


@pytest.mark.parametrize(
    "created,detail,gross",
    [
        (at(0), fv.CANCELLED_INITIAL_INVOICE_DISCOUNT_AFTER, 10.0),
        (at(2), fv.CANCELLED_ADDITIONAL_INVOICE_DISCOUNT, 0.0),
    ],
)
def test_cancelled_invoice_discount_after_the_fpa(spark, created, detail, gross):
    p = pipeline(
        spark, payment_hist=[payment_hist(1, at(1))], line_item_hist=ITEMS[:1],
        discount_hist=[discount(1, at(2), cancelled=True, created=created)],
    )
    got = rows(p.allocate_additional_invoice_discounts, "gbnf", "nbnf",
               "booking_category_detail", "booking_category")
    assert got == [(gross, 10.0, detail, fv.CANCELLED_INVOICE_LEVEL_DISCOUNT)]


def line_item(line_item_id=11, price_point_id=5, **more):
    return dict(line_item_id=line_item_id, cart_line_item_id=11, user_id=7,
                price_point_id=price_point_id, source_system="CP1") | more


def test_store_credits_before_and_after_the_fpa(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item=[line_item(), line_item(12, 6)],
        store_credits=[
            credit(at(0)), credit(at(2)), credit(at(2)),
            credit(at(0), line_item_id=12), credit(at(2), line_item_id=12),
            credit(at(0), event_type="credit voided"), credit(at(0), source_id="other"),
        ],
    )
    got = rows(p.store_credit_bookings, "line_item_id", "booking_at_pt",
               "booking_category_detail", "initial_gbnf", "initial_gb", "gbnf", "nbnf", "gb",
               "nb")
    assert got == [
        (11, pt(at(1)), fv.CREDIT_BEFORE, -5.0, 0.0, -5.0, -5.0, 0.0, -5.0),
        (11, pt(at(2)), fv.CREDIT_AFTER, 0.0, 0.0, 0.0, -10.0, 0.0, -10.0),
        (12, pt(at(1)), fv.CREDIT_BEFORE, 0.0, -5.0, 0.0, 0.0, -5.0, -5.0),
        (12, pt(at(2)), fv.CREDIT_AFTER, 0.0, 0.0, 0.0, 0.0, 0.0, -5.0),
    ]


def test_counters_mark_the_first_booking_once(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[
            line(1, at(0)), line(2, at(3), created=at(0), amount=120),
            line(3, at(0), line_item_id=12, amount=10),
            line(4, at(0), line_item_id=13, amount=0),
        ],
    )
    got = rows(p.line_item_bookings, "line_item_id", "booking_at_pt",
               "gross_order_item_volume", "gross_order_volume")
    assert got == [
        (11, pt(at(1)), 1, 1), (11, pt(at(3)), 0, 0), (12, pt(at(1)), 1, 0),
        (13, pt(at(1)), 0, 0),
    ]


@pytest.mark.parametrize("paid,price,volume", [
    (False, 0, 1),   # a free product on a free, unpaid invoice counts
    (True, 0, 0),    # paid, but worth nothing
    (False, 10, 0),  # worth something, but unpaid
    (True, 10, 1),
])
def test_free_product_counts_as_order_item(spark, paid, price, volume):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))] if paid else [],
        line_item_hist=[line(1, at(0), amount=price, price_point_id=9)],
    )
    assert rows(p.line_item_bookings, "gross_order_item_volume", "gross_order_volume") == [
        (volume, volume)
    ]


def test_free_product_on_paid_invoice_with_other_items(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[line(1, at(0), amount=0, price_point_id=9),
                        line(2, at(0), line_item_id=12, amount=10)],
    )
    assert rows(p.line_item_bookings, "line_item_id", "gross_order_item_volume") == [
        (11, 1), (12, 1)
    ]


def test_third_party_payments_by_order_else_invoice(spark):
    def pay(order_id, invoice_id, third, status=fv.PAYMENT_STATUS_APPROVED):
        return dict(order_id=order_id, invoice_id=invoice_id, is_third_party_payment=third,
                    transaction_status=status)

    p = pipeline(spark, payment=[
        pay(1, 900, True), pay(1, 901, None), pay(None, 2, False), pay(3, 3, True, "Declined"),
    ])
    got = rows(p.third_party_payment_invoices, "invoice_id", "third_party_payments",
               "invoice_has_third_party_gateway_payment")
    assert got == [(1, 1, True), (2, 0, False)]


def test_flagship_columns_and_lineage(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[line(1, at(0))],
        line_item=[line_item(source_system="CP2", cart_price_point_id=5)],
    )
    df = p.line_item_bookings
    assert len(df.columns) == 35
    row = df.collect()[0]
    assert row["source_system"] == "CP2" and row["cart_price_point_id"] == 5
    assert row["invoice_has_third_party_gateway_payment"] is False
    import hashlib

    text = f"11-2024-01-10 16:00:00.000-{fv.INITIAL_BOOKING}-{fv.LINE_ITEM_BOOKING}-5"
    assert row["booking_id"] == hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize("newest,expected", [
    (datetime(2024, 1, 30, 0, 5), 1), (datetime(2024, 1, 29, 23, 59), 0), (None, None),
])
def test_data_ready_check(spark, newest, expected):
    from bookledger.plans.checks import is_ready

    source = [dict(dtlastupdated=newest)] if newest else []
    p = pipeline(spark, freshness_source=source)
    as_of = datetime(2024, 1, 30, 8, 15)  # 00:15 in Los Angeles
    assert p.data_ready_check(as_of).collect()[0]["has_today"] == expected
    assert is_ready(p.inputs["freshness_source"], as_of, p.config) == (expected == 1)


def test_quality_reports_duplicate_dimension_rows(spark):
    p = pipeline(
        spark,
        payment_hist=[payment_hist(1, at(1))],
        line_item_hist=[line(1, at(0))],
        line_item=[line_item(), line_item()],
        product_price_point=[FEE, FEE],
    )
    failures = dict(rows(p.bookings_quality, "check_name", "failures"))
    assert failures["unique_line_item"] == 1 and failures["unique_product_price_point"] == 1
    assert failures["unique_booking_id"] == 1 and failures["unique_price_point"] == 0


def test_dedupe_initial_allocation_books_once(spark):
    inputs = dict(
        payment_hist=[payment_hist(1, at(1))], line_item_hist=ITEMS[:1],
        discount_hist=[discount(1, at(0)), discount(2, at(0, 1))],
    )
    config = BookingsConfig(dedupe_initial_allocation=True)
    got = pipeline(spark, config, **inputs).allocate_initial_invoice_discounts
    assert rows(got, "gbnf") == [(-20.0,)]


def test_dedupe_initial_allocation_books_once_without_a_payment(spark):
    inputs = dict(
        line_item_hist=ITEMS[:1], discount_hist=[discount(1, at(0)), discount(2, at(0, 1))],
    )
    config = BookingsConfig(dedupe_initial_allocation=True)
    got = pipeline(spark, config, **inputs).allocate_initial_invoice_discounts
    assert rows(got, "gbnf") == [(-20.0,)]
    assert rows(pipeline(spark, None, **inputs).allocate_initial_invoice_discounts, "gbnf") == [
        (-20.0,), (-20.0,)
    ]


def test_quality_reports_discounts_that_no_item_takes(spark):
    """A rule for products only, on an invoice of filing fees."""
    fees = [line(1, at(0), price_point_id=6)]
    for settled, side in ((at(5), "initial"), (at(-5), "additional")):
        p = pipeline(
            spark, payment_hist=[payment_hist(settled=settled)], line_item_hist=fees,
            discount_hist=[discount(1, at(1), rule=1)],
        )
        failures = {r["check_name"]: r["failures"] for r in p.bookings_quality.collect()}
        assert failures[f"{side}_discounts_allocated"] == 1
        assert sum(failures.values()) == 1


def test_rules_and_shipping_pattern_are_settings(spark):
    items = [line(1, at(0), price_point_id=5), line(2, at(0), line_item_id=12, price_point_id=8)]
    discounts = [discount(1, at(0), rule=77)]
    config = BookingsConfig(
        apply_to_products_and_standard_shipping=77, shipping_name_pattern="%box"
    )
    inputs = dict(payment_hist=[payment_hist(settled=at(1))], line_item_hist=items, discount_hist=discounts)
    got = pipeline(spark, config, **inputs).allocate_initial_invoice_discounts
    assert rows(got, "line_item_id", "gbnf") == [(11, -5.0), (12, -5.0)]
    assert rows(pipeline(spark, None, **inputs).allocate_initial_invoice_discounts, "gbnf") == []


def test_ready_check_converts_times_with_a_zone(spark):
    from datetime import datetime, timedelta, timezone

    p = pipeline(spark, freshness_source=[dict(dtlastupdated=datetime(2024, 1, 29, 23))])
    # 09:00 at +02:00 is 07:00 UTC, still the 29th in Los Angeles.
    zoned = datetime(2024, 1, 30, 9, tzinfo=timezone(timedelta(hours=2)))
    assert p.data_ready_check(zoned).first()[0] == 1
    assert p.data_ready_check(datetime(2024, 1, 30, 9)).first()[0] == 0


def test_fixed_texts_are_spelled_out():
    """The SQL counterparts share these with the package, so a wrong letter would pass there."""
    from bookledger import fixed_values as fv

    assert fv.INITIAL_BOOKING == "Initial Line Item Booking Before FPA"
    assert fv.CANCELLED_INITIAL_INVOICE_DISCOUNT_AFTER == (
        "Cancelled Initial Invoice Level Discount After FPA"
    )
    assert fv.LINE_ITEM_CREDIT == "Line Item Credit"
    assert (fv.CREDIT_EVENT_ISSUED, fv.FREE_PRODUCT_CODE) == ("credit issued", "7820")
    assert fv.CREDIT_SOURCE_ID == "4f9e2b5e-c45e-434b-b2b2-126b5a251a9c"
