
from datetime import datetime
from decimal import Decimal

import pytest
from builders import at, credit, discount, line, payment_hist, pipeline, pt, rows

from bookledger import fixed_values as fv

PAID = [payment_hist(1, at(1))]


def test_q1_initial_allocation_is_booked_once_per_discount_row(spark):
    p = pipeline(
        spark, payment_hist=PAID, line_item_hist=[line(1, at(0))],
        discount_hist=[discount(1, at(0)), discount(2, at(0, 1))],
    )
    # 10 + 10 off, allocated in full, booked for each of the two rows.
    assert rows(p.allocate_initial_invoice_discounts, "gbnf") == [(-40.0,)]


def test_q2_unknown_previous_status_or_price_keeps_the_version(spark):
    p = pipeline(spark, line_item_hist=[
        line(1, at(0), cancelled=None), line(2, at(1)), line(3, at(2)),
        line(4, at(0), line_item_id=12, amount=None), line(5, at(1), line_item_id=12, amount=0),
        line(6, at(2), line_item_id=12, amount=0),
    ])
    assert rows(p.line_item_changes, "line_item_hist_id") == [(1,), (2,), (4,), (5,)]


def test_q3_expiry_skips_dropped_versions(spark):
    p = pipeline(spark, line_item_hist=[line(1, at(0)), line(2, at(1)),
                                        line(3, at(2), amount=5)])
    got = rows(p.line_item_intervals, "line_item_hist_id", "record_expires_at_pt")
    assert got[0] == (1, pt(at(2)))


def test_q4_both_versions_at_the_cutoff_count(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[
        line(1, at(0)), line(2, at(1), created=at(0), amount=120),
    ])
    got = rows(p.classify_line_items, "line_item_hist_id", "is_counted_in_initial_gbnf",
               "is_after_fpa_date")
    assert got == [(1, True, False), (2, True, False)]


def test_q5_without_fpa_everything_is_initial_at_its_own_time(spark):
    p = pipeline(spark, line_item_hist=[line(1, at(0)), line(2, at(5), amount=120)],
                 discount_hist=[discount(1, at(3), line_item_id=11)])
    got = rows(p.combined_bookings, "booking_at_pt", "is_after_fpa_date",
               "invoice_first_payment_approved_at_pt")
    assert got == [(pt(at(0)), False, None), (pt(at(3)), False, None), (pt(at(5)), False, None)]


def test_q6_cutoff_is_not_before_the_first_update(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[line(1, at(4))])
    assert rows(p.classify_line_items, "invoice_cutoff_at_pt", "is_after_fpa_date") == [
        (pt(at(4)), False)
    ]


def test_q7_initial_bookings_count_as_after_the_fpa(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[line(1, at(0))])
    assert rows(p.bookings_grouped, "booking_at_pt", "is_booking_after_fpa_date") == [
        (pt(at(1)), True)
    ]


def test_q8_gross_is_null_without_day_totals_and_zero_in_the_ledger(spark):
    # A line without an invoice has no totals; a start in the far future puts it after.
    late = datetime(9999, 12, 31, 20)
    p = pipeline(spark, line_item_hist=[line(1, late, invoice_id=None)])
    assert rows(p.additional_line_item_bookings, "gbnf", "nbnf", "gb") == [(None, 100.0, None)]
    assert rows(p.bookings_grouped, "gbnf", "nbnf", "gb") == [(0.0, 100.0, 0.0)]


def test_q9_no_gross_on_days_with_more_cancelled_than_added(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[
        line(1, at(0)), line(2, at(5), created=at(0), cancelled=True),
        line(3, at(5, 1), line_item_id=12, amount=30),
    ])
    got = rows(p.additional_line_item_bookings, "line_item_id", "gbnf", "nbnf")
    assert got == [(11, 0.0, -100.0), (12, 0.0, 30.0)]


def line_item(line_item_id, price_point_id):
    return dict(line_item_id=line_item_id, price_point_id=price_point_id)


def test_q10_credit_without_known_fee_flag_only_lowers_nb(spark):
    p = pipeline(spark, payment_hist=PAID, line_item=[line_item(11, 10)],
                 store_credits=[credit(at(0))])
    got = rows(p.store_credit_bookings, "initial_gbnf", "initial_gb", "gbnf", "nbnf", "gb", "nb")
    assert got == [(0.0, 0.0, 0.0, 0.0, 0.0, -5.0)]


def test_q11_credit_without_fpa_is_after(spark):
    p = pipeline(spark, line_item=[line_item(11, 5)], store_credits=[credit(at(0))])
    got = rows(p.store_credit_bookings, "booking_at_pt", "booking_category_detail",
               "initial_gbnf", "nbnf")
    assert got == [(pt(at(0)), fv.CREDIT_AFTER, 0.0, -5.0)]


FOUR = [
    line(1, at(0)), line(2, at(0), line_item_id=12, amount=50, price_point_id=6),
]


def test_q12_highest_apply_type_rules(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=FOUR, discount_hist=[
        discount(1, at(0), rule=2), discount(2, at(0, 1), rule=3),
    ])
    got = rows(p.item_allocation_percentages, "line_item_id", "gbnf_initial_perc",
               "initial_discount_apply_type_id")
    assert got == [(11, 1.0, 3), (12, 0.0, 3)]


def test_q13_negative_weights_and_unknown_types_get_nothing(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[
        line(1, at(0)), line(2, at(0), line_item_id=12, price_point_id=10),
        line(3, at(0), line_item_id=13),
    ], discount_hist=[
        discount(1, at(0), rule=3), discount(2, at(0), line_item_id=13, amount=500),
    ], line_item_hierarchy=[dict(line_item_id=13, cart_line_item_id=11)])
    got = rows(p.item_allocation_percentages, "line_item_id", "gbnf_initial_perc")
    assert got == [(11, 1.0), (12, 0.0), (13, 0.0)]


def test_q13_everything_weighs_with_fees(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=FOUR,
                 discount_hist=[discount(1, at(0), rule=2)])
    got = rows(p.item_allocation_percentages, "line_item_id", "gbnf_initial_perc")
    assert got == [(11, 0.66666667), (12, 0.33333333)]


def test_q14_later_shares_use_all_time_sums(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[
        line(1, at(0)), line(2, at(5), line_item_id=12, amount=300),
    ], discount_hist=[discount(1, at(6))])
    got = rows(p.item_allocation_percentages, "line_item_id", "gbnf_initial_perc",
               "nbnf_additional_perc")
    assert got == [(11, 0.0, 0.25), (12, 0.0, 0.75)]


def test_q15_share_is_unsigned_while_total_is_signed(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[line(1, at(0))], discount_hist=[
        discount(1, at(2), amount=30), discount(2, at(3), amount=10, cancelled=True),
    ])
    # Signed total is -20; the times get 30/40 and 10/40 of it.
    got = rows(p.allocate_additional_invoice_discounts, "booking_at_pt", "nbnf")
    assert got == [(pt(at(2)), -15.0), (pt(at(3)), -5.0)]


def test_q16_a_line_item_with_two_price_points_is_two_items(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[
        line(1, at(0)), line(2, at(0, 1), amount=300, price_point_id=8),
    ], discount_hist=[discount(1, at(0))])
    got = rows(p.item_allocation_percentages, "line_item_id", "price_point_id")
    assert got == [(11, 5), (11, 8)]


def test_q17_booking_id_need_not_be_unique(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[
        line(1, at(0)), line(2, at(0, 1), created=at(0), amount=300, user_id=8),
    ])
    ids = [r[0] for r in rows(p.line_item_bookings, "booking_id")]
    assert len(ids) == 2 and len(set(ids)) == 1


def test_q18_repeated_autumn_hour_orders_by_wall_clock_then_id(spark):
    # 08:30 and 09:30 UTC on 3 November 2024 are both 01:30 in Los Angeles.
    first, second = datetime(2024, 11, 3, 8, 30), datetime(2024, 11, 3, 9, 30)
    p = pipeline(spark, line_item_hist=[line(2, first), line(1, second, amount=5)])
    got = rows(p.line_item_intervals, "line_item_hist_id", "record_started_at_pt",
               "record_expires_at_pt")
    wall = datetime(2024, 11, 3, 1, 30)
    assert got == [(1, wall, wall), (2, wall, None)]


def test_q19_ties_do_not_depend_on_row_order(spark):
    history = [line(n, at(0), line_item_id=n, amount=n) for n in range(1, 30)]
    off = [discount(n, at(0), line_item_id=n, amount=1) for n in range(1, 30)]
    results = set()
    for order in (1, -1):
        p = pipeline(spark, payment_hist=PAID, line_item_hist=history[::order],
                     discount_hist=off[::order])
        results.add(tuple(rows(p.line_item_bookings, "booking_id", "user_id", "gb",
                               "gross_order_item_volume")))
    assert len(results) == 1
    assert all(r[1] == 7 for r in results.pop())


def test_q20_mixed_signs_are_labelled_uncancelled(spark):
    # The discount on line 12 makes its net weight differ from its gross weight after the
    # FPA only; before it, gross and net are the same, so the sign test sees equal signs.
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[line(1, at(0))],
                 discount_hist=[discount(1, at(0)), discount(2, at(0, 1), cancelled=True)])
    # Both rows cancel out: nothing is allocated, so nothing is booked.
    assert rows(p.allocate_initial_invoice_discounts, "gbnf") == []


def test_q20_sign_test_prefers_uncancelled(spark):
    from bookledger.config import BookingsConfig
    from bookledger.operators.skew import NO_HOT_KEYS, Split
    from bookledger.plans.allocation import ITEM_KEYS, allocated_invoice_discounts

    item = {k: 1 for k in ITEM_KEYS}
    amounts = dict(
        gbnf_initial_discount_invoice_level=-1, nbnf_initial_discount_invoice_level=2,
        gbnf_additional_discount_invoice_level=-1, nbnf_additional_discount_invoice_level=2,
    )
    names = [*item, *amounts]
    schema = ", ".join(f"{k} bigint" for k in item) + ", " + ", ".join(
        f"{a} decimal(27,10)" for a in amounts
    )
    percentages = spark.createDataFrame(
        [tuple(Decimal(v) if k in amounts else v for k, v in (item | amounts).items())], schema
    ).select(*names)
    discounts = spark.createDataFrame(
        [(1, at(1), at(0), 2, False, None), (1, at(1), at(3), 2, True, Decimal(1))],
        "invoice_id bigint, invoice_first_payment_approved_at_pt timestamp_ntz, "
        "discount_hist_updated_at_pt timestamp_ntz, discount_apply_type_id int, "
        "is_after_fpa_date boolean, share_of_additional decimal(16,8)",
    )
    got = allocated_invoice_discounts(
        Split(percentages), Split(discounts), BookingsConfig(), NO_HOT_KEYS
    ).rows()
    assert rows(got, "is_after_fpa_date", "booking_category_detail", "booking_category") == [
        (False, fv.INITIAL_INVOICE_DISCOUNT_BEFORE, fv.INVOICE_LEVEL_DISCOUNT),
        # After the FPA a negative gross with a positive net has no detail.
        (True, None, fv.CANCELLED_INVOICE_LEVEL_DISCOUNT),
    ]


def test_q21_unread_columns_are_exposed_but_not_carried(spark):
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[line(1, at(0))])
    exposed = {"is_free_invoice", "record_started_date_pt", "record_expires_date_pt"}
    assert exposed <= set(p.classify_line_items.columns)
    assert "initial_invoice_amount" in p.initial_line_item_bookings.columns
    plan = p.combined_bookings._jdf.queryExecution().optimizedPlan().toString()
    assert not any(name in plan for name in exposed)


@pytest.mark.parametrize("updated,detail,net", [
    (at(0), fv.INITIAL_DISCOUNT_BEFORE, -10.0), (at(2), None, 0.0),
])
def test_q22_unknown_discount_status(spark, updated, detail, net):
    p = pipeline(spark, payment_hist=PAID,
                 discount_hist=[discount(1, updated, line_item_id=11, cancelled=None)])
    assert rows(p.combined_bookings, "booking_category_detail", "nbnf") == [(detail, net)]


def test_q22_unknown_status_lowers_the_invoice_net(spark):
    p = pipeline(spark, payment_hist=PAID, discount_hist=[discount(1, at(2), cancelled=None)])
    got = rows(p.additional_invoice_discounts, "gbnf_discount_amount", "nbnf_discount_amount")
    assert got == [(0.0, -10.0)]


def test_null_invoices_are_one_group(spark):
    p = pipeline(spark, line_item_hist=[
        line(1, at(0), invoice_id=None, amount=0),
        line(2, at(0), line_item_id=12, invoice_id=None, amount=5),
    ])
    assert rows(p.line_item_changes, "is_free_invoice") == [(False,), (False,)]


def test_missing_update_time_falls_back_to_creation(spark):
    row = line(1, at(0)) | dict(line_item_updated_at_utc=None, line_item_updated_at_pt=None)
    p = pipeline(spark, payment_hist=PAID, line_item_hist=[row])
    assert rows(p.classify_line_items, "record_started_at_pt", "invoice_cutoff_at_pt") == [
        (pt(at(0)), pt(at(1)))
    ]
