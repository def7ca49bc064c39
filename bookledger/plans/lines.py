"""Line items: which versions changed something, and the bookings they stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookledger import fixed_values as fv
from bookledger.config import BookingsConfig
from bookledger.functions import AMOUNT, greatest_strict, signed, sum_money, to_local, ts
from bookledger.operators.history import add_validity, keep_changes
from bookledger.operators.skew import (
    HotKeys,
    Split,
    co_locate,
    each_row,
    lookup,
    lookup_within,
    total_over,
)

FPA = "invoice_first_payment_approved_at_pt"
VERSION_TIES = ["line_item_hist_id"]

BOOKING_KEYS = [
    "invoice_id",
    "line_item_id",
    "user_id",
    "workspace_id",
    FPA,
    "booking_at_pt",
    "booking_category_detail",
    "booking_category",
    "is_after_fpa_date",
    "cart_line_item_id",
    "subscription_id",
    "price_point_id",
]


def line_item_versions(
    line_item_hist: DataFrame,
    fpa: DataFrame,
    price_point: DataFrame,
    config: BookingsConfig,
    hot: HotKeys,
) -> DataFrame:
    """Line item versions, and what their invoice says about them.

    The invoice's cutoff separates initial from later bookings: its FPA, but never before
    its earliest update, and open-ended without an FPA.
    """
    seen = F.coalesce("line_item_updated_at_utc", "line_item_created_at_utc")
    versions = line_item_hist.withColumn(
        "record_updated_at_pt", to_local(seen, config.source_zone, config.local_zone)
    )
    versions = total_over(
        versions,
        ["invoice_id"],
        {
            "_invoice_first_update": F.min("line_item_updated_at_pt"),
            "_invoice_amount": F.sum("amount"),
        },
        hot,
        "invoice",
    )
    versions = lookup(versions, fpa, ["invoice_id"], hot, "invoice")
    versions = lookup_within(
        versions,
        price_point.select("price_point_id", "is_filing_fee"),
        "price_point_id",
        hot,
        "price_point",
        hot.within("line_item"),
    )
    first_update = F.coalesce("_invoice_first_update", ts(fv.OPEN_START))
    return versions.select(
        "line_item_hist_id",
        "line_item_id",
        "invoice_id",
        "workspace_id",
        "cart_line_item_id",
        "subscription_id",
        "invoice_first_payment_approved_at_utc",
        "invoice_first_payment_approved_date_utc",
        FPA,
        "invoice_first_payment_approved_date_pt",
        F.coalesce("is_cancelled", F.lit(False)).alias("is_cancelled"),
        F.col("is_cancelled").alias("_raw_status"),
        "line_item_updated_at_utc",
        "line_item_updated_at_pt",
        "record_updated_at_pt",
        F.col("record_updated_at_pt").cast("date").alias("record_updated_date_pt"),
        F.when(F.col(FPA).isNull(), ts(fv.OPEN_END))
        .otherwise(F.greatest(F.col(FPA), first_update))
        .alias("invoice_cutoff_at_pt"),
        "price_point_id",
        "user_id",
        "line_item_created_at_utc",
        "line_item_created_at_pt",
        F.coalesce("amount", F.lit(0).cast(line_item_hist.schema["amount"].dataType)).alias(
            "amount"
        ),
        F.col("amount").alias("_raw_amount"),
        "is_filing_fee",
        (~F.coalesce(F.col("_invoice_amount") > 0, F.lit(False))).alias("is_free_invoice"),
        "is_current_record",
        "cart_price_point_id",
        "root_price_point_id",
        "source_cart_line_item_id",
        "source_invoice_id",
        "source_line_item_id",
        "source_subscription_id",
        "source_user_id",
        "source_system",
    )


def line_item_changes(versions: DataFrame | Split, hot: HotKeys) -> DataFrame | Split:
    """The versions that changed the cancelled status or the price."""
    # The previous status and price are the raw ones: a NULL before means "keep the row".
    changes = keep_changes(
        versions,
        "line_item_id",
        ["record_updated_at_pt", *VERSION_TIES],
        {
            "previous_status": ("_raw_status", "is_cancelled"),
            "previous_price": ("_raw_amount", "amount"),
        },
        hot,
        "line_item",
    )
    return each_row(changes, lambda rows: rows.drop("_raw_status", "_raw_amount"))


def line_item_intervals(changes: DataFrame | Split, hot: HotKeys) -> DataFrame | Split:
    """Validity of each remaining version; it ends when the next remaining one starts."""
    return add_validity(
        changes,
        "line_item_id",
        "record_updated_at_pt",
        VERSION_TIES,
        "record_started_at_pt",
        "record_expires_at_pt",
        hot,
        "line_item",
    )


def classify_line_items(intervals: DataFrame) -> DataFrame:
    """Flags that decide how a version is booked, relative to the invoice's cutoff."""
    started, expires = F.col("record_started_at_pt"), F.col("record_expires_at_pt")
    cutoff = F.col("invoice_cutoff_at_pt")
    started_date = started.cast("date")
    zero = F.lit(0).cast(intervals.schema["amount"].dataType)
    no = F.lit(False)
    return intervals.withColumns(
        {
            "record_started_date_pt": started_date,
            "record_expires_date_pt": F.when(
                F.col("is_cancelled") & F.col("is_current_record"), started_date
            ).otherwise(greatest_strict(started_date, F.date_sub(expires.cast("date"), 1))),
            "extended_price_without_ff": F.when(F.col("is_filing_fee"), zero).otherwise(
                F.col("amount")
            ),
            "is_initial_line_item": F.coalesce(
                F.col("line_item_created_at_pt") <= cutoff, no
            ),
            # Both ends belong to the interval.
            "is_counted_in_initial_gbnf": F.coalesce(
                cutoff.between(started, F.coalesce(expires, ts(fv.OPEN_END))), no
            ),
            "is_after_fpa_date": F.coalesce(
                F.coalesce(started, ts(fv.OPEN_END)) > cutoff, no
            ),
        }
    )


def _day_totals() -> dict:
    """Amounts of an invoice on one day, by kind."""
    amount = F.col("amount")
    cancelled, after = F.col("is_cancelled"), F.col("is_after_fpa_date")
    initial, counted = F.col("is_initial_line_item"), F.col("is_counted_in_initial_gbnf")

    def total(condition):
        return F.sum(F.when(condition, amount).otherwise(0))

    return {
        "initial_invoice_cancelled_amount": total(cancelled & after & initial & ~counted),
        "initial_invoice_amount": total(~cancelled & ~after & initial & counted),
        "cancelled_invoice_amount": total(cancelled & after),
        "additional_invoice_amount": total(~cancelled & after),
    }


def invoice_level_totals(classified: DataFrame) -> DataFrame:
    """Amounts per invoice and local update day."""
    return classified.groupBy("invoice_id", FPA, "record_updated_date_pt").agg(
        *[agg.cast(AMOUNT).alias(name) for name, agg in _day_totals().items()]
    )


#: What bookings need to know about a version.
BOOKED_FROM = [
    "invoice_id",
    "line_item_id",
    "user_id",
    "workspace_id",
    FPA,
    "cart_line_item_id",
    "subscription_id",
    "price_point_id",
    "record_updated_at_pt",
    "record_updated_date_pt",
    "amount",
    "extended_price_without_ff",
    "is_filing_fee",
    "is_cancelled",
    "is_initial_line_item",
    "is_counted_in_initial_gbnf",
    "is_after_fpa_date",
]


def line_item_bookings(classified: Split, hot: HotKeys) -> DataFrame:
    """Bookings of line items, before and after the cutoff, in one aggregation.

    classified: versions, parted by invoice.

    Day totals come from a window over the same rows instead of a join with a second copy.
    Gross amounts are zero on days on which more was cancelled than added.
    """
    totals = _day_totals()
    rows = total_over(
        co_locate(classified, "invoice_id"),
        ["invoice_id", "record_updated_date_pt"],
        totals,
        hot,
        "invoice",
        "invoice_id",
    )
    return rows.map(_booked).rows()


def _booked(rows: DataFrame) -> DataFrame:
    totals = _day_totals()
    has_day = F.col("invoice_id").isNotNull() & F.col("record_updated_date_pt").isNotNull()
    rows = rows.withColumns({name: F.when(has_day, F.col(name).cast(AMOUNT)) for name in totals})

    after, cancelled = F.col("is_after_fpa_date"), F.col("is_cancelled")
    initial, counted = F.col("is_initial_line_item"), F.col("is_counted_in_initial_gbnf")
    zero = F.lit(0).cast(AMOUNT)
    day_cancelled = F.col("cancelled_invoice_amount")
    day_added = F.col("additional_invoice_amount")

    def gross(value):
        at_fpa = F.when(~cancelled & counted, value).otherwise(zero)
        later = F.when(day_cancelled > day_added, zero).when(
            day_added >= day_cancelled, signed(value, cancelled)
        )
        return F.when(after, later).otherwise(at_fpa)

    def net(value):
        return F.when(after, signed(value, cancelled)).otherwise(gross(value))

    def only_initial(value):
        return F.when(after, zero).otherwise(gross(value))

    without_fees = F.col("extended_price_without_ff").cast(AMOUNT)
    with_fees = F.col("amount").cast(AMOUNT)
    detail = (
        F.when(~after & cancelled, fv.CANCELLED_INITIAL_BOOKING_BEFORE)
        .when(~after, fv.INITIAL_BOOKING)
        .when(cancelled & initial, fv.CANCELLED_INITIAL_BOOKING_AFTER)
        .when(cancelled, fv.CANCELLED_ADDITIONAL_BOOKING)
        .otherwise(fv.ADDITIONAL_BOOKING)
    )
    booked = rows.filter(~after | ~counted).withColumns(
        {
            "booking_at_pt": F.when(after, F.col("record_updated_at_pt")).otherwise(
                F.coalesce(FPA, "record_updated_at_pt")
            ),
            "booking_category_detail": detail,
            "booking_category": F.when(cancelled, fv.CANCELLED_LINE_ITEM_BOOKING).otherwise(
                fv.LINE_ITEM_BOOKING
            ),
        }
    )

    def amount_sum(value, name):
        return sum_money(value).alias(name)

    return booked.groupBy(*BOOKING_KEYS).agg(
        amount_sum(
            F.when(~after, F.col("initial_invoice_cancelled_amount")),
            "initial_invoice_cancelled_amount",
        ),
        amount_sum(F.when(~after, F.col("initial_invoice_amount")), "initial_invoice_amount"),
        # Rows of one later booking share the day, hence the total.
        F.max(F.when(after, day_cancelled)).alias("cancelled_invoice_amount"),
        F.max(F.when(after, day_added)).alias("additional_invoice_amount"),
        amount_sum(
            F.when(F.col("is_filing_fee"), signed(with_fees, cancelled)).otherwise(zero),
            "filing_fee",
        ),
        F.lit(0).cast(AMOUNT).alias("initial_discount_amount"),
        F.lit(0).cast(AMOUNT).alias("additional_discount_amount"),
        amount_sum(only_initial(without_fees), "initial_gbnf"),
        amount_sum(only_initial(with_fees), "initial_gb"),
        amount_sum(gross(without_fees), "gbnf"),
        amount_sum(net(without_fees), "nbnf"),
        amount_sum(gross(with_fees), "gb"),
        amount_sum(net(with_fees), "nb"),
    )


def initial_line_item_bookings(bookings: DataFrame) -> DataFrame:
    return bookings.filter(~F.col("is_after_fpa_date")).drop(
        "cancelled_invoice_amount", "additional_invoice_amount"
    )


def additional_line_item_bookings(bookings: DataFrame) -> DataFrame:
    return bookings.filter("is_after_fpa_date").drop(
        "initial_invoice_cancelled_amount", "initial_invoice_amount"
    )
