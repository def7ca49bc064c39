"""Discounts: changed versions, and what they take off line items and whole invoices."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bookledger import fixed_values as fv
from bookledger.config import BookingsConfig
from bookledger.functions import AMOUNT, div0, signed, sum_money, to_local, ts
from bookledger.operators.history import add_validity, keep_changes
from bookledger.operators.skew import (
    HotKeys,
    Split,
    co_locate,
    lookup,
    lookup_within,
    split_hot,
    total_over,
)
from bookledger.plans.lines import BOOKING_KEYS, FPA

RAW_FPA = "paid_at_pt"
TIES = ["discount_hist_id"]


def discount_versions(
    discount_hist: DataFrame,
    fpa: DataFrame,
    line_item_hierarchy: DataFrame,
    config: BookingsConfig,
    hot: HotKeys,
) -> DataFrame:
    """Discount versions with their invoice's FPA and their cart line.

    ``paid_at_pt`` is the invoice's FPA or NULL; the other FPA column is open-ended instead.
    """

    def local(column: str):
        return to_local(F.col(column), config.source_zone, config.local_zone)

    versions = discount_hist.withColumnRenamed("invoice_line_id", "line_item_id")
    versions = lookup(
        versions,
        fpa.select("invoice_id", F.col(FPA).alias(RAW_FPA)),
        ["invoice_id"],
        hot,
        "invoice",
    )
    versions = lookup_within(
        versions,
        line_item_hierarchy.select("line_item_id", "cart_line_item_id"),
        "line_item_id",
        hot,
        "line_item",
        hot.within("discount"),
    )
    return versions.select(
        "discount_hist_id",
        "discount_id",
        "line_item_id",
        "invoice_id",
        F.coalesce("cart_line_item_id", "line_item_id").alias("cart_line_item_id"),
        RAW_FPA,
        F.coalesce(RAW_FPA, ts(fv.OPEN_END)).alias(FPA),
        "discount_type_id",
        "discount_type",
        "discount_apply_type_id",
        "discount_apply_type",
        "discount_amount",
        "is_cancelled",
        "expires_at_utc",
        "discount_hist_updated_at_utc",
        local("discount_hist_updated_at_utc").alias("discount_hist_updated_at_pt"),
        "discount_created_at_utc",
        local("discount_created_at_utc").alias("discount_created_at_pt"),
    ).withColumns(
        {
            "discount_hist_updated_date_pt": F.col("discount_hist_updated_at_pt").cast("date"),
            "discount_created_date_pt": F.col("discount_created_at_pt").cast("date"),
        }
    )


def discount_changes(versions: DataFrame | Split, hot: HotKeys) -> DataFrame | Split:
    """The versions that changed the cancelled status or the amount."""
    # Status and amount are not defaulted here, unlike a line item's.
    return keep_changes(
        versions,
        "discount_id",
        ["discount_hist_updated_at_utc", *TIES],
        {
            "previous_is_cancelled": ("is_cancelled", "is_cancelled"),
            "previous_discount_amount": ("discount_amount", "discount_amount"),
        },
        hot,
        "discount",
    )


def discount_intervals(changes: DataFrame | Split, hot: HotKeys) -> DataFrame | Split:
    return add_validity(
        changes,
        "discount_id",
        "discount_hist_updated_at_pt",
        TIES,
        "record_started_at_pt",
        "record_expires_at_pt",
        hot,
        "discount",
    )


def classify_discounts(intervals: DataFrame) -> DataFrame:
    """Whether the discount existed at the FPA, and whether the version came after it."""
    no = F.lit(False)
    updated = F.coalesce("discount_hist_updated_at_pt", ts(fv.OPEN_END))
    return intervals.withColumns(
        {
            "is_initial_discount": F.coalesce(F.col("discount_created_at_pt") <= F.col(FPA), no),
            "is_after_fpa_date": F.coalesce(updated > F.col(FPA), no),
        }
    )


def _booked(classified: DataFrame) -> DataFrame:
    """Versions that are booked: all after the FPA, and initial discounts up to it."""
    return classified.filter(F.col("is_after_fpa_date") | F.col("is_initial_discount"))


def line_item_discounts(
    classified: DataFrame, dimension_types: Mapping[str, T.DataType]
) -> DataFrame:
    """Bookings of discounts on single line items, before and after the FPA.

    A discount knows nothing of the dimensions (user, price point, ...); they are NULL.
    """
    after, initial = F.col("is_after_fpa_date"), F.col("is_initial_discount")
    cancelled, amount = F.col("is_cancelled"), F.col("discount_amount").cast(AMOUNT)
    zero = F.lit(0).cast(AMOUNT)

    # Up to the FPA an unknown status counts as valid; after it, such a version has no
    # category and takes nothing off.
    detail = (
        F.when(~after & cancelled, fv.CANCELLED_INITIAL_DISCOUNT_BEFORE)
        .when(~after, fv.INITIAL_DISCOUNT_BEFORE)
        .when(initial & cancelled, fv.CANCELLED_INITIAL_DISCOUNT_AFTER)
        .when(cancelled, fv.CANCELLED_ADDITIONAL_DISCOUNT)
        .when(initial & ~cancelled, fv.INITIAL_DISCOUNT_AFTER)
        .when(~cancelled, fv.ADDITIONAL_DISCOUNT)
    )
    category = F.when(cancelled, fv.CANCELLED_LINE_ITEM_DISCOUNT).when(
        ~after | ~cancelled, fv.LINE_ITEM_DISCOUNT
    )
    # A discount lowers the booking, a cancelled one gives it back.
    effect = F.when(after & cancelled.isNull(), zero).otherwise(-signed(amount, cancelled))
    given_back = F.when(cancelled & initial, amount).otherwise(zero)

    booked = (
        _booked(classified)
        .filter(F.col("line_item_id").isNotNull())
        .select(
            "invoice_id",
            "line_item_id",
            F.col(RAW_FPA).alias(FPA),
            F.when(after, F.col("discount_hist_updated_at_pt"))
            .otherwise(F.coalesce(RAW_FPA, "discount_hist_updated_at_pt"))
            .alias("booking_at_pt"),
            detail.alias("booking_category_detail"),
            category.alias("booking_category"),
            "is_after_fpa_date",
            "cart_line_item_id",
            F.when(~after, effect).otherwise(zero).alias("initial"),
            F.when(after, effect).otherwise(zero).alias("additional"),
            F.when(after, given_back).otherwise(effect).alias("gross"),
            effect.alias("net"),
        )
    )
    keys = [k for k in BOOKING_KEYS if k not in dimension_types]
    sums = booked.groupBy(*keys).agg(
        *[sum_money(F.col(c)).alias(c) for c in ("initial", "additional", "gross", "net")]
    )
    return sums.select(
        *keys,
        *[F.lit(None).cast(kind).alias(name) for name, kind in dimension_types.items()],
        zero.alias("filing_fee"),
        F.col("initial").alias("initial_discount_amount"),
        F.col("additional").alias("additional_discount_amount"),
        F.col("initial").alias("initial_gbnf"),
        F.col("initial").alias("initial_gb"),
        F.col("gross").alias("gbnf"),
        F.col("net").alias("nbnf"),
        F.col("gross").alias("gb"),
        F.col("net").alias("nb"),
    )


def invoice_discounts(classified: DataFrame, hot: HotKeys) -> Split:
    """Discounts on whole invoices, per invoice, update time and apply type.

    ``share_of_additional`` tells which part of the invoice's discounts after the FPA the
    row holds, by unsigned amounts.
    """
    after, cancelled = F.col("is_after_fpa_date"), F.col("is_cancelled")
    amount = F.col("discount_amount").cast(AMOUNT)
    effect = -signed(amount, cancelled)
    given_back = F.when(cancelled & F.col("is_initial_discount"), amount).otherwise(
        F.lit(0).cast(AMOUNT)
    )
    on_invoice = _booked(classified).filter(F.col("line_item_id").isNull())

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(
            "invoice_id",
            F.col(RAW_FPA).alias(FPA),
            "discount_hist_updated_at_pt",
            "discount_apply_type_id",
            "is_after_fpa_date",
        ).agg(
            sum_money(F.when(after, given_back).otherwise(effect)).alias(
                "gbnf_discount_amount"
            ),
            sum_money(effect).alias("nbnf_discount_amount"),
            sum_money(F.when(after, amount)).alias("_unsigned"),
        )

    by_invoice = co_locate(split_hot(on_invoice, "invoice_id", hot, "invoice"), "invoice_id")
    grouped = total_over(
        by_invoice.map(summed),
        ["invoice_id"],
        {"_invoice_unsigned": F.sum("_unsigned")},
        hot,
        "invoice",
    )
    share = F.when(after, div0(F.col("_unsigned"), F.col("_invoice_unsigned")))
    return grouped.map(
        lambda rows: rows.withColumn("share_of_additional", share).drop(
            "_unsigned", "_invoice_unsigned"
        )
    )


def initial_invoice_discounts(discounts: DataFrame) -> DataFrame:
    return discounts.filter(~F.col("is_after_fpa_date")).drop(
        "is_after_fpa_date", "share_of_additional"
    )


def additional_invoice_discounts(discounts: DataFrame) -> DataFrame:
    return discounts.filter("is_after_fpa_date").drop("is_after_fpa_date")
