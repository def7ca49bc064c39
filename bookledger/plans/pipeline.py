"""All stages of the booking ledger, wired together.

Each property is one stage: a plan, built when first asked for, without running anything. Some
results are read by several stages: the classified discounts, the filled bookings, the
discounts on invoices, and the grouped ledger. ``prepare`` is the step that runs jobs: it looks for hot keys,
stores the rows of hot keys where a stage parts its input, and stores those results for the stages to come.
Without it, stages compute them again.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookledger.config import BookingsConfig
from bookledger.functions import surrogate_key, timestamp_text
from bookledger.operators.ordered import fill_nearest
from bookledger.operators.skew import (
    NO_HOT_KEYS,
    HotKeys,
    Split,
    by_row,
    deal_out,
    join_where_rows_lie,
    listed_hot_keys,
    lookup,
    lookup_within,
    split_hot,
)
from bookledger.plans import allocation, checks, credits, discounts, lines, payments, volume
from bookledger.plans.lines import FPA
from bookledger.sources.inputs import BookingsInputs
from bookledger.sources.sinks import Storage

BOOKING_COLUMNS = [
    "invoice_id",
    "line_item_id",
    "cart_line_item_id",
    "subscription_id",
    "user_id",
    "workspace_id",
    "price_point_id",
    FPA,
    "booking_at_pt",
    "booking_category_detail",
    "booking_category",
    "is_after_fpa_date",
    "initial_gbnf",
    "initial_gb",
    "filing_fee",
    "initial_discount_amount",
    "additional_discount_amount",
    "gbnf",
    "nbnf",
    "gb",
    "nb",
]
DIMENSIONS = ["subscription_id", "user_id", "workspace_id", "price_point_id"]
LINEAGE = [
    "cart_price_point_id",
    "root_price_point_id",
    "source_fulfillment_id",
    "source_cart_line_item_id",
    "source_invoice_id",
    "source_line_item_id",
    "source_subscription_id",
    "source_user_id",
    "source_root_price_point_id",
    "source_cart_price_point_id",
    "source_system",
]


def fill_order(has_user: str) -> list[str]:
    """By time; at the same time rows that know their dimensions come before discounts."""
    return ["booking_at_pt", has_user, *volume.BOOKING_ORDER[1:]]


_VOLUMES = ("volume_eligibility", "gross_order_item_volume", "gross_order_volume")
_LEDGER = ("line_item_bookings", "bookings_quality")
# Stages that read the filled bookings, stages before them, and what needs no hot keys.
_READ_BOOKINGS = (
    "item_allocation_percentages",
    "allocate_initial_invoice_discounts",
    "allocate_additional_invoice_discounts",
    "all_bookings",
    "bookings_grouped",
    *_VOLUMES,
    *_LEDGER,
)
_COMBINED = ("combined_bookings", "fill_line_item_dimensions", *_READ_BOOKINGS)
_BOOKED = ("initial_line_item_bookings", "additional_line_item_bookings", *_COMBINED)
_VERSIONS = (
    "line_item_changes",
    "line_item_intervals",
    "classify_line_items",
    "invoice_level_totals",
    *_BOOKED,
)
_DISCOUNTS = (
    "discount_changes",
    "discount_intervals",
    "classify_discounts",
    "initial_line_item_discounts",
    "additional_line_item_discounts",
    "initial_invoice_discounts",
    "additional_invoice_discounts",
    *_COMBINED,
)
_NO_HOT_KEYS_NEEDED = (
    "first_payment_approved",
    "third_party_payment_invoices",
    "data_ready_check",
)


class BookingsPipeline:
    # Where a table is parted into rows of ordinary and of hot keys: (key, domain).
    PARTED = {
        "_versions": ("line_item_id", "line_item"),
        "_booked_versions": ("invoice_id", "invoice"),
        "_discount_versions": ("discount_id", "discount"),
        "_combined_rows": ("line_item_id", "line_item"),
        "_counted": ("invoice_id", "invoice"),
    }

    def __init__(self, inputs: BookingsInputs, storage: Storage | None = None):
        self.inputs = inputs
        self.config: BookingsConfig = inputs.config
        self.storage = storage
        self.hot: HotKeys = NO_HOT_KEYS
        self._shared: dict[str, DataFrame] = {}
        self._heavy: dict[str, DataFrame] = {}

    def prepare(self, stage: str = "line_item_bookings") -> BookingsPipeline:
        """Run what ``stage`` wants to be known or stored beforehand; call it before any stage."""
        if self.storage is None:
            raise ValueError("preparing a run needs a folder for intermediate tables")
        if stage not in _NO_HOT_KEYS_NEEDED:
            self.hot = self.inputs.measure(self.storage.keep)
            deal_out(self.storage.spark, self.hot.rows, self.config.rows_per_partition)
            if self.hot.nested:
                join_where_rows_lie(self.storage.spark)
        if stage in _COMBINED and self.hot.within("line_item"):
            self.inputs.lie_by_invoice(self.storage.keep_in_buckets)
            self._forget_plans()
        if stage in _VERSIONS:
            self._keep_heavy("_versions")
        if stage in _BOOKED:
            self._keep_heavy("_booked_versions")
        if stage in _DISCOUNTS:
            self._keep_heavy("_discount_versions")
        if stage in _COMBINED:
            by_invoice = "invoice" if self.hot.within("line_item") else None
            self._keep_shared("discounts", self._discounts, by_invoice)
        if stage == "fill_line_item_dimensions" or stage in _READ_BOOKINGS:
            self._keep_heavy("_combined_rows")
        if stage in _READ_BOOKINGS:
            # Unions keep the way in which rows lie only if no column is added to them on the way.
            empty = volume.no_spread(self._filled_bookings)
            self._keep_shared("bookings", self._filled_bookings.withColumns(empty), self._lies_by)
            self._keep_shared("invoice_discounts", self._discounts_on_invoices, "invoice")
            self._find_large_products()
        if stage == "bookings_quality":
            self._keep_shared("allocated", self._allocated.rows(), "invoice")
        if stage in _VOLUMES or stage in _LEDGER:
            if self._lies_by == "invoice":
                # The ledger is read once then; credits twice.
                credited = self.store_credit_bookings
                self._keep_shared("credits", credited.withColumns(volume.no_spread(credited)), "invoice")
            else:
                product = self.inputs["product_price_point"]
                ledger = volume.with_ready_columns(self.bookings_grouped, product, self.config, self.hot)
                self._keep_shared("ledger", ledger, "line_item")
        if stage in _LEDGER:
            self._keep_heavy("_counted")
        return self

    @property
    def _lies_by(self) -> str:
        """Bookings lie by invoice where each line item has one, so that nothing moves between the two."""
        return "invoice" if self.hot.within("line_item") else "line_item"

    def _forget_plans(self) -> None:
        """Plans are built anew, on what has been stored since."""
        for name in [n for n in self.__dict__ if isinstance(getattr(type(self), n, None), cached_property)]:
            del self.__dict__[name]

    def _keep_shared(self, name: str, df: DataFrame, lies_by: str | None = None) -> None:
        """``lies_by``: invoice or line item, by which ``df`` lies and is read. A hot one would be one bucket, so
        there are no buckets then."""
        if lies_by and not self.hot.has(lies_by):
            self._shared[name] = self.storage.keep_in_buckets(df, f"{lies_by}_id")
        else:
            self._shared[name] = self.storage.keep(df)
        self._forget_plans()

    def _keep_heavy(self, name: str) -> None:
        """Stores rows of hot keys, and only those, where their plans will read them more than once."""
        key, domain = self.PARTED[name]
        if self.hot.has(domain):
            heavy = self.hot.part(getattr(self, name), domain, key, heavy=True)
            self._heavy[name] = self.storage.keep(heavy)
            self._forget_plans()

    def _parted(self, name: str) -> Split:
        key, domain = self.PARTED[name]
        return split_hot(getattr(self, name), key, self.hot, domain, self._heavy.get(name))

    def _by_invoice(self, name: str, df: DataFrame) -> Split:
        """A shared result parted by invoice; it is stored, or computed for each part."""
        return split_hot(self._shared.get(name, df), "invoice_id", self.hot, "invoice")

    def _find_large_products(self) -> None:
        """Invoices with few rows in every input may still make many rows when discounts are allocated."""
        bookings, discounts = self._shared["bookings"], self._shared["invoice_discounts"]
        limit, keep = self.config.max_rows_per_task, self.storage.keep
        lies_by = None if self._lies_by == "line_item" else "invoice_id"
        if allocation.largest_products(bookings, discounts, lies_by) <= limit:
            return
        invoices, lines = allocation.product_sizes(bookings, discounts)
        found = listed_hot_keys({"invoice": invoices, "line_item": lines}, limit, keep)
        self.hot = self.hot.merge(found, keep)
        self._forget_plans()

    # -- payments --------------------------------------------------------------------------

    @cached_property
    def first_payment_approved(self) -> DataFrame:
        return payments.first_payment_approved(self.inputs["payment_hist"], self.config)

    @cached_property
    def third_party_payment_invoices(self) -> DataFrame:
        return payments.third_party_payment_invoices(self.inputs["payment"])

    # -- line items ------------------------------------------------------------------------

    @cached_property
    def _versions(self) -> DataFrame:
        return lines.line_item_versions(
            self.inputs["line_item_hist"],
            self.first_payment_approved,
            self.inputs["price_point"],
            self.config,
            self.hot,
        )

    @cached_property
    def _changes(self) -> Split:
        return lines.line_item_changes(self._parted("_versions"), self.hot)

    @cached_property
    def line_item_changes(self) -> DataFrame:
        return self._changes.rows()

    @cached_property
    def line_item_intervals(self) -> DataFrame:
        return lines.line_item_intervals(self._changes, self.hot).rows()

    @cached_property
    def classify_line_items(self) -> DataFrame:
        return lines.classify_line_items(self.line_item_intervals)

    @cached_property
    def invoice_level_totals(self) -> DataFrame:
        return lines.invoice_level_totals(self.classify_line_items)

    @cached_property
    def _booked_versions(self) -> DataFrame:
        return self.classify_line_items.select(*lines.BOOKED_FROM)

    @cached_property
    def _line_item_bookings(self) -> DataFrame:
        return lines.line_item_bookings(self._parted("_booked_versions"), self.hot)

    @cached_property
    def initial_line_item_bookings(self) -> DataFrame:
        return lines.initial_line_item_bookings(self._line_item_bookings)

    @cached_property
    def additional_line_item_bookings(self) -> DataFrame:
        return lines.additional_line_item_bookings(self._line_item_bookings)

    # -- discounts -------------------------------------------------------------------------

    @cached_property
    def _discount_versions(self) -> DataFrame:
        return discounts.discount_versions(
            self.inputs["discount_hist"],
            self.first_payment_approved,
            self.inputs["line_item_hierarchy"],
            self.config,
            self.hot,
        )

    @cached_property
    def _discount_changes(self) -> Split:
        return discounts.discount_changes(self._parted("_discount_versions"), self.hot)

    @cached_property
    def discount_changes(self) -> DataFrame:
        return self._discount_changes.rows()

    @cached_property
    def discount_intervals(self) -> DataFrame:
        return discounts.discount_intervals(self._discount_changes, self.hot).rows()

    @cached_property
    def classify_discounts(self) -> DataFrame:
        return discounts.classify_discounts(self.discount_intervals)

    @property
    def _discounts(self) -> DataFrame:
        needed = [
            "invoice_id",
            "line_item_id",
            "cart_line_item_id",
            discounts.RAW_FPA,
            "discount_hist_updated_at_pt",
            "discount_apply_type_id",
            "discount_amount",
            "is_cancelled",
            "is_initial_discount",
            "is_after_fpa_date",
        ]
        stored = self._shared.get("discounts")
        return stored if stored is not None else self.classify_discounts.select(*needed)

    def _line_item_discounts(self, classified: DataFrame) -> DataFrame:
        schema = self.inputs["line_item_hist"].schema
        types = {d: schema[d].dataType for d in DIMENSIONS}
        return discounts.line_item_discounts(classified, types)

    @cached_property
    def initial_line_item_discounts(self) -> DataFrame:
        rows = self._line_item_discounts(self.classify_discounts)
        return rows.filter(~F.col("is_after_fpa_date"))

    @cached_property
    def additional_line_item_discounts(self) -> DataFrame:
        return self._line_item_discounts(self.classify_discounts).filter("is_after_fpa_date")

    @property
    def _discounts_on_invoices(self) -> DataFrame:
        return discounts.invoice_discounts(self._discounts, self.hot).rows()

    @property
    def _invoice_discounts(self) -> Split:
        if "invoice_discounts" in self._shared:
            return self._by_invoice("invoice_discounts", self._shared["invoice_discounts"])
        return discounts.invoice_discounts(self._discounts, self.hot)

    @cached_property
    def initial_invoice_discounts(self) -> DataFrame:
        rows = discounts.invoice_discounts(self.classify_discounts, self.hot).rows()
        return discounts.initial_invoice_discounts(rows)

    @cached_property
    def additional_invoice_discounts(self) -> DataFrame:
        rows = discounts.invoice_discounts(self.classify_discounts, self.hot).rows()
        return discounts.additional_invoice_discounts(rows)

    # -- line items and their discounts ----------------------------------------------------

    @cached_property
    def combined_bookings(self) -> DataFrame:
        on_lines = self._line_item_bookings.select(*BOOKING_COLUMNS)
        on_discounts = self._line_item_discounts(self._discounts)
        return on_lines.unionByName(on_discounts.select(*BOOKING_COLUMNS))

    @cached_property
    def fill_line_item_dimensions(self) -> DataFrame:
        return self._filled_bookings

    @cached_property
    def _combined_rows(self) -> DataFrame:
        # The order reads columns that get filled, so it works on copies.
        ordered = {f"_by_{c}": F.col(c) for c in DIMENSIONS}
        combined = self.combined_bookings
        if self.hot.within("line_item"):
            combined = combined.repartition("invoice_id")
        return combined.withColumns({"_no_user": F.col("user_id").isNull(), **ordered})

    @cached_property
    def _filled_bookings(self) -> DataFrame:
        order = [f"_by_{c}" if c in DIMENSIONS else c for c in fill_order("_no_user")]
        filled = fill_nearest(
            self._parted("_combined_rows"), "line_item_id", order, DIMENSIONS, self.hot, "line_item"
        )
        return filled.rows().select(*BOOKING_COLUMNS)

    @property
    def _bookings(self) -> DataFrame:
        stored = self._shared.get("bookings")
        return self._filled_bookings if stored is None else stored.drop(*volume.SPREAD)

    # -- invoice discounts -----------------------------------------------------------------

    @cached_property
    def _items(self) -> Split:
        """Shares of line items, parted by invoice like all that is made of them."""
        items = allocation.item_sums(
            self._bookings,
            self._invoice_discounts,
            self.inputs["product_price_point"],
            self.config,
            self.hot,
        )
        return allocation.item_allocation_percentages(items, self.config, self.hot)

    @cached_property
    def item_allocation_percentages(self) -> DataFrame:
        return self._items.rows()

    @cached_property
    def _allocated(self) -> Split:
        if "allocated" in self._shared:
            return self._by_invoice("allocated", self._shared["allocated"])
        return allocation.allocated_invoice_discounts(
            self._items, self._invoice_discounts, self.config, self.hot
        )

    @cached_property
    def allocate_initial_invoice_discounts(self) -> DataFrame:
        rows = self._allocated.rows().filter(~F.col("is_after_fpa_date"))
        return allocation.with_metrics(rows).drop("is_after_fpa_date")

    @cached_property
    def allocate_additional_invoice_discounts(self) -> DataFrame:
        rows = self._allocated.rows().filter("is_after_fpa_date")
        return allocation.with_metrics(rows).drop("is_after_fpa_date")

    # -- credits ---------------------------------------------------------------------------

    @cached_property
    def store_credit_bookings(self) -> DataFrame:
        if "credits" in self._shared:
            return self._shared["credits"].drop(*volume.SPREAD)
        return credits.store_credit_bookings(
            self.inputs["store_credits"],
            self.inputs["line_item"],
            self.first_payment_approved,
            self.inputs["product_price_point"],
            self.config,
            self.hot,
        )

    # -- the ledger ------------------------------------------------------------------------

    @cached_property
    def all_bookings(self) -> DataFrame:
        union = volume.union_of_bookings(
            [self._bookings, self.store_credit_bookings], self._allocated.rows()
        )
        return volume.all_bookings(union)

    @cached_property
    def bookings_grouped(self) -> DataFrame:
        if "ledger" in self._shared:
            return self._shared["ledger"].drop(*volume.READY)
        own = self._shared.get("bookings")
        if own is None:
            own = self._bookings.withColumns(volume.no_spread(self._bookings))
        columns = [*volume.GROUP_KEYS, *volume.SUMMED, *volume.SPREAD]
        credited = self._shared.get("credits")
        if credited is None:
            added = volume.union_of_bookings([self.store_credit_bookings], self._allocated.rows())
        else:
            # Both lie by invoice already: stored credits as they are, allocated discounts once Spark is told so.
            own = own.select(*columns).unionByName(credited.select(*columns))
            added = volume.spread_bookings(self._allocated.rows())
            added = added.withColumns({c: F.lit(None).cast(own.schema[c].dataType) for c in volume.SUMMED})
        added = added.select(*columns)
        if not self.hot.has("line_item"):
            # Bookings lie by invoice or line item already. What is added goes there, and all is grouped in place.
            added = added.repartition(f"{self._lies_by}_id")
        union = own.select(*columns).unionByName(added)
        if credited is not None:
            # All may be columns of stored tables; rows lie by invoice, which none lacks.
            union = by_row(union, "invoice_id", "line_item_id")
        return volume.bookings_grouped(union)

    @cached_property
    def _eligible(self) -> Split:
        return volume.volume_eligibility(
            self._shared.get("ledger", self.bookings_grouped),
            self.inputs["product_price_point"],
            self.config,
            self.hot,
            self._asking,
        )

    @property
    def _asking(self) -> list[DataFrame] | None:
        """All line items and price points of the ledger with their invoices, in tables that are stored.

        Allocated discounts have those of bookings.
        """
        if "credits" not in self._shared:
            return None
        return [self._bookings, self._shared["credits"]]

    @cached_property
    def volume_eligibility(self) -> DataFrame:
        return self._eligible.rows()

    @cached_property
    def _items_counted(self) -> Split:
        return volume.gross_order_item_volume(self._eligible, self.hot)

    @cached_property
    def gross_order_item_volume(self) -> DataFrame:
        return self._items_counted.rows().drop("is_first_order_booking")

    @cached_property
    def _counted(self) -> DataFrame:
        """Bookings with the counters of their line items, and lineage while they lie by line item."""
        lineage = self.inputs["line_item"].select("line_item_id", *LINEAGE)
        items = self._items_counted
        ordinary = lookup_within(
            items.ordinary,
            lineage,
            "line_item_id",
            NO_HOT_KEYS,
            "",
            self.hot.within("line_item"),
            self._asking,
        )
        if items.heavy is None:
            return ordinary
        heavy = lookup(items.heavy, lineage, ["line_item_id"], self.hot, "line_item")
        return ordinary.unionByName(heavy)

    @cached_property
    def gross_order_volume(self) -> DataFrame:
        return volume.gross_order_volume(self._items_counted.rows(), self.hot)

    @cached_property
    def line_item_bookings(self) -> DataFrame:
        """The result: one row per booking, with its id, counters and lineage."""
        third_party = "invoice_has_third_party_gateway_payment"
        gateways = self.third_party_payment_invoices.select("invoice_id", third_party)
        orders = volume.gross_order_volume(self._parted("_counted"), self.hot)
        # Where rows lie by invoice, they meet the invoices' payments.
        ordinary = lookup(orders.ordinary, gateways, ["invoice_id"])
        heavy = orders.heavy
        if heavy is not None:
            heavy = lookup(heavy, gateways, ["invoice_id"], self.hot, "invoice")
        rows = Split(ordinary, heavy).rows()

        def money(name: str):
            return F.col(name).cast("decimal(15,2)").alias(name)

        return rows.select(
            surrogate_key(
                F.col("line_item_id"),
                timestamp_text(F.col("booking_at_pt")),
                F.col("booking_category_detail"),
                F.col("booking_category"),
                F.col("price_point_id"),
            ).alias("booking_id"),
            "invoice_id",
            "line_item_id",
            "cart_line_item_id",
            "subscription_id",
            "user_id",
            "workspace_id",
            "price_point_id",
            FPA,
            "booking_at_pt",
            "booking_category_detail",
            "booking_category",
            "gross_order_volume",
            "gross_order_item_volume",
            money("initial_gbnf"),
            money("initial_gb"),
            money("filing_fee"),
            money("initial_discount_amount"),
            money("additional_discount_amount"),
            F.coalesce(third_party, F.lit(False)).alias(third_party),
            money("gbnf"),
            money("nbnf"),
            money("gb"),
            money("nb"),
            *LINEAGE,
        )

    # -- checks ----------------------------------------------------------------------------

    def data_ready_check(self, as_of: datetime) -> DataFrame:
        return checks.data_ready_check(self.inputs["freshness_source"], as_of, self.config)

    @cached_property
    def bookings_quality(self) -> DataFrame:
        return self.quality_of(self.line_item_bookings)

    def quality_of(self, bookings: DataFrame) -> DataFrame:
        """The quality checks for bookings that may have been written already."""
        return checks.bookings_quality(
            self.inputs, bookings, self._allocated.rows(), self._invoice_discounts.rows(), self.config
        )


__all__ = ["BOOKING_COLUMNS", "BookingsPipeline", "LINEAGE"]
