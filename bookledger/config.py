"""Settings of one pipeline run."""

from __future__ import annotations

from dataclasses import dataclass

from bookledger import fixed_values as fv


@dataclass(frozen=True)
class BookingsConfig:
    source_zone: str = fv.SOURCE_ZONE
    local_zone: str = fv.LOCAL_ZONE
    credit_source_id: str = fv.CREDIT_SOURCE_ID
    free_product_code: str = fv.FREE_PRODUCT_CODE

    # An initial invoice discount is booked once per discount row of the invoice, although
    # the allocated amount already covers all of them. True books it once.
    dedupe_initial_allocation: bool = False

    # discount_apply_type_id of each rule, and the products that count as standard shipping.
    apply_to_products: int = fv.APPLY_TO_PRODUCTS
    apply_to_everything: int = fv.APPLY_TO_EVERYTHING
    apply_to_all_but_filing_fees: int = fv.APPLY_TO_ALL_BUT_FILING_FEES
    apply_to_products_and_standard_shipping: int = fv.APPLY_TO_PRODUCTS_AND_STANDARD_SHIPPING
    shipping_name_pattern: str = fv.SHIPPING_NAME_PATTERN

    # A key with more rows than this is "hot": its rows are cut into pieces of about this
    # size instead of meeting in one task. It decides on the plan only, never on the result.
    max_rows_per_task: int = 2_000_000

    # Shuffles get a partition for so many rows of the inputs, counted with what bookings make of them, unless the
    # session asks for more partitions. It decides on the plan only, too.
    rows_per_partition: int = 600_000
