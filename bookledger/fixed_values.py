"""Fixed values.

Everything in this file is given from outside: the texts, codes and patterns below have to
match what existing reports and source systems use, letter by letter. Nothing else in the
package spells them out.
"""

# --- fixed values: time zones and open-ended bounds -------------------------------------
SOURCE_ZONE = "UTC"
LOCAL_ZONE = "America/Los_Angeles"
OPEN_END = "9999-12-31 00:00:00"
OPEN_START = "1900-01-01 00:00:00"

# --- fixed values: payments -------------------------------------------------------------
PAYMENT_STATUS_APPROVED = "Approved"
PAYMENT_TYPE_PAYMENT = "Payment"

# --- fixed values: store credits --------------------------------------------------------
CREDIT_EVENT_ISSUED = "credit issued"
CREDIT_SOURCE_ID = "4f9e2b5e-c45e-434b-b2b2-126b5a251a9c"

# --- fixed values: products -------------------------------------------------------------
PRODUCT_TYPE_PRODUCT = "Product"
PRODUCT_TYPE_FILING_FEE = "Filing Fee"
SHIPPING_NAME_PATTERN = "%Standard Shipping%"
FREE_PRODUCT_CODE = "7820"

# --- fixed values: how an invoice discount applies (discount_apply_type_id) -------------
APPLY_TO_PRODUCTS = 1
APPLY_TO_EVERYTHING = 2
APPLY_TO_ALL_BUT_FILING_FEES = 3
APPLY_TO_PRODUCTS_AND_STANDARD_SHIPPING = 4

# --- fixed values: booking_category -----------------------------------------------------
LINE_ITEM_BOOKING = "Line Item Booking"
CANCELLED_LINE_ITEM_BOOKING = "Cancelled Line Item Booking"
LINE_ITEM_DISCOUNT = "Line Item Discount"
CANCELLED_LINE_ITEM_DISCOUNT = "Cancelled Line Item Discount"
INVOICE_LEVEL_DISCOUNT = "Invoice Level Discount"
CANCELLED_INVOICE_LEVEL_DISCOUNT = "Cancelled Invoice Level Discount"
LINE_ITEM_CREDIT = "Line Item Credit"
CANCELLED_PATTERN = "cancelled%"

# --- fixed values: booking_category_detail ----------------------------------------------
INITIAL_BOOKING = "Initial Line Item Booking Before FPA"
CANCELLED_INITIAL_BOOKING_BEFORE = "Cancelled Initial Line Item Booking Before FPA"
ADDITIONAL_BOOKING = "Additional Line Item Booking After FPA"
CANCELLED_INITIAL_BOOKING_AFTER = "Cancelled Initial Line Item Booking After FPA"
CANCELLED_ADDITIONAL_BOOKING = "Cancelled Additional Line Item Booking After FPA"
INITIAL_DISCOUNT_BEFORE = "Initial Line Item Discount Before FPA"
CANCELLED_INITIAL_DISCOUNT_BEFORE = "Cancelled Initial Line Item Discount Before FPA"
INITIAL_DISCOUNT_AFTER = "Initial Line Item Discount After FPA"
CANCELLED_INITIAL_DISCOUNT_AFTER = "Cancelled Initial Line Item Discount After FPA"
ADDITIONAL_DISCOUNT = "Additional Line Item Discount After FPA"
CANCELLED_ADDITIONAL_DISCOUNT = "Cancelled Additional Line Item Discount After FPA"
INITIAL_INVOICE_DISCOUNT_BEFORE = "Initial Invoice Level Discount Before FPA"
CANCELLED_INITIAL_INVOICE_DISCOUNT_BEFORE = "Cancelled Initial Invoice Level Discount Before FPA"
CANCELLED_INITIAL_INVOICE_DISCOUNT_AFTER = "Cancelled Initial Invoice Level Discount After FPA"
ADDITIONAL_INVOICE_DISCOUNT = "Additional Invoice Level Discount After FPA"
CANCELLED_ADDITIONAL_INVOICE_DISCOUNT = "Cancelled Additional Invoice Level Discount After FPA"
CREDIT_BEFORE = "Line Item Credit Before FPA"
CREDIT_AFTER = "Line Item Credit After FPA"
