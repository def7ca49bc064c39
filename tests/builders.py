"""Hand-written input rows: every column has a default, a test names what matters."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import types as T

from bookledger import fixed_values as fv
from bookledger.config import BookingsConfig
from bookledger.operators.skew import NO_HOT_KEYS
from bookledger.plans.pipeline import BookingsPipeline
from bookledger.sources.contracts import CONTRACTS
from bookledger.sources.inputs import BookingsInputs

TYPES = {
    "id": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal": T.DecimalType(15, 2),
}
# Midnight UTC on 10 January 2024 is 16:00 the day before in Los Angeles.
DAY0 = datetime(2024, 1, 10)


def at(days, hours=0):
    return DAY0 + timedelta(days=days, hours=hours)


def pt(moment):
    """Los Angeles wall clock of a winter instant."""
    return moment and moment - timedelta(hours=8)


def money(value):
    return None if value is None else Decimal(str(value))


def payment_hist(invoice_id=1, settled=at(0), status=fv.PAYMENT_STATUS_APPROVED,
                 kind=fv.PAYMENT_TYPE_PAYMENT):
    return dict(invoice_id=invoice_id, transaction_settled_at_utc=settled,
                transaction_status=status, transaction_type=kind)


def line(hist_id, updated, line_item_id=11, invoice_id=1, amount=100, cancelled=False,
         created=None, price_point_id=5, user_id=7, **more):
    created = created or updated
    row = dict(
        line_item_hist_id=hist_id, line_item_id=line_item_id, invoice_id=invoice_id,
        cart_line_item_id=11, is_cancelled=cancelled, line_item_updated_at_utc=updated,
        line_item_updated_at_pt=pt(updated), line_item_created_at_utc=created,
        line_item_created_at_pt=pt(created), price_point_id=price_point_id, user_id=user_id,
        amount=money(amount), is_current_record=False,
    )
    return row | more


def discount(hist_id, updated, discount_id=None, line_item_id=None, invoice_id=1, amount=10,
             cancelled=False, created=None, rule=2):
    return dict(
        discount_hist_id=hist_id, discount_id=discount_id or hist_id,
        invoice_line_id=line_item_id, invoice_id=invoice_id, discount_apply_type_id=rule,
        discount_amount=money(amount), is_cancelled=cancelled,
        discount_hist_updated_at_utc=updated, discount_created_at_utc=created or updated,
    )


def credit(event, amount=5, invoice_id=1, line_item_id=11, event_type=fv.CREDIT_EVENT_ISSUED,
           source_id=fv.CREDIT_SOURCE_ID):
    return dict(invoice_id=invoice_id, invoice_line_id=line_item_id,
                event_occurred_at_utc=event, amount=money(amount), event_type=event_type,
                source_id=source_id)


PRODUCT = dict(price_point_id=5, product_type="Product", product_name="Plan",
               is_filing_fee=False, source_price_point_id="pp5")
FEE = dict(price_point_id=6, product_type="Filing Fee", product_name="Fee",
           is_filing_fee=True, source_price_point_id="pp6")
SHIPPING = dict(price_point_id=8, product_type="Shipping",
                product_name="Standard Shipping box", is_filing_fee=False,
                source_price_point_id="pp8")
FREE = dict(price_point_id=9, product_type="Product", product_name="Free",
            is_filing_fee=False, source_price_point_id=fv.FREE_PRODUCT_CODE)
UNTYPED = dict(price_point_id=10, product_type=None, product_name=None, is_filing_fee=None,
               source_price_point_id=None)
PRODUCTS = [PRODUCT, FEE, SHIPPING, FREE, UNTYPED]


def table(spark, name, rows):
    schema = T.StructType([T.StructField(c, TYPES[k]) for c, k in CONTRACTS[name].items()])
    return spark.createDataFrame([tuple(r.get(c) for c in CONTRACTS[name]) for r in rows], schema)


def pipeline(spark, config=None, **rows):
    rows.setdefault("product_price_point", PRODUCTS)
    rows.setdefault(
        "price_point",
        [dict(price_point_id=p["price_point_id"], is_filing_fee=p["is_filing_fee"])
         for p in PRODUCTS],
    )
    tables = {name: table(spark, name, rows.get(name, [])) for name in CONTRACTS}
    return BookingsPipeline(BookingsInputs(spark, tables, config or BookingsConfig(), NO_HOT_KEYS))


def rows(df, *columns):
    """Sorted rows, with amounts as floats for easy comparison."""
    out = []
    for r in df.select(*columns).collect():
        out.append(tuple(float(v) if isinstance(v, Decimal) else v for v in r))
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v) for v in t))
