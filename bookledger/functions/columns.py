"""Column helpers. All are built from JVM-side functions, so they stay in generated code."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Booking amounts while they are still sums of two-digit money.
AMOUNT = "decimal(18,2)"
# A part of a whole. Eight digits; 16 + 21 + 1 = 38 keeps share x amount exact.
SHARE = "decimal(16,8)"


def ts(text: str) -> Column:
    """A wall-clock timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def to_local(col: Column, source_zone: str, local_zone: str) -> Column:
    return F.convert_timezone(F.lit(source_zone), F.lit(local_zone), col)


def greatest_strict(a: Column, b: Column) -> Column:
    """Greatest of two values, NULL if either is NULL (Spark's own skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def div0(a: Column, b: Column) -> Column:
    """a / b as an eight-digit share; 0 for b = 0, NULL if either is NULL."""
    ratio = (a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))).cast(SHARE)
    return F.when(a.isNotNull() & (b == 0), F.lit(0).cast(SHARE)).otherwise(ratio)


def sum_money(amount: Column) -> Column:
    """Sum of two-digit money. Adding whole cents is much cheaper than adding decimals."""
    cents = F.sum((amount * 100).cast("bigint"))
    return (cents * F.lit(Decimal("0.01"))).cast(AMOUNT)


def signed(amount: Column, negative: Column) -> Column:
    """-amount where ``negative`` is true, amount otherwise (also for NULL)."""
    return F.when(negative, -amount).otherwise(amount)


def timestamp_text(col: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss.SSS' of a wall clock, independent of the session time zone."""
    text = col.cast("string")
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 19), F.lit("."), millis)


def surrogate_key(*cols: Column) -> Column:
    """md5 over the texts of the columns joined by '-', NULL counting as empty text."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *texts))


def order_rank(columns: list[str]) -> Column:
    """One comparable value per row that sorts like ``columns`` ascending, NULLS LAST."""
    parts = []
    for i, name in enumerate(columns):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts)
