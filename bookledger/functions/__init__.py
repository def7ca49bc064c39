from bookledger.functions.columns import (
    AMOUNT,
    SHARE,
    div0,
    greatest_strict,
    order_rank,
    signed,
    sum_money,
    surrogate_key,
    timestamp_text,
    to_local,
    ts,
)

__all__ = [
    "AMOUNT",
    "SHARE",
    "div0",
    "greatest_strict",
    "order_rank",
    "signed",
    "sum_money",
    "surrogate_key",
    "timestamp_text",
    "to_local",
    "ts",
]
