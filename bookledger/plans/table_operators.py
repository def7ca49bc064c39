"""The reusable operators on their own, over whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookledger.config import BookingsConfig
from bookledger.functions import surrogate_key, timestamp_text
from bookledger.operators import allocation, history, ordered
from bookledger.operators.skew import lookup, measure_hot_keys
from bookledger.sources.driver_tables import DriverTables
from bookledger.sources.sinks import Storage, session_folder


def _versions(tables: DriverTables) -> DataFrame:
    return tables.lines().select(
        "line_item_id", "updated", "price_point_id", "l_returnflag", "price"
    )


def _tables(spark: SparkSession, folder: str) -> DriverTables:
    tables = DriverTables(spark, folder, BookingsConfig())
    tables.measure(_keep(spark))
    return tables


def _keep(spark: SparkSession):
    return Storage(spark, session_folder(spark)).keep


def keep_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Order line versions in which the return flag changed."""
    tables = _tables(spark, folder)
    return history.keep_changes(
        _versions(tables),
        "line_item_id",
        ["updated", "price_point_id"],
        {"previous_flag": ("l_returnflag", "l_returnflag")},
        tables.hot_keys,
        "line_item",
    )


def validity_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """From when to when each version of an order line was the current one."""
    tables = _tables(spark, folder)
    return history.add_validity(
        _versions(tables),
        "line_item_id",
        "updated",
        ["price_point_id"],
        "started_at",
        "expires_at",
        tables.hot_keys,
        "line_item",
    )


def fill_nearest_non_null(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the user's nearest purchase value: the last one before, else the next."""
    tables = DriverTables(spark, folder, BookingsConfig())
    events = tables.read("events").select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value"),
    )
    config = tables.config
    hot = measure_hot_keys(
        {"user": [(tables.read("events"), "user_id")]}, config.max_rows_per_task, _keep(spark)
    )
    return ordered.fill_nearest(
        events, "user_id", ["ts", "event_id"], ["purchase_value"], hot, "user"
    )


def allocate_by_share(spark: SparkSession, folder: str) -> DataFrame:
    """Each order's total spread over its lines that were not returned, by price."""
    tables = _tables(spark, folder)
    hot = tables.hot_keys
    lines = tables.lines().select(
        "invoice_id",
        "line_item_id",
        "updated",
        "price",
        (F.col("l_returnflag") != "R").alias("takes_part"),
    )
    orders = tables.read("orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_total"),
    )
    shares = allocation.share_of_group(
        lookup(lines, orders, ["invoice_id"], hot, "invoice"),
        "invoice_id",
        {"share": ("price", "takes_part")},
        hot,
        "invoice",
    )
    return allocation.allocate(shares, {"allocated": ("share", "order_total")})


def order_surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    """A stable text id per order."""
    return (
        DriverTables(spark, folder, BookingsConfig())
        .read("orders")
        .select(
            "o_orderkey",
            surrogate_key(
                F.col("o_orderkey"),
                timestamp_text(F.col("o_orderdate")),
                F.nullif(F.col("o_orderstatus"), F.lit("P")),
            ).alias("order_key"),
        )
    )
