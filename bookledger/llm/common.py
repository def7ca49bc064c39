"""Helpers that several operators share: kept tables, skew-safe lookups, plain text helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookledger.sources.sinks import remove_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A table is broadcast only after it has been counted and has at most so many (narrow) rows.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only where that is unset (a local session, as in tests) a temporary folder takes its place;
    a cluster without the setting is an error, because its machines share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="bookledger-")
    return f"{base.rstrip('/')}/bookledger-llm-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Writes a table that several steps read, and cuts its lineage; it survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Kept tables of one run below one shared folder.

    A table that later ones have replaced can be dropped early; ``remove`` drops all of them, once nothing reads
    them any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = shared_folder(spark)
        self._kept = 0

    def keep(self, df: DataFrame) -> DataFrame:
        return self.keep_at(df)[0]

    def keep_at(self, df: DataFrame) -> tuple[DataFrame, str]:
        """The kept table and its folder."""
        self._kept += 1
        path = f"{self.root}/{self._kept:03d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        remove_folder(self.spark, path)

    def remove(self) -> None:
        remove_folder(self.spark, self.root)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a kept table that has been counted; larger tables stay unhinted."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread_lookup(rows: DataFrame, lookup: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` left-joined with ``lookup``, whose column ``size`` counts the rows of each key.

    A key with more rows than half a mean partition is cut into pieces. At most two such keys
    a partition can exist, which bounds the list of them that is broadcast to the rows; the
    lookup's row is repeated once for each piece. ``lookup`` has one row a key and is kept.
    """
    parts = partitions(rows.sparkSession)
    total = lookup.agg(F.sum(size)).first()[0] or 0
    limit = max(100, total // (2 * parts))
    pieces = F.ceil(F.col(size) / F.lit(limit)).cast("int")
    hot = lookup.where(F.col(size) > limit).select(key, pieces.alias("_pieces"))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_piece",
        F.coalesce(F.expr("cast(pmod(monotonically_increasing_id(), _pieces) as int)"), F.lit(0)),
    )
    count = F.when(F.col(size) > limit, pieces).otherwise(F.lit(1))
    repeated = lookup.withColumn("_piece", F.explode(F.sequence(F.lit(0), count - 1)))
    return dealt.join(repeated, [key, "_piece"], "left").drop("_piece", "_pieces")
