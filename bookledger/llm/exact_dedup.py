"""Exact deduplication by skew-safe combining, on built-in functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookledger.llm.common import keep, partitions, spread_lookup

WHITE_SPACE = " \t\n\x0b\f\r"

# A candidate's rank is one decimal, longest text first, then smallest id, so that aggregation
# buffers keep a fixed width and Spark can aggregate by hashing: length * ID_SPAN + (MAX_ID - id + 1),
# the second part 0 for a null id.
ID_SPAN = 10**20
MAX_ID = 2**63 - 1


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for character in WHITE_SPACE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def _number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(21,0)")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    by_id = F.coalesce(_number(MAX_ID + 1) - doc_id.cast("decimal(20,0)"), _number(0))
    return (n_chars.cast("decimal(11,0)") * _number(ID_SPAN) + by_id).cast("decimal(38,0)")


def _keep_id(rank: Column) -> Column:
    by_id = F.pmod(rank, _number(ID_SPAN))
    return F.when(by_id > 0, (_number(MAX_ID + 1) - by_id).cast("long"))


def _n_chars(rank: Column) -> Column:
    return ((rank - F.pmod(rank, _number(ID_SPAN))) / _number(ID_SPAN)).cast("long")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    digest: Callable[[Column], Column] = sha256,
    row_id: str | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``.

    Rows are equal if their normalised texts are; of equal rows the one with the most code points
    stays, then the one with the smallest id. Copies are removed within each task, then among
    the tasks that share a salt, then among the salts; the grouping key of all three holds the
    normalised text itself, so a digest only directs rows and never decides. A group of any size
    sends one row a task to the first shuffle and one row a salt to the second.

    Null texts count as empty, null ids rank last. Rows that repeat id and length of the staying
    row are that document again: all of them are ``kept``. If a column of row keys is named, it is
    passed on as ``row_id``, and only one of these rows is ``kept``. An empty table gives no rows;
    other columns are ignored.
    """
    key = [F.col(row_id).cast("long").alias("row_id")] if row_id else []
    content = normalised(F.col(text))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        content.alias("content"),
        F.coalesce(F.length(text), F.lit(0)).alias("n_chars"),
        *key,
    ).withColumn("digest", digest(F.col("content")))
    own_rank = _rank(F.col("n_chars"), F.col("doc_id"))
    # The row of the highest rank, any one of several; its key is stored with the group.
    first_key = [F.max_by("row_id", own_rank).alias("keep_row")] if row_id else []
    merged_key = [F.max_by("keep_row", "rank").alias("keep_row")] if row_id else []
    keep_row = ["keep_row"] if row_id else []
    passed = ["row_id"] if row_id else []

    salts = math.ceil(math.sqrt(partitions(docs.sparkSession))) + 1
    merged = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "content")
        .agg(F.max(own_rank).alias("rank"), F.count(F.lit(1)).alias("size"), *first_key)
        # By digest alone: texts that differ under one digest then meet in one task, too.
        .repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("rank").alias("rank"), F.sum("size").alias("group_size"), *merged_key)
    )
    texts = F.expr("count(1) over (partition by digest)")
    classes = keep(
        merged.withColumn("texts", texts).select(
            "digest", "rank", "group_size", *keep_row, F.when(F.col("texts") > 1, F.col("content")).alias("content")
        )
    )
    plain = classes.where(F.col("content").isNull()).drop("content")
    clashing = classes.where(F.col("content").isNotNull())
    if clashing.isEmpty():
        joined = spread_lookup(rows.drop("content"), plain, "digest", "group_size")
    else:
        # Different texts under one digest: those rows are told apart by content.
        same = F.struct("digest", "content")
        own = rows.join(clashing.select("digest").distinct(), "digest", "left_semi")
        rest = rows.join(clashing.select("digest").distinct(), "digest", "left_anti")
        joined = spread_lookup(rest.drop("content"), plain, "digest", "group_size").unionByName(
            spread_lookup(
                own.select("doc_id", "n_chars", "digest", *passed, same.alias("same")),
                keep(clashing.select(same.alias("same"), "rank", "group_size", *keep_row)),
                "same",
                "group_size",
            ).drop("same")
        )
    rank = F.col("rank")
    stays = F.col("doc_id").eqNullSafe(_keep_id(rank)) & (F.col("n_chars") == _n_chars(rank))
    return joined.select(
        "doc_id",
        _keep_id(rank).alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("keep_row") if row_id else stays).alias("kept"),
        "digest",
        *passed,
    )
