"""Hot keys: find them cheaply, and join or total by key without one task getting them all.

A key column can have one value (often NULL) on a third of all rows. Spark's adaptive
skew join does not cut window partitions, and not every join either, so the operators of
this package ask a ``HotKeys`` first. Without hot keys they use the plain, cheapest plan.

With hot keys a table is parted once (``split_hot``) into rows of ordinary and of hot keys. The ``Split``
goes from operator to operator as long as they work by the same key; each treats either side by its own plan.

``HotKeys`` also knows which keys lie within another one (each line item in one invoice): rows that lie by
the outer key then need no shuffle for the inner one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_KEY, _PIECES, _PIECE = "_hot_key", "_hot_pieces", "_hot_piece"
_ROWS = "_hot_rows"
# Keys are counted by hash value first, of which there are so many.
_HASHES = 4096

# A key counts as hot only if it has more than this part of all rows, whatever the row limit. So there are
# never more hot keys than this, which bounds the list that is broadcast.
MAX_LISTED = 250_000

# More partitions than this cost a shuffle more than they spare its tasks.
MAX_PARTITIONS = 20_000


@dataclass(frozen=True)
class Split:
    """A table in two parts: rows of ordinary keys, and rows of hot keys (None if there are none)."""

    ordinary: DataFrame
    heavy: DataFrame | None = None

    def map(self, step: Callable[[DataFrame], DataFrame]) -> Split:
        """Both parts after a step that needs no other rows of a key, or all of them at most by aggregation."""
        return Split(step(self.ordinary), None if self.heavy is None else step(self.heavy))

    def rows(self) -> DataFrame:
        return self.ordinary if self.heavy is None else self.ordinary.unionByName(self.heavy)


class HotKeys:
    """Values with too many rows for one task, by key domain (invoice, line item, ...).

    ``tables[domain]`` is a small stored table (value, number of rows). The rows of a value are cut
    into pieces of at most ``rows_per_piece``; ``pieces[domain]`` says how many tasks all hot keys need.
    Plans for hot keys read rows of hot keys more than once, so a run may store these beforehand.
    ``nested[domain]`` is (column, domain of the column): each key has one value of that column, never NULL.
    ``rows``: how many rows the domain with most of them has, if they were counted.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame] | None = None,
        rows_per_piece: int = 1,
        pieces: Mapping[str, int] | None = None,
        nested: Mapping[str, tuple[str, str]] | None = None,
        rows: int = 0,
    ):
        self.tables = dict(tables or {})
        self.rows_per_piece = rows_per_piece
        self._pieces_known = dict(pieces or {})
        self.nested = dict(nested or {})
        self.rows = rows

    def has(self, domain: str) -> bool:
        return domain in self.tables

    def within(self, domain: str) -> str | None:
        """The column by which rows of the domain may lie, too; none where one of its values is hot."""
        column, outer = self.nested.get(domain, (None, ""))
        return None if self.has(outer) or self.has(domain) else column

    def grouping(self, key: str, domain: str, columns: list[str] | None = None) -> list[str]:
        """Columns that make the same groups as ``key``; rows that lie by the first need no shuffle.

        columns: those of the rows, which may not have the outer one.
        """
        outer = self.within(domain)
        known = outer is not None and outer != key and (columns is None or outer in columns)
        return [outer, key] if known else [key]

    def with_nested(self, nested: Mapping[str, tuple[str, str]]) -> HotKeys:
        return HotKeys(self.tables, self.rows_per_piece, self._pieces_known, self.nested | dict(nested), self.rows)

    def _pieces(self) -> Column:
        return F.ceil(F.col(_ROWS) / F.lit(self.rows_per_piece)).cast("int")

    def total_pieces(self, domain: str) -> int:
        """How many tasks the rows of all hot keys need at least; counted when the keys are found."""
        if domain not in self._pieces_known:
            self._pieces_known[domain] = self.tables[domain].agg(F.sum(self._pieces())).first()[0]
        return self._pieces_known[domain]

    def counted(self) -> HotKeys:
        for domain in self.tables:
            self.total_pieces(domain)
        return self

    def with_domain(self, domain: str, of: str) -> HotKeys:
        """The same hot keys under one more name."""
        if of not in self.tables:
            return self
        tables = self.tables | {domain: self.tables[of]}
        known = self._pieces_known | {domain: self.total_pieces(of)}
        return HotKeys(tables, self.rows_per_piece, known, self.nested, self.rows)

    def merge(self, other: HotKeys, keep: Callable[[DataFrame], DataFrame]) -> HotKeys:
        """Hot keys of both; the rows of a value add up."""
        tables = dict(self.tables)
        known = dict(self._pieces_known)
        for domain, table in other.tables.items():
            known.pop(domain, None)
            if domain in tables:
                both = tables[domain].unionByName(table)
                table = keep(both.groupBy(_KEY).agg(F.sum(_ROWS).alias(_ROWS)))
            tables[domain] = table
        limit = self.rows_per_piece if self.tables else other.rows_per_piece
        rows = max(self.rows, other.rows)
        return HotKeys(tables, limit, known, self.nested | other.nested, rows).counted()

    def tag(self, df: DataFrame, domain: str, key: str) -> DataFrame:
        """Add the number of pieces of each row's key, NULL for an ordinary key."""
        listed = F.broadcast(self.tables[domain].select(_KEY, self._pieces().alias(_PIECES)))
        return df.join(listed, F.col(key).eqNullSafe(F.col(_KEY)), "left").drop(_KEY)

    def part(self, df: DataFrame, domain: str, key: str, heavy: bool) -> DataFrame:
        """The rows of hot keys, or those of ordinary keys."""
        listed = F.broadcast(self.tables[domain].select(_KEY))
        same = F.col(key).eqNullSafe(F.col(_KEY))
        return df.join(listed, same, "left_semi" if heavy else "left_anti")


NO_HOT_KEYS = HotKeys()


def measure_hot_keys(
    sources: Mapping[str, list[tuple[DataFrame, str]]],
    max_rows: int,
    keep: Callable[[DataFrame], DataFrame],
    times: int = 1,
) -> HotKeys:
    """Values with more than ``max_rows`` rows over all sources of a domain (table, key column).

    ``times``: how many rows later steps make of a row at most. Tables with too few rows have
    no hot keys; for parquet their row counts come from the file footers. Otherwise rows are counted by the
    key's hash value, which shuffles a few thousand numbers a task; no key has more rows than its hash value. Only keys of
    heavy hash values are counted exactly, and the heavy ones are stored. However many there are, all are found.
    """
    found, most = {}, 0
    for domain, columns in sources.items():
        total = times * sum(df.count() for df, _ in columns)
        most = max(most, total)
        if total <= max_rows:
            continue
        limit = max(max_rows, total // MAX_LISTED)
        keys = reduce(DataFrame.unionByName, [df.select(F.col(column).alias(_KEY)) for df, column in columns])
        hashed, rows = F.pmod(F.xxhash64(_KEY), F.lit(_HASHES)), F.count(F.lit(1)) * times
        by_hash = keys.groupBy(hashed.alias("_hash")).agg(rows.alias(_ROWS)).filter(F.col(_ROWS) > limit)
        heavy_hashes = [r["_hash"] for r in by_hash.select("_hash").collect()]
        if not heavy_hashes:
            continue
        counts = keys.filter(hashed.isin(heavy_hashes)).groupBy(_KEY).agg(rows.alias(_ROWS))
        heavy = keep(counts.filter(F.col(_ROWS) > limit))
        if not heavy.isEmpty():
            found[domain] = heavy
    return HotKeys(found, max_rows, rows=most).counted()


def deal_out(spark: SparkSession, rows: int, rows_per_partition: int) -> None:
    """Shuffles and buckets get as many partitions as ``rows`` need, in this session from now on; never fewer than are set.

    With too few of them, tasks sort and sum more rows than their memory holds, and write them to disk time and again.
    """
    setting = "spark.sql.shuffle.partitions"
    needed = min(-(-rows // rows_per_partition), MAX_PARTITIONS)
    if needed > int(spark.conf.get(setting)):
        spark.conf.set(setting, str(needed))


def lies_within(tables: list[tuple[DataFrame, str, str]]) -> bool:
    """Whether over all tables (table, key, outer column) each key, NULL included, has one outer value, never NULL."""
    rows = reduce(
        DataFrame.unionByName,
        [df.select(F.col(key).alias(_KEY), F.col(outer).alias("_outer")) for df, key, outer in tables],
    )
    if not rows.filter(F.col("_outer").isNull()).isEmpty():
        return False
    return rows.groupBy(_KEY).agg((F.min("_outer") != F.max("_outer")).alias("_spans")).filter("_spans").isEmpty()


def join_where_rows_lie(spark: SparkSession) -> None:
    """Joins on several columns leave rows that lie by one of them where they are, in this session from now on.

    Spark's default shuffles both sides by all columns of the join instead. Results don't depend on it.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def by_row(union: DataFrame, *keys: str) -> DataFrame:
    """``union``, none of whose rows lacks all ``keys``, so read that Spark keeps the way in which its parts lie.

    Where nothing but columns of stored tables is read, Spark 4.1 unites batches, not rows: it strings the parts'
    partitions together, although the plan above counts on rows of a key being in one. A filter works on rows. One that asks
    for a single key would hide the key's partitioning instead.
    """
    return union.filter(reduce(Column.__or__, [F.col(k).isNotNull() for k in keys]))


def listed_hot_keys(
    counts: Mapping[str, DataFrame], max_rows: int, keep: Callable[[DataFrame], DataFrame]
) -> HotKeys:
    """Hot keys from counts that are known already: (key, rows) by domain."""
    found = {}
    for domain, df in counts.items():
        key, rows = df.columns
        table = df.select(F.col(key).alias(_KEY), F.col(rows).cast("long").alias(_ROWS))
        total = table.agg(F.sum(_ROWS)).first()[0] or 0
        heavy = keep(table.filter(F.col(_ROWS) > max(max_rows, total // MAX_LISTED)))
        if not heavy.isEmpty():
            found[domain] = heavy
    return HotKeys(found, max_rows).counted()


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
    hot_on: str | None = None,
    null_safe: bool = False,
    how: str = "left",
) -> DataFrame:
    """Join ``right`` to ``left`` on equal column names.

    Whether ``right`` is broadcast is left to Spark's size check. If the domain has hot
    keys, the left rows of a hot key are spread over its pieces, and the matching right
    rows are repeated once per piece. ``null_safe`` lets NULL keys match each other.

    A row's piece follows from its values and the partition it lies in: equal rows of different
    partitions are spread, too, and a task that runs again deals its rows as before.
    """
    keys = list(on)
    if hot.has(domain):
        key = hot_on or on[0]
        pieces = F.coalesce(F.col(_PIECES), F.lit(1))
        dealt = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in left.columns])
        spread = F.pmod(dealt, pieces).cast("int")
        left = hot.tag(left, domain, key).withColumn(_PIECE, spread).drop(_PIECES)
        right = (
            hot.tag(right, domain, key)
            .withColumn(_PIECE, F.explode(F.sequence(F.lit(0), pieces - 1)))
            .drop(_PIECES)
        )
        keys = [*on, _PIECE]
    if null_safe:
        renamed = {k: f"_right_{k}" for k in keys}
        right = right.withColumnsRenamed(renamed)
        match = None
        for k, r in renamed.items():
            same = F.col(k).eqNullSafe(F.col(r))
            match = same if match is None else match & same
        joined = left.join(right, match, how).drop(*renamed.values())
    else:
        joined = left.join(right, keys, how)
    return joined.drop(_PIECE)


def lookup_within(
    left: DataFrame,
    right: DataFrame,
    on: str,
    hot: HotKeys,
    domain: str,
    within: str | None,
    asking: list[DataFrame] | None = None,
) -> DataFrame:
    """``lookup`` on one column for rows that lie by another one, ``within``, which is never NULL.

    The rows stay where they lie. Their keys are told apart there, narrow as they are, fetch what ``right`` has, and
    go back with it. Without ``within`` the rows go to the key. ``asking``: tables that are cheaper to read than ``left``, lie
    like it and have both columns of all its rows at least. Each adds what those before it lack, so that none has to move for that.
    """
    if within is None:
        return lookup(left, right, [on], hot, domain)
    asked = None
    for rows in asking or [left]:
        keys = rows.select(within, on).filter(F.col(on).isNotNull()).distinct()
        asked = keys if asked is None else asked.unionByName(keys.join(asked, [within, on], "left_anti"))
    fetched = asked.join(right, on).repartition(within)
    joined = left.join(fetched, [within, on], "left")
    return joined.select(on, *[c for c in [*left.columns, *right.columns] if c != on])


def split_hot(
    df: DataFrame, key: str, hot: HotKeys, domain: str, heavy: DataFrame | None = None
) -> Split:
    """``df`` in two parts; ``heavy``: its rows of hot keys, where they are stored already."""
    if not hot.has(domain):
        return Split(df)
    ordinary = hot.part(df, domain, key, heavy=False)
    return Split(ordinary, hot.part(df, domain, key, heavy=True) if heavy is None else heavy)


def by_key(
    df: DataFrame | Split,
    key: str,
    hot: HotKeys,
    domain: str,
    plain: Callable[[DataFrame], DataFrame],
    spread: Callable[[DataFrame], DataFrame],
) -> DataFrame | Split:
    """``plain`` on rows of ordinary keys, ``spread`` on rows of hot ones; returns what it was given."""
    split = df if isinstance(df, Split) else split_hot(df, key, hot, domain)
    heavy = None if split.heavy is None else spread(split.heavy)
    done = Split(plain(split.ordinary), heavy)
    return done if isinstance(df, Split) else done.rows()


def each_row(df: DataFrame | Split, step: Callable[[DataFrame], DataFrame]) -> DataFrame | Split:
    return df.map(step) if isinstance(df, Split) else step(df)


def total_over(
    df: DataFrame | Split,
    keys: list[str],
    totals: Mapping[str, Column],
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
    hot_on: str | None = None,
) -> DataFrame | Split:
    """Add aggregates over all rows with the same ``keys``; NULL keys are one group.

    Ordinary keys: a window, which needs one shuffle and reads the input once. Hot keys:
    partial aggregation, then a spread join back.
    """

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys)
        return rows.withColumns({name: agg.over(w) for name, agg in totals.items()})

    def spread(rows: DataFrame) -> DataFrame:
        grouped = rows.groupBy(*keys).agg(*[agg.alias(name) for name, agg in totals.items()])
        return lookup(rows, grouped, keys, hot, domain, hot_on, null_safe=True)

    return by_key(df, hot_on or keys[0], hot, domain, plain, spread)


def co_locate(split: Split, key: str) -> Split:
    """Bring equal ordinary keys together once, so that following steps on the key need no shuffle.

    For hot keys this would be the mistake to avoid, so their rows stay where they are.
    """
    return Split(split.ordinary.repartition(key), split.heavy)
