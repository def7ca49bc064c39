"""Values from the neighbouring rows of the same key, in an order.

Order columns sort ascending with NULLS LAST everywhere. The caller ends them with
tie-breaking columns, so that the result does not depend on the physical row order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookledger.functions import order_rank
from bookledger.operators.skew import NO_HOT_KEYS, HotKeys, Split, by_key, lookup

_RUN, _FIRST, _LAST, _EDGE = "_run", "_run_first", "_run_last", "_run_edge"
_NTH = "_nth_of_equal"


def _asc(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _over(keys: list[str], order: list[str]) -> str:
    by = ", ".join(f"`{k}`" for k in keys)
    sort = ", ".join(f"`{c}` ASC NULLS LAST" for c in order)
    return f"OVER (PARTITION BY {by} ORDER BY {sort})"


def _skipping_nulls(function: str, column: str, keys: list[str], order: list[str]) -> Column:
    return F.expr(f"{function}(`{column}`) IGNORE NULLS {_over(keys, order)}")


def neighbours(
    df: DataFrame | Split,
    key: str,
    order: list[str],
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
) -> DataFrame | Split:
    """Add the value of a column on the previous / following row (output name -> column)."""
    previous, following = dict(previous or {}), dict(following or {})

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*hot.grouping(key, domain, rows.columns)).orderBy(*_asc(order))
        values = {out: F.lag(c).over(w) for out, c in previous.items()}
        values |= {out: F.lead(c).over(w) for out, c in following.items()}
        return rows.withColumns(values)

    def in_runs(rows: DataFrame) -> DataFrame:
        # A wrapped value is never NULL, so "nearest non-NULL" is "directly next to".
        sources = dict.fromkeys([*previous.values(), *following.values()])
        wrapped = {c: f"_wrapped_{c}" for c in sources}
        found = _nearest_in_runs(
            rows.withColumns({w: F.struct(F.col(c).alias("v")) for c, w in wrapped.items()}),
            key,
            order,
            {out: wrapped[c] for out, c in previous.items()},
            {out: wrapped[c] for out, c in following.items()},
            hot.total_pieces(domain),
        )
        outs = [*previous, *following]
        return found.withColumns({o: F.col(o)["v"] for o in outs}).drop(*wrapped.values())

    return by_key(df, key, hot, domain, plain, in_runs)


def fill_nearest(
    df: DataFrame | Split,
    key: str,
    order: list[str],
    columns: list[str],
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
) -> DataFrame | Split:
    """Fill NULLs with the nearest earlier non-NULL value of the key, else the nearest later."""

    def filled(rows: DataFrame, before: Mapping[str, Column], after: Mapping[str, Column]):
        return rows.withColumns(
            {c: F.coalesce(F.col(c), before[c], after[c]) for c in columns}
        )

    def plain(rows: DataFrame) -> DataFrame:
        # Offset functions walk each partition once; a frame "current row to the end" would
        # be re-read for every row.
        keys = hot.grouping(key, domain, rows.columns)
        return filled(
            rows,
            {c: _skipping_nulls("lag", c, keys, order) for c in columns},
            {c: _skipping_nulls("lead", c, keys, order) for c in columns},
        )

    def in_runs(rows: DataFrame) -> DataFrame:
        before = {f"_before_{c}": c for c in columns}
        after = {f"_after_{c}": c for c in columns}
        found = _nearest_in_runs(rows, key, order, before, after, hot.total_pieces(domain))
        return filled(
            found,
            {c: F.col(f"_before_{c}") for c in columns},
            {c: F.col(f"_after_{c}") for c in columns},
        ).drop(*before, *after)

    return by_key(df, key, hot, domain, plain, in_runs)


def _nearest_in_runs(
    df: DataFrame,
    key: str,
    order: list[str],
    before: Mapping[str, str],
    after: Mapping[str, str],
    pieces: int,
) -> DataFrame:
    """Nearest earlier / later non-NULL value when one key has too many rows for a task.

    1. Range partitioning by (key, order) cuts each key into runs of consecutive rows, as
       many as the rows need ``pieces``; twice that, since the ranges come from a sample.
    2. Inside a run the nearest values are found directly.
    3. The first and last row of every run (two per run) meet in one small group per key,
       where each run learns what its neighbours know.
    4. Every run hands that to its rows.
    """
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * pieces)
    runs = df.repartitionByRange(
        partitions, F.col(key).asc_nulls_last(), *_asc(order)
    ).withColumn(_RUN, F.spark_partition_id())

    run_keys = [key, _RUN]
    in_run = Window.partitionBy(*run_keys).orderBy(*_asc(order))
    inside = {o: _skipping_nulls("lag", c, run_keys, order) for o, c in before.items()}
    inside |= {o: _skipping_nulls("lead", c, run_keys, order) for o, c in after.items()}
    inside[_FIRST] = F.lag(F.lit(1)).over(in_run).isNull()
    inside[_LAST] = F.lead(F.lit(1)).over(in_run).isNull()
    runs = runs.withColumns(inside)

    edge = F.when(F.col(_FIRST) | F.col(_LAST), F.lit(-1)).otherwise(F.col(_RUN))
    known = {f"_known_{o}": F.when(F.col(_LAST), F.coalesce(c, o)) for o, c in before.items()}
    known |= {f"_known_{o}": F.when(F.col(_FIRST), F.coalesce(c, o)) for o, c in after.items()}
    runs = runs.withColumns({_EDGE: edge, **known})

    edge_keys = [key, _EDGE]
    carried = {
        f"_carried_{o}": F.when(
            F.col(_FIRST), _skipping_nulls("lag", f"_known_{o}", edge_keys, order)
        )
        for o in before
    }
    carried |= {
        f"_carried_{o}": F.when(
            F.col(_LAST), _skipping_nulls("lead", f"_known_{o}", edge_keys, order)
        )
        for o in after
    }
    runs = runs.withColumns(carried)

    whole_run = Window.partitionBy(*run_keys)
    outs = [*before, *after]
    result = {
        o: F.coalesce(F.col(o), F.first(f"_carried_{o}", ignorenulls=True).over(whole_run))
        for o in outs
    }
    helpers = [f"_known_{o}" for o in outs] + [f"_carried_{o}" for o in outs]
    return runs.withColumns(result).drop(_RUN, _FIRST, _LAST, _EDGE, *helpers)


def first_where(
    df: DataFrame | Split,
    key: str,
    order: list[str],
    flags: Mapping[str, str],
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
) -> DataFrame | Split:
    """For each (output -> condition column): 1 on the key's first row where it holds, else 0.

    One row a key is marked, also where rows are equal in all order columns; which of these is
    left open.
    """

    def plain(rows: DataFrame) -> DataFrame:
        so_far = (
            Window.partitionBy(*hot.grouping(key, domain, rows.columns))
            .orderBy(*_asc(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return rows.withColumns(
            {
                out: F.when(
                    F.col(c) & (F.count(F.when(F.col(c), 1)).over(so_far) == 1), 1
                ).otherwise(0)
                for out, c in flags.items()
            }
        )

    def spread(rows: DataFrame) -> DataFrame:
        rank = order_rank(order)
        firsts = rows.groupBy(key).agg(
            *[F.min(F.when(F.col(c), rank)).alias(f"_first_{out}") for out, c in flags.items()]
        )
        joined = lookup(rows, firsts, [key], hot, domain, null_safe=True)
        # Of equal rows for which the condition holds one is marked.
        nth = {
            f"{_NTH}_{out}": F.row_number().over(Window.partitionBy(key, *order, c).orderBy(F.lit(0)))
            for out, c in flags.items()
        }
        first = {
            out: F.col(c) & rank.eqNullSafe(F.col(f"_first_{out}")) & (F.col(f"{_NTH}_{out}") == 1)
            for out, c in flags.items()
        }
        return (
            joined.withColumns(nth)
            .withColumns({out: F.when(holds, 1).otherwise(0) for out, holds in first.items()})
            .drop(*nth, *[f"_first_{out}" for out in flags])
        )

    return by_key(df, key, hot, domain, plain, spread)


def last_by_group(
    df: DataFrame | Split,
    key: str,
    group: str,
    order: list[str],
    value: str,
    out: str,
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
    by_group: tuple[str, str] | None = None,
) -> DataFrame | Split:
    """Add the ``value`` (never NULL) of the last row of each (key, boolean ``group``).

    by_group: columns that hold the value only where the group is true, and only where it is false, if there are such;
    then rows of ordinary keys get no column before their window.
    """
    of_group = (
        [F.col(c) for c in by_group]
        if by_group
        else [F.when(c, F.col(value)) for c in (F.col(group), ~F.col(group))]
    )

    def plain(rows: DataFrame) -> DataFrame:
        # Both groups of a key are read off one window, so the sort is shared with other
        # operators on the same key and order.
        whole = (
            Window.partitionBy(*hot.grouping(key, domain, rows.columns))
            .orderBy(*_asc(order))
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )

        last, last_of_others = (F.last(c, ignorenulls=True).over(whole) for c in of_group)
        return rows.withColumn(out, F.when(F.col(group), last).otherwise(last_of_others))

    def spread(rows: DataFrame) -> DataFrame:
        lasts = rows.groupBy(key, group).agg(F.max_by(value, order_rank(order)).alias(out))
        return lookup(rows, lasts, [key, group], hot, domain, hot_on=key, null_safe=True)

    return by_key(df, key, hot, domain, plain, spread)
