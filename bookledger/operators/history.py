"""Operators on history tables: one row per version of an entity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookledger.operators.ordered import neighbours
from bookledger.operators.skew import NO_HOT_KEYS, HotKeys, Split, each_row


def keep_changes(
    df: DataFrame | Split,
    key: str,
    order: list[str],
    tracked: Mapping[str, tuple[str, str]],
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
) -> DataFrame | Split:
    """Keep versions in which a tracked value differs from the version before.

    ``tracked`` maps the output column for the previous value to (previous value's column,
    compared column). A version is kept if any previous value is NULL, which covers the
    first version, or differs.
    """
    with_previous = neighbours(
        df, key, order, previous={out: src for out, (src, _) in tracked.items()},
        hot=hot, domain=domain,
    )
    changed = F.lit(False)
    for out, (_, now) in tracked.items():
        changed = changed | F.col(out).isNull() | (F.col(now) != F.col(out))
    return each_row(with_previous, lambda rows: rows.filter(changed))


def add_validity(
    df: DataFrame | Split,
    key: str,
    at: str,
    ties: list[str],
    started: str,
    expires: str,
    hot: HotKeys = NO_HOT_KEYS,
    domain: str = "",
) -> DataFrame | Split:
    """Validity of each version: from its own time to the time of the next version."""
    return neighbours(
        each_row(df, lambda rows: rows.withColumn(started, F.col(at))), key, [at, *ties], following={expires: at},
        hot=hot, domain=domain,
    )
