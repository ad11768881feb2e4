"""One row per key: keep-first, pick-a-winner and latest-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nulls_last(*cols: str | Column) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
               ties: Sequence[str] | None = None) -> DataFrame:
    """The first row of every key, ties broken by ``ties`` (default: all other columns).

    Spark turns the rank filter into a per-partition group limit, so at most one row per key
    and map task reaches the shuffle, however many copies a key has.
    """
    if ties is None:
        named = {c for c in order if isinstance(c, str)} | set(keys)
        ties = [c for c in df.columns if c not in named]
    by = [nulls_last(c)[0] if isinstance(c, str) else c for c in order] + nulls_last(*ties)
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    """Newest row of every key, smallest id first among equals; rows without a time come last."""
    return keep_first(df, keys, [F.col(ts).desc_nulls_last()], [tie])


def sort_key(*cols: str | Column) -> Column:
    """Columns as one comparable struct in which null is the largest value."""
    parts = []
    for i, c in enumerate(cols):
        c = F.col(c) if isinstance(c, str) else c
        parts += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*parts)
