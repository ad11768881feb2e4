"""A left join to a dimension that adds its columns and nothing else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``facts`` to ``dim``, which has one row per key.

    Spark picks the join. Where it shuffles, adaptive execution splits a partition in which one key, or
    null, holds a large share of the facts; a session that groups by the same key right after sets
    ``spark.sql.adaptive.forceOptimizeSkewedJoin``, as ``session.local_session`` does.
    """
    for k in keys:
        if facts.schema[k].dataType != dim.schema[k].dataType:
            raise TypeError(f"key {k} has different types on the two sides")
    values = [c for c in dim.columns if c not in keys]
    return facts.join(dim, list(keys), "left").select(*facts.columns, *values)


def lookup_inner(facts: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``lookup`` without the rows that found no match."""
    marked = dim.withColumn("__found", F.lit(True))
    return lookup(facts, marked, keys).filter("__found").drop("__found")
