"""Lists per group as long tables: one row for each value, so that no group is gathered in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listed(df: DataFrame, keys: Sequence[str], value: str | Column, name: str) -> DataFrame:
    """(keys..., name): every distinct non-null value of every group."""
    value = F.col(value) if isinstance(value, str) else value
    return df.select(*keys, value.alias(name)).filter(F.col(name).isNotNull()).distinct()


def listed_in_order(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """(keys..., order..., value): the non-null values of every group, repeats kept, beside what they are ordered by."""
    return df.filter(F.col(value).isNotNull()).select(*keys, *[o for o in order if o not in keys], value)
