"""Data checks. Each returns the failing rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false. Null is not a failure."""
    return df.filter(~F.expr(expression))


def between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values; null is ignored."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def relationships(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null value has no parent.

    Only the distinct values are compared with the parent; the rows are fetched for those missing.
    """
    values = child.select(column).dropna().distinct()
    missing = values.join(parent.select(F.col(key).alias(column)), column, "left_anti")
    return child.join(missing, column, "left_semi")


def row_count_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with both counts when they differ."""
    both = a.select(F.lit(1).alias("x")).union(b.select(F.lit(2).alias("x")))
    return both.agg(
        F.count_if(F.col("x") == 1).alias("model_rows"),
        F.count_if(F.col("x") == 2).alias("compare_rows"),
    ).filter("model_rows <> compare_rows")


def differences(expected: DataFrame, actual: DataFrame, keys: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """Expected rows whose columns differ from ``actual``; null equals null."""
    e = expected.select(*keys, *[F.col(c).alias(f"expected_{c}") for c in columns])
    a = actual.select(*keys, *[F.col(c).alias(f"actual_{c}") for c in columns])
    wrong = F.lit(False)
    for c in columns:
        wrong = wrong | ~F.col(f"expected_{c}").eqNullSafe(F.col(f"actual_{c}"))
    return e.join(a, list(keys), "left").filter(wrong)
