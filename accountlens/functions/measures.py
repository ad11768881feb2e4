"""Aggregate and date expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accountlens.config import Settings


def as_of(cfg: Settings) -> Column:
    day = cfg.as_of()
    return F.current_date() if day is None else F.lit(day)


def days_before(cfg: Settings, days: int) -> Column:
    return F.date_sub(as_of(cfg), days)


def in_lookback(ts: Column, cfg: Settings) -> Column:
    """True in the half-open window ending on the as-of day; null for a null time."""
    day = ts.cast("date")
    return (day > days_before(cfg, cfg.lookback_days)) & (day <= as_of(cfg))


def truthy(p: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(p, F.lit(False))


def count_if(p: Column) -> Column:
    """Rows where the predicate holds; null on empty global input, as a conditional sum is."""
    return F.sum(F.when(p, F.lit(1)).otherwise(F.lit(0)))


def any_true(p: Column) -> Column:
    """True when the predicate holds on some row; never null for a non-empty group."""
    return F.max(F.when(p, F.lit(1)).otherwise(F.lit(0))) == 1


def safe_ratio(num: Column, den: Column, digits: int = 4) -> Column:
    """Rounded ratio, null unless the denominator is positive."""
    return F.when(den > 0, F.round(num.cast("double") / den, digits))


def one_decimal(x: Column) -> Column:
    """A number as text with one decimal, never in scientific notation."""
    return F.format_string("%.1f", F.round(x, 1))


def small_list(value: Column) -> Column:
    """Distinct sorted list as text, for columns with a fixed handful of values."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(value)), ", "), F.lit(""))
