"""Trace ingestion: first day against last day of a short window, per org and per account."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.measures import as_of, count_if, days_before, safe_ratio, truthy


def daily_volume(trace_volume: DataFrame) -> DataFrame:
    """(org_id, activity_date, gb): duplicate org-days added up."""
    return (trace_volume.filter(F.col("org_id").isNotNull() & F.col("activity_date").isNotNull())
            .groupBy("org_id", "activity_date").agg(F.sum("ingested_gb").alias("gb")))


class DailyVolume:
    """``daily_volume`` kept as a Parquet table, a folder a day, so that a trend reads sums of a few days and no raw rows.

    ``refresh`` works out the days that have changed and puts them in the place of what was there (dynamic partition
    overwrite): late rows cost their own days, and running it again changes nothing. A day that has lost all its
    rows keeps a row without an org, which readers do not see, in place of its old sums.
    """

    SCHEMA = "org_id string, gb double, activity_date date"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def refresh(self, trace_volume: DataFrame, changed: DataFrame | None = None) -> None:
        """Bring the days of ``changed`` (rows with ``activity_date``) up to date with ``trace_volume``, or all its days.

        The days are joined to the volume, which lets Spark open only their partitions where it is cut by day.
        """
        days = (trace_volume if changed is None else changed).select("activity_date").dropna().distinct()
        sums = daily_volume(trace_volume if changed is None else trace_volume.join(days, "activity_date", "left_semi"))
        marks = days.select(F.lit(None).cast("string").alias("org_id"), F.lit(None).cast("double").alias("gb"), "activity_date")
        (sums.select("org_id", "gb", "activity_date").unionByName(marks).hint("rebalance", "activity_date").write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("activity_date").parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).filter(F.col("org_id").isNotNull())

    def trend(self, cfg: Settings = DEFAULTS) -> DataFrame:
        """``org_trace_trend`` from the sums."""
        return trend_of_days(self.read(), cfg)


def org_trace_trend(trace_volume: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per org with traces in the window.

    The days are closed on both ends; the total leaves out the baseline day. Duplicate org-days
    are added up first.
    """
    return trend_of_days(daily_volume(_window(trace_volume, cfg)), cfg)


def _window(rows: DataFrame, cfg: Settings) -> DataFrame:
    day = F.col("activity_date")
    return rows.filter((day >= days_before(cfg, cfg.trend_days)) & (day <= as_of(cfg)))


def trend_of_days(daily: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """The trend of each org from its daily sums (``daily_volume``), of which the window's days are read."""
    start = days_before(cfg, cfg.trend_days)
    daily = _window(daily, cfg)
    recent = F.col("activity_date") > start
    trend = daily.groupBy("org_id").agg(
        F.min("activity_date").alias("baseline_day"),
        F.max("activity_date").alias("last_day"),
        F.sum(F.when(recent, F.col("gb")).otherwise(0.0)).alias("gb_total"),
        count_if(recent).alias("days_with_data"),
        F.min_by("gb", "activity_date").alias("gb_baseline_day"),
        F.max_by("gb", "activity_date").alias("gb_last_day"),
    )
    return trend.select(
        "org_id", "baseline_day", "last_day",
        F.datediff("last_day", "baseline_day").alias("days_compared"),
        "days_with_data",
        F.round("gb_total", 2).alias("gb_last_7d"),
        "gb_baseline_day", "gb_last_day",
        safe_ratio(F.col("gb_last_day") - F.col("gb_baseline_day"), F.col("gb_baseline_day")).alias("growth_7d"),
    )


def tracing_orgs(org_trend: DataFrame, org_accounts: DataFrame) -> DataFrame:
    """(account_id, org_id): the orgs of an account that send traces."""
    mapped = org_accounts.filter(F.col("account_id").isNotNull()).select("org_id", "account_id")
    return mapped.join(org_trend.select("org_id"), "org_id").select("account_id", "org_id")


def account_trace_trend(org_trend: DataFrame, org_accounts: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per account with a tracing org. The only place account growth is computed."""
    mapped = org_accounts.filter(F.col("account_id").isNotNull()).select("org_id", "account_id")
    joined = org_trend.join(mapped, "org_id")     # both sides have one row per org
    totals = joined.groupBy("account_id").agg(
        F.count("org_id").alias("orgs_sending_traces"),
        F.round(F.sum("gb_last_7d"), 2).alias("trace_gb_last_7d"),
        F.sum("gb_baseline_day").alias("gb_baseline_day"),
        F.sum("gb_last_day").alias("gb_last_day"),
        F.max("last_day").alias("last_day"),
    )
    gained = F.col("gb_last_day") - F.col("gb_baseline_day")
    growth = F.when(F.col("gb_baseline_day") > 0, gained / F.col("gb_baseline_day"))
    return totals.select(
        "account_id", "orgs_sending_traces", "trace_gb_last_7d",
        "gb_baseline_day", "gb_last_day", "last_day",
        safe_ratio(gained, F.col("gb_baseline_day")).alias("trace_growth_7d"),
        truthy(growth >= cfg.usage_surge_threshold).alias("is_usage_surge"),
    )
