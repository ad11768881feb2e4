"""Is a landed source recent enough?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Load-time column, and hours after which a source warns and fails.
FRESHNESS = {
    "product": ("_loaded_at", 3, 12),
    "crm": ("_fivetran_synced", 6, 24),
    "signals": ("_ingested_at", 36, 72),
}


def check_freshness(df: DataFrame, loaded_at: str, warn_after_hours: float, error_after_hours: float,
                    now: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Newest load, its age in hours, and pass, warn or error: one row, or one for each group of ``by``, in one pass.

    An empty source is an error; an empty group has no row.
    """
    now = F.localtimestamp() if now is None else now
    newest = df.groupBy(*by).agg(F.max(loaded_at).cast("timestamp_ntz").alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now) / 3600.0
    return newest.withColumn("age_hours", F.round(age, 4)).withColumn(
        "status",
        F.when(age.isNull() | (age > error_after_hours), "error")
        .when(age > warn_after_hours, "warn").otherwise("pass"),
    )


def check_source_freshness(df: DataFrame, kind: str, now: Column | None = None, loaded_at: str | None = None,
                           by: Sequence[str] = ()) -> DataFrame:
    """``check_freshness`` with the load-time column and the thresholds of a kind of source."""
    column, warn, error = FRESHNESS[kind]
    return check_freshness(df, loaded_at or column, warn, error, now, by)
