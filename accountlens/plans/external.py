"""News, product and technology detections as one stream of external signals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.keys import folded
from accountlens.functions.measures import any_true, in_lookback
from accountlens.operators.dedupe import keep_first
from accountlens.operators.joins import lookup

COLUMNS = ["signal_id", "source_record_id", "company_id", "signal_family", "signal_type", "headline",
           "product_name", "occurred_at", "vendor_confidence", "source_url"]


def _signal(df: DataFrame, family: str, record: str, kind: Column, headline: Column, product: str,
            at: str, confidence: str | None, url: str | None) -> DataFrame:
    def column(name: str | None, dtype: str) -> Column:
        return F.col(name) if name else F.lit(None).cast(dtype)

    return df.select(
        F.concat(F.lit(f"{family}:"), F.col(record)).alias("signal_id"),
        F.col(record).alias("source_record_id"), "company_id",
        F.lit(family).alias("signal_family"), kind.alias("signal_type"), headline.alias("headline"),
        F.col(product).alias("product_name"), F.col(at).alias("occurred_at"),
        column(confidence, "double").alias("vendor_confidence"), column(url, "string").alias("source_url"))


def one_stream(news: DataFrame, products: DataFrame, tech: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        _signal(news, "news", "news_id", F.lower("category"), F.col("summary"), "product_name",
                "found_at", "vendor_confidence", "source_url"),
        _signal(products, "product", "product_id", F.lit("product_detected"),
                F.concat(F.lit("New product detected: "), F.col("product_name")), "product_name",
                "first_seen_at", None, "source_url"),
        _signal(tech, "tech", "detection_id", F.lit("tech_detected"),
                F.concat(F.lit("Uses "), F.col("technology_name")), "technology_name",
                "first_seen_at", "vendor_score", None),
    ])


_LAUNCH = "signal_family = 'news' and signal_type = 'launches'"
_DETECTED = "signal_family = 'product'"


def repeated_launches(signals: DataFrame) -> DataFrame:
    """(signal_id, repeat): launches that a product detection repeats, and those detections.

    Both families are grouped by company and product; a product seen in both marks its
    records. No launch is ever paired with a detection.
    """
    key = ["company_id", "product_key"]
    both = (
        signals.filter(F.coalesce(F.expr(_LAUNCH), F.lit(False)) | F.expr(_DETECTED))
        .select("signal_id", "signal_family", "signal_type", "company_id",
                folded(F.col("product_name")).alias("product_key"))
        .filter(F.col("company_id").isNotNull() & F.col("product_key").isNotNull())
    )
    seen_twice = both.groupBy(*key).agg(
        any_true(F.expr(_LAUNCH)).alias("launched"), any_true(F.expr(_DETECTED)).alias("detected"),
    ).filter("launched and detected").select(*key, F.lit(True).alias("repeat"))
    return (
        both.join(seen_twice, key)
        .select("signal_id", "repeat").distinct()
    )


def external_signals(signals: DataFrame, match_keys: DataFrame, resolution: DataFrame,
                     cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per distinct signal, with the company's resolution.

    ``signals`` is ``one_stream``, written before: it is read for the records and for their repeats.

    A detection that repeats a launch gives way to the news row, which is marked as corroborated.
    A headline that does not contain the company's leading name word is flagged.
    """
    identified = signals.filter(F.col("signal_id").isNotNull())
    marked = identified.join(repeated_launches(identified), "signal_id", "left")
    kept = marked.filter(~(F.expr(_DETECTED) & F.col("repeat").isNotNull()))
    nameless = signals.filter(F.col("signal_id").isNull()).withColumn("repeat", F.lit(None).cast("boolean"))
    unique = keep_first(kept, ["signal_id"], ["occurred_at"]).unionByName(nameless)

    companies = (
        match_keys.filter("entity_type = 'company'")
        .select(F.col("entity_id").alias("company_id"), F.col("entity_name").alias("company_name"),
                "name_first_token", "name_token_is_specific")
        .join(resolution.select("company_id", "account_id", "resolution_status", "match_method",
                                "match_confidence", "needs_review"), "company_id", "left")
    )
    joined = lookup(unique, companies, ["company_id"])
    tested = (F.col("signal_family") == "news") & F.coalesce("name_token_is_specific", F.lit(False))
    squeezed = F.replace(F.lower("headline"), F.lit(" "), F.lit(""))
    return joined.select(
        "signal_id", "source_record_id", "company_id", "company_name", "signal_family", "signal_type",
        "headline", "product_name", "occurred_at", "vendor_confidence", "source_url",
        F.col("repeat").isNotNull().alias("is_corroborated_by_product_feed"),
        F.when(tested, F.instr(squeezed, F.col("name_first_token")) == 0).otherwise(False)
        .alias("is_entity_mismatch"),
        in_lookback(F.col("occurred_at"), cfg).alias("is_in_lookback"),
        "account_id", "resolution_status", "match_method", "match_confidence",
        F.coalesce("needs_review", F.lit(False)).alias("is_match_pending_review"),
    )
