"""The signal feed of an account: external news beside what its own members do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.measures import one_decimal, small_list
from accountlens.operators.joins import lookup_inner
from accountlens.plans.members import automated, intent

COLUMNS = ["signal_id", "account_id", "signal_source", "signal_type", "occurred_at", "headline",
           "signal_confidence", "attribution", "attribution_confidence", "is_actionable", "needs_review",
           "source_entity_id"]


def external_branch(signals: DataFrame, cfg: Settings) -> DataFrame:
    confidence = F.coalesce("vendor_confidence", F.lit(cfg.default_vendor_confidence))
    held = F.col("is_entity_mismatch") | F.col("is_match_pending_review")
    return signals.filter("resolution_status = 'resolved'").select(
        "signal_id", "account_id", F.lit("external").alias("signal_source"), "signal_type", "occurred_at",
        "headline", confidence.alias("signal_confidence"),
        F.concat(F.lit("external_id_"), F.col("match_method")).alias("attribution"),
        F.col("match_confidence").alias("attribution_confidence"),
        (F.col("is_in_lookback") & F.col("signal_family").isin("news", "product")
         & (confidence >= cfg.min_vendor_confidence)
         & (F.col("match_confidence") >= cfg.min_attribution_confidence) & ~held).alias("is_actionable"),
        held.alias("needs_review"), F.col("company_id").alias("source_entity_id"))


def _own(df: DataFrame, kind: str, **columns) -> DataFrame:
    """A product branch: one signal per account."""
    fixed = {
        "signal_id": F.concat(F.lit(f"{kind}:"), F.col("account_id")),
        "signal_source": F.lit("product"), "signal_type": F.lit(kind), "source_entity_id": F.col("account_id"),
    }
    return df.withColumns(fixed | columns).select(*COLUMNS)


def surge_branch(trace_trend: DataFrame, org_accounts: DataFrame, surface_rules: DataFrame,
                 cfg: Settings) -> DataFrame:
    plans = org_accounts.filter(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.max("plan_rank").alias("best_plan_rank"), F.min("mapping_confidence").alias("weakest_link"))
    rule = "org_trace_ingestion"
    grade = surface_rules.filter(F.col("signal_code") == rule).select("confidence_score").head(1)
    surges = trace_trend.filter("is_usage_surge").filter(F.lit(bool(grade))).join(plans, "account_id", "left")
    percent = F.round(F.col("trace_growth_7d") * 100, 0).cast("bigint").cast("string")
    return _own(
        surges, "usage_surge",
        occurred_at=F.col("last_day").cast("timestamp_ntz"),
        headline=F.concat(
            F.lit("Trace ingestion up "), percent, F.lit("% in 7 days ("), one_decimal(F.col("gb_baseline_day")),
            F.lit(" -> "), one_decimal(F.col("gb_last_day")), F.lit(" GB/day)"),
            F.when(F.col("best_plan_rank") < 3, " on a non-Enterprise plan").otherwise("")),
        signal_confidence=F.lit(grade[0][0] if grade else None).cast("double"), attribution=F.lit(rule),
        attribution_confidence=F.col("weakest_link"),
        is_actionable=F.col("weakest_link") >= cfg.min_attribution_confidence,
        needs_review=F.col("weakest_link") < cfg.min_attribution_confidence)


def automation_branch(recent: DataFrame, cfg: Settings) -> DataFrame:
    runs = recent.filter(automated() & (F.col("surface") == "sdk")).groupBy("account_id").agg(
        F.max("activity_at").alias("occurred_at"), F.count("*").alias("runs"),
        F.min("account_confidence").alias("attribution_confidence"))
    return _own(
        runs, "ci_automation",
        headline=F.concat(F.col("runs").cast("string"), F.lit(
            f" objects created by automation (CI / production jobs) in the last {cfg.lookback_days} days")),
        signal_confidence=F.lit(cfg.automation_signal_confidence), attribution=F.lit("org_account"),
        is_actionable=F.lit(False), needs_review=F.lit(False))


def intent_branch(recent: DataFrame, cfg: Settings) -> DataFrame:
    exploring = recent.filter(intent() & F.col("surface").isin("cli", "mcp")).groupBy("account_id").agg(
        F.max("activity_at").alias("occurred_at"),
        F.countDistinct("person_id").alias("people"), small_list(F.col("surface")).alias("surfaces"),
        F.max("account_attribution").alias("attribution"),
        F.min("account_confidence").alias("attribution_confidence"))
    return _own(
        exploring, "surface_intent",
        headline=F.concat(F.col("people").cast("string"), F.lit(" member(s) exploring "), F.upper("surfaces"),
                          F.lit(" setup (intent, not proven usage)")),
        signal_confidence=F.lit(cfg.intent_signal_confidence),
        is_actionable=F.col("attribution_confidence") >= cfg.min_attribution_confidence,
        needs_review=F.col("attribution_confidence") < cfg.min_attribution_confidence)


def account_signals(signals: DataFrame, trace_trend: DataFrame, org_accounts: DataFrame, activity: DataFrame,
                    accounts: DataFrame, surface_rules: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """All signals of all accounts. A new source is one more branch."""
    recent = activity.filter(F.col("account_id").isNotNull() & F.col("is_in_lookback"))
    feed = reduce(DataFrame.unionByName, [
        external_branch(signals, cfg),
        surge_branch(trace_trend, org_accounts, surface_rules, cfg),
        automation_branch(recent, cfg),
        intent_branch(recent, cfg),
    ])
    # Only the external branch can have many rows per account.
    named = lookup_inner(feed, accounts, ["account_id"])
    return named.select("signal_id", "account_id", "account_name", *COLUMNS[2:])
