"""What each person did on each surface, and one row per person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.functions.ladders import ladder
from accountlens.functions.measures import any_true, count_if, small_list

# Surfaces in reading order, and what can be seen of each.
SURFACES = [
    ("ui", 1, "Observable: logged-in page views (raw_segment_pages.user_id)"),
    ("sdk", 2, "Observable: repo_info / CI tags on objects, trace ingestion at org level. Cannot be split from CLI"),
    ("cli", 3, "Not observable: only setup-wizard views and API key names (intent)"),
    ("mcp", 4, "Not observable: only docs install/copy clicks (intent)"),
    ("unknown", 5, "Objects with no origin metadata: UI, or SDK outside a git repo"),
]


def usage() -> Column:
    return F.col("evidence_kind") == "usage"


def intent() -> Column:
    return F.col("evidence_kind") == "intent"


def automated() -> Column:
    return F.col("actor_type") == "automation"


def not_automated() -> Column:
    return F.col("actor_type") != "automation"


def proven() -> Column:
    return usage() & (F.col("attribution") == "deterministic")


def likely() -> Column:
    return usage() & (F.col("attribution") == "heuristic")


def _evidence(unknown_events: str, proven_flag: str, likely_flag: str) -> Column:
    return ladder(
        ((F.col("surface") == "unknown") & (F.col(unknown_events) > 0), "origin_unknown"),
        (F.col(proven_flag), "usage_proven"),
        (F.col(likely_flag), "usage_likely"),
        (F.col("has_intent"), "intent_only"),
        otherwise="no_evidence",
    )


def member_surface_activity(people: DataFrame, activity: DataFrame) -> DataFrame:
    """Every person times every surface; silence is a row of zeros, not a missing row."""
    counts = {
        "signal_events": F.count("*"),
        "usage_events": count_if(usage()),
        "intent_events": count_if(intent()),
        "human_usage_events": count_if(usage() & (F.col("actor_type") == "human")),
        "non_automated_events": count_if(not_automated()),
        "automated_usage_events": count_if(usage() & automated()),
        "events_in_lookback": count_if(F.col("is_in_lookback")),
    }
    flags = {
        "proven": any_true(proven()), "likely": any_true(likely()),
        "human_proven": any_true(proven() & not_automated()), "human_likely": any_true(likely() & not_automated()),
        "has_intent": any_true(intent()),
    }
    seen = activity.filter(F.col("person_id").isNotNull()).groupBy("person_id", "surface").agg(
        *[c.alias(n) for n, c in (counts | flags).items()],
        F.min("activity_at").alias("first_seen_at"), F.max("activity_at").alias("last_seen_at"),
        F.max("confidence_score").alias("max_confidence"),
        small_list(F.col("signal_code")).alias("signal_codes"),     # codes of one rule table
    )
    surfaces = F.explode(F.array(*[
        F.struct(F.lit(s).alias("surface"), F.lit(o).alias("surface_order"), F.lit(w).alias("what_we_can_see"))
        for s, o, w in SURFACES]))
    grid = people.select(
        "person_id", "email", "account_id", F.col("resolution_status").alias("account_resolution_status"),
        surfaces.alias("s")).select("*", "s.*").drop("s")
    filled = grid.join(seen, ["person_id", "surface"], "left").fillna(0, list(counts)).fillna(0.0, ["max_confidence"])
    by_human, by_machine = F.col("human_usage_events") > 0, F.col("automated_usage_events") > 0
    actor = F.when(F.col("usage_events") > 0, ladder(
        (by_human & by_machine, "human_and_automation"), (by_machine, "automation_only"), (by_human, "human"),
        otherwise="unknown"))
    return filled.select(
        "person_id", "email", "account_id", "account_resolution_status", "surface", "surface_order",
        "signal_events", "usage_events", "intent_events", "human_usage_events", "automated_usage_events",
        "events_in_lookback", "first_seen_at", "last_seen_at", "max_confidence",
        _evidence("signal_events", "proven", "likely").alias("evidence_status"),
        _evidence("non_automated_events", "human_proven", "human_likely").alias("human_evidence_status"),
        actor.alias("usage_actor"), "signal_codes", "what_we_can_see",
    )


def members(people: DataFrame, surface_activity: DataFrame, api_keys: DataFrame) -> DataFrame:
    """One row per person; surface columns show what the person did, not what ran under their key."""
    def on(surface: str, column: str) -> Column:
        return F.max(F.when(F.col("surface") == surface, F.col(column)))

    def total(column: str, *surfaces: str) -> Column:
        return F.sum(F.when(F.col("surface").isin(*surfaces), F.col(column)).otherwise(0))

    pivoted = surface_activity.groupBy("person_id").agg(
        *[on(s, "human_evidence_status").alias(f"{s}_evidence") for s in ("ui", "sdk", "cli", "mcp")],
        on("sdk", "evidence_status").alias("sdk_evidence_any_actor"),
        on("sdk", "usage_actor").alias("sdk_usage_actor"),
        total("usage_events", "ui").alias("ui_page_views"),
        total("usage_events", "sdk").alias("sdk_objects"),
        total("usage_events", "unknown").alias("objects_origin_unknown"),
        total("intent_events", "cli", "mcp").alias("cli_mcp_intent_events"),
        F.sum("human_usage_events").alias("human_usage_events"),
        F.sum("automated_usage_events").alias("automated_usage_events"),
        F.sum("events_in_lookback").alias("events_in_lookback"),
        F.max("last_seen_at").alias("last_seen_at"),
    )
    owned = api_keys.filter(F.col("person_id").isNotNull())
    keys = owned.groupBy("person_id").agg(
        F.count("*").alias("api_key_count"), any_true(F.col("is_automation_named")).alias("has_automation_named_key"))
    human = F.col("human_usage_events") > 0
    kind = ladder(
        ((F.col("automated_usage_events") > 0) & ~human & (F.col("objects_origin_unknown") == 0),
         "automation_identity"),
        (human, "human"), otherwise="undetermined")
    return (
        people.join(pivoted, "person_id", "left").join(keys, "person_id", "left")
        .select(
            "person_id", "email", "email_domain", "login_count",
            (F.col("login_count") > 1).alias("has_duplicate_logins"), "org_count", "account_count", "account_id",
            "account_confidence", F.col("resolution_status").alias("account_resolution_status"),
            kind.alias("member_type"),
            "ui_evidence", "sdk_evidence", "cli_evidence", "mcp_evidence", "sdk_evidence_any_actor",
            "sdk_usage_actor", "ui_page_views", "sdk_objects", "objects_origin_unknown",
            "cli_mcp_intent_events", "human_usage_events", "automated_usage_events", "events_in_lookback",
            "last_seen_at", F.coalesce("api_key_count", F.lit(0)).alias("api_key_count"),
            F.coalesce("has_automation_named_key", F.lit(False)).alias("has_automation_named_key"),
        )
    )
