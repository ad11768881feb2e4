"""Account 360: who the account is, what it uses, what is happening, and whom to call first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.ladders import ladder, plan_of_rank
from accountlens.functions.measures import any_true, as_of, count_if, days_before, truthy
from accountlens.operators.dedupe import sort_key
from accountlens.operators.lists import listed, listed_in_order
from accountlens.operators.rank import global_rank
from accountlens.plans.activity import OBJECTS
from accountlens.plans.adoption import account_members
from accountlens.plans.members import automated, usage
from accountlens.sources.storage import Scratch

_ZERO = ["product_orgs", "known_members", "active_members_in_lookback", "members_shared_with_other_accounts",
         "ui_members_proven", "sdk_members_proven", "objects_created_in_lookback", "automated_objects_in_lookback",
         "objects_origin_unknown_in_lookback", "external_companies_linked", "signals_in_lookback",
         "external_records_pending_review", "external_records_awaiting_confirmation", "signals_needing_review",
         "actionable_signals", "technologies_detected"]

COLUMNS = [
    "account_id", "account_name", "crm_domain", "crm_linkedin_slug", "ticker", "crm_identifier_gaps",
    "crm_domain_shared_with_other_account",
    "product_orgs", "best_plan", "weakest_org_link_confidence", "has_unverified_org_link",
    "known_members", "active_members_in_lookback", "members_shared_with_other_accounts", "ui_adoption",
    "sdk_adoption", "sdk_evidence_level", "cli_adoption", "mcp_adoption", "ui_members_proven",
    "sdk_members_proven", "adoption_in_plain_english", "objects_created_in_lookback",
    "automated_objects_in_lookback", "objects_origin_unknown_in_lookback", "last_product_activity_at",
    "trace_gb_last_7d", "trace_growth_7d",
    "external_companies_linked", "signals_in_lookback", "latest_external_headline", "latest_external_signal_at",
    "technologies_detected", "external_records_pending_review", "external_records_awaiting_confirmation",
    "signals_needing_review",
    "actionable_signals", "top_action_reason", "priority_rank",
]


def _who(match_keys: DataFrame) -> DataFrame:
    gaps = ladder((F.col("has_no_match_keys"), "missing domain and LinkedIn"),
                  (F.col("is_missing_domain"), "missing domain"),
                  (F.col("is_missing_linkedin"), "missing LinkedIn"))
    return match_keys.filter("entity_type = 'account'").select(
        F.col("entity_id").alias("account_id"), F.col("entity_name").alias("account_name"),
        F.col("domain_key").alias("crm_domain"), F.col("linkedin_slug").alias("crm_linkedin_slug"), "ticker",
        gaps.alias("crm_identifier_gaps"), F.col("is_domain_shared").alias("crm_domain_shared_with_other_account"))


def _orgs(org_accounts: DataFrame) -> DataFrame:
    return org_accounts.filter(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.count("*").alias("product_orgs"), F.max("plan_rank").alias("best_plan_rank"),
        F.min("mapping_confidence").alias("weakest_org_link_confidence"),
        any_true(F.col("resolution_status") == "resolved_low_confidence").alias("has_unverified_org_link"))


def _adoption(adoption: DataFrame) -> DataFrame:
    def on(surface: str, column: str) -> Column:
        return F.max(F.when(F.col("surface") == surface, F.col(column)))

    sentence = F.concat(F.upper("surface"), F.lit(" — "), F.col("honest_summary"))
    return adoption.groupBy("account_id").agg(
        F.max("known_members").alias("known_members"),
        *[on(s, "account_evidence_status").alias(f"{s}_adoption") for s in ("ui", "sdk", "cli", "mcp")],
        *[on(s, "members_usage_proven").alias(f"{s}_members_proven") for s in ("ui", "sdk")],
        on("sdk", "evidence_level").alias("sdk_evidence_level"),
        # One sentence per surface of the rule table.
        F.array_join(F.array_sort(F.collect_set(sentence)), " | ").alias("adoption_in_plain_english"))


def _usage(activity: DataFrame) -> DataFrame:
    made = F.col("activity_type").isin(*OBJECTS)
    return activity.filter(F.col("account_id").isNotNull() & F.col("is_in_lookback")).groupBy("account_id").agg(
        F.countDistinct(F.when(F.col("actor_type").isin("human", "unknown") & usage(), F.col("person_id")))
        .alias("active_members_in_lookback"),
        count_if(made).alias("objects_created_in_lookback"),
        count_if(made & automated()).alias("automated_objects_in_lookback"),
        count_if(F.col("surface") == "unknown").alias("objects_origin_unknown_in_lookback"),
        F.max("activity_at").alias("last_product_activity_at"))


def _shared_members(memberships: DataFrame, people: DataFrame) -> DataFrame:
    torn = people.filter("is_ambiguous").select("person_id")
    return (
        account_members(memberships).join(torn, "person_id")
        .groupBy("account_id").agg(F.count("*").alias("members_shared_with_other_accounts"))
    )


def feed_by_account(feed: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One pass over the feed: counts, the newest clear external headline, and the strongest reason to act."""
    day = F.col("occurred_at").cast("date")
    recent = (day > days_before(cfg, cfg.lookback_days)) & (day <= as_of(cfg))
    clear_external = (F.col("signal_source") == "external") & ~F.col("needs_review")
    # Micro-seconds before now, so that the newest is the least; nulls come last in a sort key.
    age = F.timestamp_diff("MICROSECOND", "occurred_at", F.lit("2100-01-01").cast("timestamp_ntz"))

    def first(value: Column, where: Column, *order: Column) -> Column:
        return F.min_by(value, F.when(where, sort_key(*order)))

    return feed.groupBy("account_id").agg(
        count_if(~F.col("needs_review") & recent).alias("signals_in_lookback"),
        count_if(F.col("is_actionable")).alias("actionable_signals"),
        count_if(F.col("needs_review")).alias("signals_needing_review"),
        first(F.struct("headline", "occurred_at"), clear_external, age, F.col("signal_id")).alias("newest"),
        first(F.col("headline"), F.col("is_actionable") & F.col("headline").isNotNull(), -F.col("signal_confidence"), age,
              F.col("signal_id")).alias("top_action_reason"),
    ).withColumns({"latest_external_headline": F.col("newest.headline"),
                   "latest_external_signal_at": F.col("newest.occurred_at")}).drop("newest")


def action_reasons(feed: DataFrame) -> DataFrame:
    """(account_id, signal_confidence, occurred_at, signal_id, headline): every reason to act, beside what it is ranked by."""
    return listed_in_order(feed.filter("is_actionable"), ["account_id"], "headline",
                           ["signal_confidence", "occurred_at", "signal_id"])


def _resolved_tech(signals: DataFrame) -> DataFrame:
    return signals.filter("signal_type = 'tech_detected' and resolution_status = 'resolved'")


def tech_stack(signals: DataFrame) -> DataFrame:
    """(account_id, product_name): every technology detected at an account."""
    return listed(_resolved_tech(signals), ["account_id"], "product_name", "product_name")


def account_ranks(accounts: DataFrame, feed: DataFrame, trace_trend: DataFrame, scratch: Scratch) -> DataFrame:
    """(account_id, priority_rank): more actionable signals first, then faster trace growth. Writes the rows it ranks, no more."""
    actionable = feed.filter("is_actionable").groupBy("account_id").agg(F.count("*").alias("actionable_signals"))
    rows = (accounts.select("account_id").join(actionable, "account_id", "left")
            .join(trace_trend.select("account_id", "trace_growth_7d"), "account_id", "left")
            .select("account_id", F.coalesce("actionable_signals", F.lit(0)).alias("actionable_signals"),
                    F.coalesce("trace_growth_7d", F.lit(-1.0)).alias("growth")))
    return global_rank(
        rows, [F.col("actionable_signals").desc(), F.col("growth").desc(), F.col("account_id").asc_nulls_last()],
        ["account_id", "actionable_signals", "growth"], "priority_rank", scratch,
    ).select("account_id", "priority_rank")


def account_360(match_keys: DataFrame, org_accounts: DataFrame, adoption: DataFrame, activity: DataFrame,
                memberships: DataFrame, people: DataFrame, trace_trend: DataFrame, resolution: DataFrame,
                signals: DataFrame, feed: DataFrame, review_queue: DataFrame, ranks: DataFrame,
                cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per CRM account. ``ranks`` is ``account_ranks``.

    Each block is first brought to one row per account, so all joins are one row to one row on ``account_id``.
    """
    blocks = [
        _orgs(org_accounts), _adoption(adoption), _usage(activity), _shared_members(memberships, people),
        trace_trend.select("account_id", "trace_gb_last_7d", "trace_growth_7d"),
        review_queue,
        resolution.filter("resolution_status = 'resolved'").groupBy("account_id")
        .agg(F.count("*").alias("external_companies_linked")),
        feed_by_account(feed, cfg),
        _resolved_tech(signals).groupBy("account_id").agg(F.countDistinct("product_name").alias("technologies_detected")),
        ranks,
    ]
    assembled = reduce(lambda a, b: a.join(b, "account_id", "left"), blocks, _who(match_keys)).fillna(0, _ZERO)
    return assembled.withColumns({
        "best_plan": plan_of_rank(F.col("best_plan_rank")),
        "has_unverified_org_link": truthy(F.col("has_unverified_org_link")),
    }).select(*COLUMNS)
