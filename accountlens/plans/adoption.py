"""How much of each account uses each surface, and how sure that is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.functions.ladders import ladder
from accountlens.functions.measures import any_true, count_if, one_decimal, safe_ratio
from accountlens.plans.members import SURFACES, automated, intent, likely, not_automated, proven, usage

ADOPTABLE = [s for s, _, _ in SURFACES if s != "unknown"]
_UNLISTED_ORDER = 9
_COUNTS = ["known_members", "members_usage_proven", "members_usage_likely", "members_intent_only",
           "members_automation_only", "members_with_unattributed_signals", "usage_events",
           "automated_usage_events"]


def rule_surfaces(surface_rules: DataFrame) -> DataFrame:
    """Surfaces of the rule table; measurable when some rule says usage."""
    order = ladder(*[(F.col("surface") == s, F.lit(o)) for s, o, _ in SURFACES if s != "unknown"],
                   otherwise=F.lit(_UNLISTED_ORDER))
    return (
        surface_rules.filter("surface <> 'unknown'").groupBy("surface")
        .agg(any_true(usage()).alias("usage_is_measurable")).withColumn("surface_order", order)
    )


def account_members(memberships: DataFrame) -> DataFrame:
    return memberships.filter(F.col("account_id").isNotNull()).select("account_id", "person_id").distinct()


def _attributed(activity: DataFrame) -> DataFrame:
    """Strongest evidence per account, surface and person, then people counted per account and surface."""
    per_person = (
        activity.filter(F.col("account_id").isNotNull() & F.col("surface").isin(*ADOPTABLE))
        .groupBy("account_id", "surface", "person_id").agg(
            any_true(proven() & not_automated()).alias("proven"), any_true(likely() & not_automated()).alias("likely"),
            any_true(usage() & automated()).alias("automated"), any_true(intent()).alias("intent"),
            count_if(usage()).alias("usage"), count_if(usage() & automated()).alias("automated_usage"))
    )
    return per_person.groupBy("account_id", "surface").agg(
        count_if(F.col("proven")).alias("members_usage_proven"),
        count_if(F.expr("likely and not proven")).alias("members_usage_likely"),
        count_if(F.expr("intent and not proven and not likely")).alias("members_intent_only"),
        count_if(F.expr("automated and not proven and not likely")).alias("members_automation_only"),
        F.sum("usage").alias("usage_events"), F.sum("automated_usage").alias("automated_usage_events"))


def _unattributed(activity: DataFrame, members: DataFrame) -> DataFrame:
    """Members with signals that no account could claim. Work grows with memberships, not with events."""
    silent = (
        activity.filter(F.col("account_id").isNull() & F.col("surface").isin(*ADOPTABLE))
        .filter(F.col("person_id").isNotNull())
        .groupBy("person_id").agg(F.collect_set("surface").alias("surfaces"))
    )
    return (
        members.join(silent, "person_id")
        .select("account_id", F.explode("surfaces").alias("surface"))
        .groupBy("account_id", "surface").agg(F.count("*").alias("members_with_unattributed_signals"))
    )


def _sentence(sdk: Column, traces: Column) -> Column:
    def number(name: str) -> Column:
        return F.col(name).cast("string")

    def optional(condition: Column, *parts: Column) -> Column:
        return F.when(condition, F.concat(*parts)).otherwise("")

    of_members = F.concat(F.lit(" of "), number("known_members"))
    measured = F.concat(
        number("members_usage_proven"), of_members, F.lit(" known members show proven "),
        F.when(sdk, "code-based (SDK, or CLI running the SDK)").otherwise(F.upper("surface")), F.lit(" usage"),
        optional(F.col("automated_usage_events") > 0, F.lit("; "), number("automated_usage_events"),
                 F.lit(" more runs came from automation (CI / production jobs) using a member's key")),
        optional(traces, F.lit("; the org also ingests traces programmatically ("), one_decimal(F.col("trace_gb")),
                 F.lit(" GB in 7 days, not attributable to a member)")),
    )
    unmeasured = F.concat(
        F.upper("surface"), F.lit(" usage is not measurable; "), number("members_intent_only"), of_members,
        F.lit(" known members showed setup intent"),
        optional(F.col("members_with_unattributed_signals") > 0, F.lit(" (intent from "),
                 number("members_with_unattributed_signals"),
                 F.lit(" member(s) who also belong to another account is not counted)")),
    )
    return ladder(
        (F.col("known_members") == 0, "No product members mapped to this account."),
        (F.col("usage_is_measurable"), measured), otherwise=unmeasured)


#: Surfaces that a rule table may have: they are read while planning.
MOST_SURFACES = 64


def account_surface_adoption(accounts: DataFrame, memberships: DataFrame, activity: DataFrame,
                             trace_trend: DataFrame, surface_rules: DataFrame) -> DataFrame:
    """Every account times every surface of the rule table."""
    # The handful of surfaces in the rule table become literals, so the grid needs no join.
    rules = rule_surfaces(surface_rules).limit(MOST_SURFACES + 1).collect()
    if len(rules) > MOST_SURFACES:
        raise ValueError(f"the rule table has more than {MOST_SURFACES} surfaces; each account gets a row for each")
    surfaces = F.array(*[
        F.struct(F.lit(r.surface).alias("surface"), F.lit(r.surface_order).alias("surface_order"),
                 F.lit(r.usage_is_measurable).alias("usage_is_measurable"))
        for r in rules])
    grid = accounts.select("account_id", "account_name", F.explode(surfaces).alias("s")).select("*", "s.*").drop("s")
    known = account_members(memberships)
    sizes = known.groupBy("account_id").agg(F.count("*").alias("known_members"))
    traces_by_account = trace_trend.select("account_id", F.col("trace_gb_last_7d").alias("trace_gb"))
    # Every side has one row per account, or per account and surface.
    joined = (
        grid.join(sizes, "account_id", "left")
        .join(traces_by_account, "account_id", "left")
        .join(_attributed(activity), ["account_id", "surface"], "left")
        .join(_unattributed(activity, known), ["account_id", "surface"], "left")
        .fillna(0, _COUNTS)
    )
    sdk = F.col("surface") == "sdk"
    traces = sdk & (F.coalesce("trace_gb", F.lit(0.0)) > 0)
    by_proof, by_hint, by_intent = (F.col(c) > 0 for c in _COUNTS[1:4])
    by_machine = (F.col("automated_usage_events") > 0) | traces
    return joined.select(
        "account_id", "account_name", "surface", "surface_order", "usage_is_measurable", *_COUNTS,
        F.when(sdk, F.coalesce("trace_gb", F.lit(0.0))).alias("org_level_trace_gb_last_7d"),
        ladder((by_proof | by_machine, "usage_proven"), (by_hint, "usage_likely"), (by_intent, "intent_only"),
               (~F.col("usage_is_measurable"), "not_measurable"), otherwise="no_evidence")
        .alias("account_evidence_status"),
        ladder((by_proof | by_hint | by_intent, "member"), (by_machine, "org"), otherwise="none").alias("evidence_level"),
        F.when(F.col("usage_is_measurable"), safe_ratio(F.col("members_usage_proven"), F.col("known_members")))
        .alias("pct_members_usage_proven"),
        safe_ratio(F.col("members_intent_only"), F.col("known_members")).alias("pct_members_intent_only"),
        _sentence(sdk, traces).alias("honest_summary"),
    )
