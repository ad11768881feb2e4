"""The declared checks of all layers, and a report with one row per check.

A check is data: table, kind, arguments, severity. Conditions on single rows are counted while a table is written
(``watched``), or together in one pass for a table that nobody writes; the others compare groups or tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from accountlens.operators import checks as C

SURFACES = ["ui", "sdk", "cli", "mcp", "unknown"]
KINDS = ["usage", "intent"]
EVIDENCE = ["usage_proven", "usage_likely", "intent_only", "origin_unknown", "no_evidence"]


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    severity: str = "error"
    failing: str | None = None              # SQL condition of a failing row
    unique: tuple[str, ...] | None = None   # columns that identify a row; null is ignored for one column
    parent: tuple[str, str, str] | None = None   # column, parent table, parent key
    same_rows_as: str | None = None


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(f"not_null_{table}_{c}", table, failing=f"{c} IS NULL") for c in columns]


def unique(table: str, column: str) -> list[Check]:
    return [Check(f"unique_{table}_{column}", table, unique=(column,))]


def key(table: str, column: str) -> list[Check]:
    return unique(table, column) + not_null(table, column)


def combination(table: str, *columns: str) -> list[Check]:
    return [Check(f"unique_{table}_{'_'.join(columns)}", table, unique=columns)]


def accepted(table: str, column: str, values: list[str], severity: str = "error") -> list[Check]:
    return [Check(f"accepted_values_{table}_{column}", table, severity,
                  failing=f"NOT ({column} IN ({_quoted(values)}))")]


def between(table: str, column: str, low: float, high: float) -> list[Check]:
    return [Check(f"between_{table}_{column}", table, failing=f"{column} < {low} OR {column} > {high}")]


def holds(table: str, name: str, expression: str, severity: str = "error") -> list[Check]:
    return [Check(name, table, severity, failing=f"NOT ({expression})")]


def parent(table: str, column: str, to: str, to_key: str | None = None, severity: str = "error") -> list[Check]:
    return [Check(f"relationships_{table}_{column}", table, severity, parent=(column, to, to_key or column))]


def same_rows(table: str, to: str) -> list[Check]:
    return [Check(f"row_count_{table}_matches_{to}", table, same_rows_as=to)]


RULE_CHECKS = (
    key("rule_org_mapping_sources", "mapping_source")
    + between("rule_org_mapping_sources", "confidence_score", 0, 1)
    + key("rule_external_match_rules", "match_method")
    + key("rule_external_match_rules", "precedence")
    + key("rule_surface_signals", "signal_code")
    + accepted("rule_surface_signals", "surface", SURFACES)
    + accepted("rule_surface_signals", "evidence_kind", KINDS)
    + accepted("rule_surface_signals", "attribution", ["deterministic", "heuristic", "none"])
    + between("rule_surface_signals", "confidence_score", 0, 1)
)

STAGING_CHECKS = (
    key("stg_users", "user_id") + not_null("stg_users", "email")
    + combination("stg_members", "org_id", "user_id") + not_null("stg_members", "user_id", "org_id")
    + parent("stg_members", "user_id", "stg_users") + parent("stg_members", "org_id", "stg_organizations")
    + key("stg_organizations", "org_id")
    + accepted("stg_organizations", "plan", ["Enterprise", "Pro", "Free", "enterprise", "pro", "free"])
    + key("stg_projects", "project_id") + not_null("stg_projects", "org_id")
    + parent("stg_projects", "org_id", "stg_organizations")
    + key("stg_experiments", "experiment_id") + not_null("stg_experiments", "project_id")
    + parent("stg_experiments", "project_id", "stg_projects") + parent("stg_experiments", "user_id", "stg_users")
    + holds("stg_experiments", "repo_info_json_parses", "repo_info_json IS NULL OR repo_commit IS NOT NULL")
    + holds("stg_experiments", "repo_commit_time_is_placeholder",
            "repo_commit_time IS NULL OR repo_commit_time <= created_at", "warn")
    + key("stg_datasets", "dataset_id")
    + parent("stg_datasets", "project_id", "stg_projects") + parent("stg_datasets", "user_id", "stg_users")
    + key("stg_prompts", "prompt_id")
    + parent("stg_prompts", "project_id", "stg_projects") + parent("stg_prompts", "user_id", "stg_users")
    + not_null("stg_segment_pages", "viewed_at") + parent("stg_segment_pages", "user_id", "stg_users")
    + not_null("stg_cli_wizard", "user_id")
    + accepted("stg_docs_mcp_events", "action", ["copy_add_mcp_command", "install_mcp_server"], "warn")
    + key("stg_api_keys", "api_key_id")
    + combination("stg_trace_volume", "org_id", "activity_date")
    + between("stg_trace_volume", "ingested_gb", 0, 100000)
    + key("stg_salesforce_accounts", "account_id")
    + combination("stg_account_org_map", "org_id", "account_id")
    + parent("stg_account_org_map", "account_id", "stg_salesforce_accounts")
    + parent("stg_account_org_map", "org_id", "stg_organizations")
    + parent("stg_account_org_map", "mapping_source", "rule_org_mapping_sources", severity="warn")
    + key("stg_signal_companies", "company_id")
    + key("stg_news_events", "news_id") + not_null("stg_news_events", "company_id")
    + parent("stg_news_events", "company_id", "stg_signal_companies")
    + between("stg_news_events", "vendor_confidence", 0, 1)
    + key("stg_products", "product_id") + parent("stg_products", "company_id", "stg_signal_companies")
    + key("stg_tech_detections", "detection_id")
    + parent("stg_tech_detections", "company_id", "stg_signal_companies")
    + between("stg_tech_detections", "vendor_score", 0, 1)
)

RESOLVED_CHECKS = (
    key("identity", "user_id") + not_null("identity", "person_id")
    + holds("identity", "logins_sharing_an_email", "NOT is_duplicate_login", "warn")
    + same_rows("identity", "stg_users")
    + same_rows("org_accounts", "stg_organizations")
    + holds("org_accounts", "mapped_org_has_source_and_confidence",
            "account_id IS NULL OR (mapping_source IS NOT NULL AND mapping_confidence IS NOT NULL)")
    + holds("org_accounts", "ambiguous_org_has_no_account", "NOT is_ambiguous OR account_id IS NULL")
    + key("org_accounts", "org_id")
    + accepted("org_accounts", "resolution_status",
               ["resolved", "resolved_low_confidence", "ambiguous", "unmapped", "broken_link"])
    + holds("org_accounts", "org_mapped_by_fallback_only", "resolution_status <> 'resolved_low_confidence'", "warn")
    + between("org_accounts", "mapping_confidence", 0, 1)
    + combination("memberships", "person_id", "org_id")
    + key("api_keys", "api_key_id") + not_null("api_keys", "person_id")
    + holds("people", "ambiguous_person_has_no_account", "NOT is_ambiguous OR account_id IS NULL")
    + key("people", "person_id")
    + accepted("people", "resolution_status",
               ["resolved", "ambiguous_multi_account", "partially_mapped", "org_not_mapped", "no_membership"])
    + holds("activity", "every_activity_has_a_surface", "surface IS NOT NULL")
    + holds("activity", "projects_imply_orgs", "project_id IS NULL OR org_id IS NOT NULL")
    + key("activity", "activity_id") + not_null("activity", "person_id")
    + accepted("activity", "surface", SURFACES) + accepted("activity", "evidence_kind", KINDS)
    + accepted("activity", "actor_type", ["human", "automation", "unknown"])
    + between("activity", "confidence_score", 0, 1)
    + key("org_trend", "org_id")
    + key("account_trend", "account_id") + between("account_trend", "trace_growth_7d", -1, 1000)
    + combination("match_keys", "entity_type", "entity_id")
    + holds("match_keys", "every_entity_keeps_its_identity", "entity_id IS NOT NULL AND entity_name IS NOT NULL")
    + accepted("match_keys", "entity_type", ["account", "company"])
    + combination("candidates", "company_id", "match_method")
    + same_rows("companies", "stg_signal_companies")
    + holds("companies", "resolved_has_account_method_and_confidence",
            "resolution_status <> 'resolved' OR (account_id IS NOT NULL AND match_method IS NOT NULL "
            "AND match_confidence IS NOT NULL)")
    + holds("companies", "conflicts_never_resolved", "NOT is_conflict OR account_id IS NULL")
    + holds("companies", "name_never_decides", "match_method IS NULL OR match_method <> 'company_name'")
    + key("companies", "company_id")
    + accepted("companies", "resolution_status", ["resolved", "conflict", "ambiguous", "unmatched", "no_identifiers"])
    + between("companies", "match_confidence", 0, 1)
    + parent("companies", "account_id", "stg_salesforce_accounts")
    + key("signals", "signal_id")
    + holds("signals", "headline_names_a_different_company", "NOT is_entity_mismatch", "warn")
)

_QUIET = "('no_evidence', 'intent_only')"

MART_CHECKS = (
    key("members", "person_id")
    + accepted("members", "member_type", ["human", "automation_identity", "undetermined"])
    + holds("members", "automation_identity_never_shown_as_human",
            "member_type <> 'automation_identity' OR (coalesce(ui_evidence, 'no_evidence') IN " + _QUIET
            + " AND coalesce(sdk_evidence, 'no_evidence') IN " + _QUIET + ")")
    + combination("member_surfaces", "person_id", "surface")
    + holds("member_surfaces", "cli_and_mcp_never_usage",
            "surface NOT IN ('cli', 'mcp') OR evidence_status IN ('intent_only', 'no_evidence')")
    + holds("member_surfaces", "human_evidence_never_exceeds_total",
            "human_evidence_status = evidence_status OR human_evidence_status = 'no_evidence' "
            "OR (human_evidence_status = 'intent_only' AND evidence_status <> 'no_evidence')")
    + accepted("member_surfaces", "evidence_status", EVIDENCE)
    + accepted("member_surfaces", "human_evidence_status", EVIDENCE)
    + combination("adoption", "account_id", "surface")
    + holds("adoption", "no_percentage_when_unmeasurable",
            "usage_is_measurable OR pct_members_usage_proven IS NULL")
    + holds("adoption", "member_counts_within_known_members",
            "members_usage_proven + members_usage_likely + members_intent_only <= known_members")
    + holds("adoption", "org_proof_never_member_usage",
            "evidence_level <> 'org' OR coalesce(pct_members_usage_proven, 0) = 0")
    + holds("adoption", "status_needs_evidence",
            "evidence_level <> 'none' OR account_evidence_status IN ('no_evidence', 'not_measurable')")
    + accepted("adoption", "account_evidence_status",
               ["usage_proven", "usage_likely", "intent_only", "not_measurable", "no_evidence"])
    + accepted("adoption", "evidence_level", ["member", "org", "none"])
    + same_rows("signal_companies", "stg_signal_companies") + key("signal_companies", "company_id")
    + accepted("signal_companies", "next_action", ["attach_to_account", "confirm_match", "steward_review",
                                                   "net_new_prospect", "enrich_identifiers"])
    + key("feed", "signal_id") + not_null("feed", "account_id")
    + parent("feed", "account_id", "stg_salesforce_accounts")
    + accepted("feed", "signal_source", ["external", "product"]) + between("feed", "signal_confidence", 0, 1)
    + holds("feed", "flagged_signals_never_actionable", "NOT (needs_review AND is_actionable)")
    + same_rows("account_360", "stg_salesforce_accounts")
    + key("account_360", "account_id") + key("account_360", "priority_rank")
    + key("prospects", "prospect_id") + accepted("prospects", "prospect_source", ["external_signal", "product_signup"])
    + key("quality", "metric_order") + between("quality", "rate", 0, 1)
)

DECLARED: list[Check] = RULE_CHECKS + STAGING_CHECKS + RESOLVED_CHECKS + MART_CHECKS


# Checks across tables. Each returns the failing rows.

def no_signal_lost(news: DataFrame, products: DataFrame, tech: DataFrame, signals: DataFrame) -> DataFrame:
    """Delivered records = kept records + detections that repeat a launch."""
    product = F.lower(F.trim("product_name")).alias("p")
    launches = news.filter(F.lower("category") == "launches").select("company_id", product).dropna().distinct()
    merged = products.select("company_id", product).join(launches, ["company_id", "p"], "left_semi")

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.lit(tag).alias("t"))

    rows = reduce(DataFrame.union, [tagged(news, "raw"), tagged(products, "raw"), tagged(tech, "raw"),
                                    tagged(signals, "kept"), tagged(merged, "merged")])
    return rows.agg(
        F.count_if(F.col("t") == "raw").alias("raw_rows"), F.count_if(F.col("t") == "kept").alias("kept_rows"),
        F.count_if(F.col("t") == "merged").alias("merged_duplicates"),
    ).filter("raw_rows <> kept_rows + merged_duplicates")


def no_record_lost(balance: DataFrame) -> DataFrame:
    """Sources whose delivered records are not all staged or rejected. ``balance``: ``Pipeline.staging_balance``."""
    return balance.filter("rows_in <> rows_staged + rows_rejected")


def one_exit_per_company(companies: DataFrame, prospects: DataFrame) -> DataFrame:
    """Every company takes one of the five exits, and is a prospect exactly when it should be."""
    listed = prospects.filter("prospect_source = 'external_signal'").select(
        F.col("prospect_id").alias("listed_as")).distinct()
    exits = ["net_new_prospect", "steward_review", "confirm_match", "attach_to_account", "enrich_identifiers"]
    taken = reduce(lambda a, b: a + b, [F.when(F.col("next_action") == e, 1).otherwise(0) for e in exits])
    return (
        companies.withColumn("listed_as", F.concat(F.lit("external:"), F.col("company_id")))
        .join(listed.withColumn("in_list", F.lit(1)), "listed_as", "left")
        .select("company_id", taken.alias("exits_taken"), F.coalesce("in_list", F.lit(0)).alias("in_prospect_list"),
                F.when(F.col("next_action") == "net_new_prospect", 1).otherwise(0).alias("should_be_in_list"))
        .filter("exits_taken <> 1 or in_prospect_list <> should_be_in_list")
    )


def complete_member_grid(member_surfaces: DataFrame, people: DataFrame) -> DataFrame:
    """People whose surfaces are not all there, and people missing altogether."""
    per_person = member_surfaces.groupBy("person_id").agg(F.countDistinct("surface").alias("surfaces_present"))
    return (
        people.select("person_id").join(per_person, "person_id", "left")
        .select("person_id", F.coalesce("surfaces_present", F.lit(0)).alias("surfaces_present"),
                F.lit(len(SURFACES)).alias("surfaces_expected"))
        .filter("surfaces_present <> surfaces_expected")
    )


def objects_follow_project(activity: DataFrame, projects: DataFrame, org_accounts: DataFrame) -> DataFrame:
    """Objects whose account is not the account of their project's org."""
    expected = projects.select("project_id", "org_id").join(
        org_accounts.filter(F.col("account_id").isNotNull())
        .select("org_id", F.col("account_id").alias("expected_account_id")), "org_id").drop("org_id")
    return (
        activity.filter(F.col("project_id").isNotNull()).select("activity_id", "project_id", "account_id")
        .join(expected, "project_id")
        .filter(~F.col("account_id").eqNullSafe(F.col("expected_account_id")))
        .select("activity_id", "account_id", "expected_account_id")
    )


def automation_never_active(account_360: DataFrame, memberships: DataFrame, members: DataFrame) -> DataFrame:
    """Accounts with more active members than members who are not automation identities."""
    machines = (
        memberships.filter(F.col("account_id").isNotNull()).select("account_id", "person_id").distinct()
        .join(members.filter("member_type = 'automation_identity'").select("person_id"), "person_id")
        .groupBy("account_id").agg(F.count("*").alias("automation_identities"))
    )
    return (
        account_360.select("account_id", "known_members", "active_members_in_lookback")
        .join(machines, "account_id", "left").fillna(0, ["automation_identities"])
        .filter("active_members_in_lookback > known_members - automation_identities")
    )


def pinned_keys(expected: DataFrame, match_keys: DataFrame) -> DataFrame:
    """Expected normaliser outputs that differ from the match keys."""
    return C.differences(expected, match_keys, ["entity_type", "entity_id"],
                         ["domain_key", "linkedin_slug", "name_key"])


def cross_checks(table: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    return {
        "no_signal_lost_between_layers": no_signal_lost(
            table("stg_news_events"), table("stg_products"), table("stg_tech_detections"), table("signals")),
        "every_company_has_one_exit": one_exit_per_company(table("signal_companies"), table("prospects")),
        "every_person_has_every_surface": complete_member_grid(table("member_surfaces"), table("people")),
        "objects_follow_their_project": objects_follow_project(
            table("activity"), table("stg_projects"), table("org_accounts")),
        "automation_never_counted_as_active": automation_never_active(
            table("account_360"), table("memberships"), table("members")),
    }


def failing_rows(check: Check, table: Callable[[str], DataFrame]) -> DataFrame:
    """The rows a single check objects to."""
    df = table(check.table)
    if check.failing:
        return df.filter(check.failing)
    if check.unique:
        return C.unique(df, check.unique[0]) if len(check.unique) == 1 else C.unique_combination(df, check.unique)
    if check.parent:
        column, to, to_key = check.parent
        return C.relationships(df, column, table(to), to_key)
    return C.row_count_matches(df, table(check.same_rows_as))


ROWS = "rows"
#: What a table's write has counted: its rows, and the failing rows of each check on single rows.
Counts = Mapping[str, int]


def watched(df: DataFrame, table: str) -> tuple[DataFrame, Callable[[], Counts]]:
    """``df``, to be written as ``table``, and what its write has counted, to be asked for afterwards.

    The counts stand on top of the plan, in the stage that writes, where each task's count is taken once whatever is
    run again. No second scan is needed.
    """
    mine = [c for c in DECLARED if c.table == table and c.failing]
    seen = Observation(f"checks of {table}")
    counts = [F.count_if(F.expr(c.failing)).alias(f"f{i}") for i, c in enumerate(mine)]
    df = df.observe(seen, F.count(F.lit(1)).alias(ROWS), *counts)

    def found() -> Counts:
        got = seen.get
        return {ROWS: got[ROWS]} | {c.name: got[f"f{i}"] for i, c in enumerate(mine)}

    return df, found


def _row(name: str, table: str, severity: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                     F.lit(severity).alias("severity"), F.col("failing_rows").cast("bigint").alias("failing_rows"))


def _unequal_rows(rows: int, other: DataFrame) -> DataFrame:
    return other.agg((F.count(F.lit(1)) != rows).cast("int").alias("failing_rows"))


def check_report(checks: list[Check], table: Callable[[str], DataFrame], cross: dict[str, DataFrame] | None = None,
                 counts: Callable[[str], Counts | None] = lambda _: None) -> DataFrame:
    """(check_name, table_name, severity, failing_rows, status) for every check.

    ``counts`` gives what the write of a table has counted, or None: checks that it answers cost no scan.
    """
    parts, known = [], []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        seen = counts(c.table) or {}
        other = (counts(c.same_rows_as) or {}) if c.same_rows_as else {}
        if c.failing and c.name in seen:
            known.append((c.name, c.table, c.severity, seen[c.name]))
        elif c.failing:
            by_table.setdefault(c.table, []).append(c)
        elif c.same_rows_as and ROWS in seen and ROWS in other:
            known.append((c.name, c.table, c.severity, int(seen[ROWS] != other[ROWS])))
        elif c.same_rows_as and ROWS in seen:
            parts.append(_row(c.name, c.table, c.severity, _unequal_rows(seen[ROWS], table(c.same_rows_as))))
        else:
            parts.append(_row(c.name, c.table, c.severity,
                              failing_rows(c, table).agg(F.count("*").alias("failing_rows"))))
    for name, group in by_table.items():
        sums = table(name).agg(*[F.count_if(F.expr(c.failing)).alias(f"f{i}") for i, c in enumerate(group)])
        rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(name).alias("table_name"),
                                  F.lit(c.severity).alias("severity"), F.col(f"f{i}").alias("failing_rows"))
                         for i, c in enumerate(group)])
        parts.append(sums.select(F.explode(rows).alias("r")).select("r.*"))
    for name, df in (cross or {}).items():
        parts.append(_row(name, "", "error", df.agg(F.count("*").alias("failing_rows"))))
    if known:
        spark = table(checks[0].table).sparkSession
        parts.append(spark.createDataFrame(known, "check_name string, table_name string, severity string, failing_rows bigint"))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(F.col("failing_rows") == 0, "pass")
                             .otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail")))
