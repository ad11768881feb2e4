"""Reports: the CLI answer, column profile, table sizes, surface summaries, totals, review extracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.plans.activity import OBJECTS
from accountlens.sources.staging import CORRUPT


def cli_answer(adoption: DataFrame) -> DataFrame:
    """CLI intent beside code-based usage, one pass over the adoption table."""
    def on(surface: str, column: str) -> Column:
        return F.max(F.when(F.col("surface") == surface, F.col(column)))

    return (
        adoption.filter(F.col("surface").isin("cli", "sdk")).groupBy("account_id", "account_name").agg(
            on("cli", "known_members").alias("known_product_members"),
            F.lit("not measurable").alias("cli_usage"),
            on("cli", "members_intent_only").alias("members_with_cli_setup_intent"),
            on("cli", "members_with_unattributed_signals").alias("intent_from_multi_account_members_not_counted"),
            on("sdk", "members_usage_proven").alias("members_with_code_based_usage_sdk_or_cli"),
            on("cli", "honest_summary").alias("honest_summary"))
        .filter("known_product_members > 0").orderBy("account_id")
    )


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Per column: type, rows, populated, null or blank, distinct, and whether it is a key.

    Every cell becomes three whole numbers: its column, and 128 bits that stand for its value, whatever its length.
    Equal cells are counted before the shuffle, and no column's values meet in one task. Rows, nulls and blanks are sums
    over these groups, so the table is read once. An empty table has no rows here.
    """
    dtypes = [(c, t) for c, t in df.dtypes if c != CORRUPT]

    def hashable(c: str, dtype: str) -> Column:
        """The value in its own type: nothing is written out as text, but for maps, which have no hash."""
        value = F.col(f"`{c}`")
        if dtype in ("double", "float"):
            return value + 0.0      # -0.0 and 0.0 are one value
        return value.cast("string") if "map<" in dtype else value

    def cell(i: int, c: str, dtype: str) -> Column:
        value = hashable(c, dtype)
        # Only text can be blank. 0: filled, 1: blank, 2: null.
        blank = F.when(F.trim(value) == "", 1).otherwise(0) if dtype == "string" else F.lit(0)
        kind = F.when(value.isNull(), 2).otherwise(blank)
        return F.struct((F.lit(3 * i) + kind).alias("at"), F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2"))

    cells = F.array(*[cell(i, c, t) for i, (c, t) in enumerate(dtypes)])
    per_value = df.select(F.explode(cells).alias("c")).groupBy("c.at", "c.h1", "c.h2").agg(F.count("*").alias("n"))
    kind = F.col("at") % 3
    per_column = per_value.groupBy(F.floor(F.col("at") / 3).cast("int").alias("i")).agg(
        F.sum("n").alias("rows_total"),
        F.sum(F.when(kind < 2, F.col("n")).otherwise(0)).alias("rows_populated"),
        F.sum(F.when(kind > 0, F.col("n")).otherwise(0)).alias("rows_null_or_blank"),
        F.count_if(kind < 2).alias("distinct_values"))

    def named(values: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("i") + 1)

    return per_column.select(
        F.lit(table).alias("table_name"), named([c for c, _ in dtypes]).alias("column_name"), named([t for _, t in dtypes]).alias("data_type"),
        "rows_total", "rows_populated", "rows_null_or_blank", "distinct_values",
        ((F.col("distinct_values") == F.col("rows_total")) & (F.col("rows_total") > 1)).alias("is_unique_key"))


def column_profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [column_profile(df, name) for name, df in tables.items()])


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def surface_summary(activity: DataFrame) -> DataFrame:
    return activity.groupBy("signal_code", "surface", "evidence_kind", "attribution", "confidence_score",
                            "actor_type").agg(F.count("*").alias("events"))


def object_summary(activity: DataFrame) -> DataFrame:
    return activity.filter(F.col("activity_type").isin(*OBJECTS)).groupBy("surface", "attribution").agg(
        F.count("*").alias("objects"))


def totals(activity: DataFrame, profile: DataFrame) -> DataFrame:
    """One row of headline numbers from the activity and the profile of the delivered tables."""
    events = activity.agg(
        F.count_if(F.col("activity_type").isin(*OBJECTS)).alias("objects"),
        F.count("*").alias("activities"), F.count("account_id").alias("attributed"))
    per_table = profile.groupBy("table_name").agg(
        F.max("rows_total").alias("rows"), F.count("*").alias("columns"),
        F.sum("rows_null_or_blank").alias("null_cells"))
    cells = per_table.agg(
        F.sum("rows").alias("source_rows"), F.sum("columns").alias("source_columns"),
        F.sum("null_cells").alias("null_cells"), F.sum(F.col("rows") * F.col("columns")).alias("cells"))
    names = ["source_rows", "source_columns", "objects", "activities", "attributed", "null_cells", "cells"]
    return events.unionByName(cells, allowMissingColumns=True).agg(*[F.max(n).alias(n) for n in names])


# Review extract -> (table, columns, order). A dash stands for null where a person reads the cell.
EXTRACTS: dict[str, tuple[str, list[str], list[str]]] = {
    "org": ("orgs", ["org_id", "plan", "-account_id", "-mapping_source", "-mapping_confidence",
                     "resolution_status"], ["org_id"]),
    "people": ("people", ["person_id", "email", "org_count", "-account_id", "-account_confidence",
                          "resolution_status", "login_count"], ["person_id"]),
    "companies": ("companies", ["company_id", "company_name", "resolution_status", "-account_id", "-match_method",
                                "match_confidence", "needs_review", "next_action", "keys_matched",
                                "keys_agreeing", "unique_keys_agreeing", "-match_evidence",
                                "name_match_account_id", "name_key"], ["company_id"]),
    "members": ("members", ["person_id", "email", "-account_id", "member_type", "ui_evidence", "sdk_evidence",
                            "-sdk_evidence_any_actor", "cli_evidence", "mcp_evidence", "human_usage_events",
                            "automated_usage_events", "api_key_count"], ["person_id"]),
    "adoption": ("adoption", ["account_id", "surface", "surface_order", "usage_is_measurable", "known_members",
                              "members_usage_proven", "members_intent_only", "members_automation_only",
                              "account_evidence_status", "evidence_level", "pct_members_usage_proven",
                              "honest_summary"], ["account_id", "surface_order"]),
    "account_360": ("account_360", ["priority_rank", "account_id", "account_name", "-best_plan", "known_members",
                                    "active_members_in_lookback", "-ui_adoption", "-sdk_adoption",
                                    "-sdk_evidence_level", "-cli_adoption", "-mcp_adoption", "trace_gb_last_7d",
                                    "trace_growth_7d", "actionable_signals", "signals_needing_review",
                                    "external_records_pending_review",
                                    "external_records_awaiting_confirmation", "top_action_reason",
                                    "-crm_identifier_gaps"], ["priority_rank"]),
    "signals": ("feed", ["signal_id", "account_id", "signal_source", "signal_type", "occurred_at", "headline",
                         "signal_confidence", "attribution", "attribution_confidence", "is_actionable",
                         "needs_review"], ["account_id", "signal_id"]),
    "quality": ("quality", ["metric_order", "area", "metric", "numerator", "denominator", "rate"],
                ["metric_order"]),
    "prospects": ("prospects", ["prospect_id", "prospect_source", "prospect_name", "-domain", "-product_plan",
                                "product_members", "signals_in_lookback", "why_it_matters",
                                "-latest_headline"], ["prospect_source", "prospect_id"]),
    "traces": ("org_trend", ["org_id", "days_with_data", "gb_last_7d", "gb_baseline_day", "gb_last_day",
                             "growth_7d"], ["org_id"]),
    "keys": ("match_keys", ["entity_type", "entity_id", "entity_name", "-domain_key", "-linkedin_slug",
                            "-name_key", "-name_first_token", "is_domain_shared"], ["entity_type", "entity_id"]),
}


def review_extract(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """An ordered projection for a reviewer; the sort is a distributed range sort."""
    table, columns, order = EXTRACTS[name]
    df = tables[table]
    if name == "companies":
        names = tables["match_keys"].filter("entity_type = 'company'").select(
            F.col("entity_id").alias("company_id"), "name_key")
        df = df.join(names, "company_id")
    shown = [F.coalesce(F.col(c[1:]).cast("string"), F.lit("—")).alias(c[1:]) if c.startswith("-") else F.col(c)
             for c in columns]
    return df.select(*shown).orderBy(*[F.col(o).asc_nulls_last() for o in order])
