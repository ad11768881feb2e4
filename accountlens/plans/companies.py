"""External companies with their outcome, and prospects nobody has an account for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.functions.measures import count_if
from accountlens.operators.dedupe import latest_per_key
from accountlens.operators.joins import lookup


def signal_companies(resolution: DataFrame, signals: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every external company, resolved or not, with the names of both accounts it may point at."""
    counts = signals.filter(F.col("company_id").isNotNull()).groupBy("company_id").agg(
        F.count("*").alias("signals_total"), count_if(F.col("is_in_lookback")).alias("signals_in_lookback"),
        count_if(F.col("is_entity_mismatch")).alias("signals_entity_mismatch"),
        F.max("occurred_at").alias("latest_signal_at"))
    hinted = accounts.select(F.col("account_id").alias("name_match_account_id"),
                             F.col("account_name").alias("name_match_account_name"))
    named = lookup(lookup(resolution, accounts, ["account_id"]), hinted, ["name_match_account_id"])
    tallies = ["signals_total", "signals_in_lookback", "signals_entity_mismatch"]
    return named.join(counts, "company_id", "left").fillna(0, tallies).select(
        "company_id", "company_name", "website_domain", "linkedin_slug", "linkedin_domain", "resolution_status",
        "account_id", "account_name", "match_method", "match_confidence", "is_conflict", "keys_matched",
        "keys_agreeing", "match_evidence", "name_match_account_id",
        "name_match_account_name", "name_agrees_with_match", "needs_review", "is_website_shared_in_feed",
        "next_action", *tallies, "latest_signal_at")


def _prospect(df: DataFrame, prefix: str, source: str, why: str, **columns: Column) -> DataFrame:
    null = F.lit(None).cast("string")
    defaults = {"domain": null, "linkedin_slug": null, "product_plan": null, "latest_headline": null}
    c = defaults | columns
    return df.select(
        F.concat(F.lit(f"{prefix}:"), c["key"]).alias("prospect_id"), F.lit(source).alias("prospect_source"),
        c["name"].alias("prospect_name"), c["domain"].alias("domain"), c["linkedin_slug"].alias("linkedin_slug"),
        c["product_plan"].alias("product_plan"), c["members"].cast("bigint").alias("product_members"),
        c["signals"].cast("bigint").alias("signals_in_lookback"), c["seen"].alias("last_seen_at"),
        F.lit(why).alias("why_it_matters"), c["latest_headline"].alias("latest_headline"))


def net_new_prospects(companies: DataFrame, signals: DataFrame, org_accounts: DataFrame, memberships: DataFrame,
                      identity: DataFrame, activity: DataFrame) -> DataFrame:
    """Companies with no account, and product orgs with no account."""
    headlines = latest_per_key(
        signals.filter("signal_family = 'news' and company_id is not null")
        .select("company_id", "headline", "occurred_at", "signal_id"),
        ["company_id"], "occurred_at", "signal_id").select("company_id", "headline")
    external = _prospect(
        companies.filter("next_action = 'net_new_prospect'").join(headlines, "company_id", "left"),
        "external", "external_signal", "External activity from a company with no CRM account",
        key=F.col("company_id"), name=F.col("company_name"), domain=F.col("website_domain"),
        linkedin_slug=F.col("linkedin_slug"), members=F.lit(0), signals=F.col("signals_in_lookback"),
        seen=F.col("latest_signal_at"), latest_headline=F.col("headline"))

    unmapped = org_accounts.filter("resolution_status = 'unmapped'").select("org_id", "org_name", "plan")
    domains = identity.groupBy("person_id").agg(F.max("email_domain").alias("email_domain"))
    # (person, org) is unique, so counting people counts distinct people.
    footprint = (
        memberships.select("org_id", "person_id").join(domains, "person_id", "left")
        .groupBy("org_id").agg(F.count("person_id").alias("members"), F.max("email_domain").alias("email_domain"))
    )
    usage = activity.filter(F.col("org_id").isNotNull()).groupBy("org_id").agg(
        count_if(F.col("is_in_lookback")).alias("events"), F.max("activity_at").alias("seen"))
    product = _prospect(
        unmapped.join(footprint, "org_id", "left").join(usage, "org_id", "left"),
        "product", "product_signup", "Product sign-up using us today with no CRM account",
        key=F.col("org_id"), name=F.col("org_name"), domain=F.col("email_domain"), product_plan=F.col("plan"),
        members=F.coalesce("members", F.lit(0)), signals=F.coalesce("events", F.lit(0)), seen=F.col("seen"))
    return external.unionByName(product)
