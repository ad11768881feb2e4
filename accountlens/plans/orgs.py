"""Product orgs to CRM accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.ladders import ladder, plan_rank
from accountlens.operators.dedupe import keep_first, sort_key
from accountlens.operators.joins import lookup


def org_links(account_org_map: DataFrame, accounts: DataFrame, rules: DataFrame,
              cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per (org, account): its best link source and whether the CRM knows the account."""
    graded = (
        account_org_map.withColumn("mapping_source", F.lower("mapping_source"))
        .join(rules.select("mapping_source", "confidence_score", "precedence"),
              "mapping_source", "left")
        .select(
            "org_id", "account_id", "mapping_source",
            F.coalesce("confidence_score", F.lit(cfg.unknown_link_confidence)).alias("mapping_confidence"),
            F.coalesce("precedence", F.lit(cfg.unknown_link_precedence)).alias("precedence"),
        )
    )
    best = keep_first(graded, ["org_id", "account_id"], ["precedence"])
    known = accounts.select("account_id").dropna().distinct().withColumn("in_crm", F.lit(True))
    return lookup(best, known, ["account_id"]).withColumn(
        "in_crm", F.coalesce("in_crm", F.lit(False)))


def resolve_org_accounts(organizations: DataFrame, account_org_map: DataFrame, accounts: DataFrame,
                         rules: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Every org, with an account only when exactly one is linked and the CRM knows it."""
    orgs = keep_first(organizations, ["org_id"], ["created_at"]).withColumn("plan", F.lower("plan"))
    links = org_links(account_org_map, accounts, rules, cfg)
    # (org, account) is unique here, so counting accounts counts distinct accounts.
    per_org = links.groupBy("org_id").agg(
        F.count("account_id").alias("candidates"),
        F.min_by(F.struct("account_id", "mapping_source", "mapping_confidence", "in_crm"),
                 sort_key("precedence", "account_id")).alias("best"),
    )
    single = F.col("candidates") == 1
    status = ladder(
        (F.col("candidates").isNull(), "unmapped"),
        (F.col("candidates") > 1, "ambiguous"),
        (~F.col("best.in_crm"), "broken_link"),
        (F.col("best.mapping_confidence") < cfg.low_confidence_below, "resolved_low_confidence"),
        otherwise="resolved",
    )
    return orgs.join(per_org, "org_id", "left").select(
        "org_id", "org_name", "plan", plan_rank(F.col("plan")).alias("plan_rank"), "created_at",
        F.when(single & F.col("best.in_crm"), F.col("best.account_id")).alias("account_id"),
        F.when(single, F.col("best.mapping_source")).alias("mapping_source"),
        F.when(single, F.col("best.mapping_confidence")).alias("mapping_confidence"),
        F.coalesce("candidates", F.lit(0)).alias("candidate_account_count"),
        (F.coalesce("candidates", F.lit(0)) > 1).alias("is_ambiguous"),
        status.alias("resolution_status"),
    )
