"""Accounts and external companies side by side, with normalised keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions import keys as K
from accountlens.operators.joins import lookup


def entities(accounts: DataFrame, companies: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    account_side = accounts.select(
        F.lit("account").alias("entity_type"), F.col("account_id").alias("entity_id"),
        F.col("account_name").alias("entity_name"), F.col("domain").alias("website"),
        F.col("linkedin_company_url").alias("linkedin"), none.alias("second_domain"), "ticker")
    company_side = companies.select(
        F.lit("company").alias("entity_type"), F.col("company_id").alias("entity_id"),
        F.col("company_name").alias("entity_name"), F.col("company_website").alias("website"),
        F.col("linkedin_url").alias("linkedin"), F.col("linkedin_domain").alias("second_domain"),
        none.alias("ticker"))
    return account_side.unionByName(company_side)


def normalised_entities(accounts: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per entity with its keys. Written before ``build_match_keys``, which reads it three times."""
    name = F.col("entity_name")
    return entities(accounts, companies).select(
        "entity_type", "entity_id", "entity_name",
        K.domain_key(F.col("website")).alias("domain_key"),
        K.domain_key(F.col("second_domain")).alias("second_domain_key"),
        K.linkedin_slug(F.col("linkedin")).alias("linkedin_slug"),
        K.company_name_key(name).alias("name_key"),
        K.name_first_token(name).alias("name_first_token"),
        F.upper("ticker").alias("ticker"),
        K.ticker_exchange(F.col("ticker")).alias("ticker_exchange"),
        K.ticker_symbol(F.col("ticker")).alias("ticker_symbol"),
    )


def build_match_keys(normalised: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """One row per entity. A key is shared when two entities of one side have it.

    Group sizes are counted by a combining aggregate over non-null keys and looked up again, so
    neither null nor a very common key forms a group in one task.
    """
    keyed = normalised
    for key, flag in (("domain_key", "is_domain_shared"), ("linkedin_slug", "is_linkedin_shared")):
        shared = (
            normalised.filter(F.col(key).isNotNull()).groupBy("entity_type", key)
            .agg((F.count("*") > 1).alias(flag)).filter(flag)
        )
        keyed = lookup(keyed, shared, ["entity_type", key])
    return keyed.select(
        "entity_type", "entity_id", "entity_name", "domain_key", "second_domain_key", "linkedin_slug",
        "name_key", "name_first_token",
        K.token_is_specific(F.col("name_first_token"), cfg.specific_token_length).alias("name_token_is_specific"),
        "ticker", "ticker_exchange", "ticker_symbol",
        F.col("domain_key").isNull().alias("is_missing_domain"),
        F.col("linkedin_slug").isNull().alias("is_missing_linkedin"),
        (F.col("domain_key").isNull() & F.col("linkedin_slug").isNull()).alias("has_no_match_keys"),
        F.coalesce("is_domain_shared", F.lit(False)).alias("is_domain_shared"),
        F.coalesce("is_linkedin_shared", F.lit(False)).alias("is_linkedin_shared"),
    )


def account_names(match_keys: DataFrame) -> DataFrame:
    return match_keys.filter("entity_type = 'account'").select(
        F.col("entity_id").alias("account_id"), F.col("entity_name").alias("account_name"))
