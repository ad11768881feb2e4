"""Logins to people, people to orgs and accounts, API keys to people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens.functions.keys import email_domain, folded
from accountlens.functions.ladders import is_automation_named, is_cli_named, ladder
from accountlens.functions.measures import count_if
from accountlens.operators.dedupe import keep_first, sort_key
from accountlens.operators.joins import lookup, lookup_inner


def resolve_user_identity(users: DataFrame) -> DataFrame:
    """One row per login. Logins with exactly the same e-mail are one person: the earliest login.

    The earliest login and the size of each group come from an aggregate that is combined before
    the shuffle, so an address used by very many logins is no burden for one task.
    """
    keyed = users.withColumns({
        "email_normalized": folded(F.col("email")),
        "email_domain": email_domain(folded(F.col("email"))),
    }).withColumn("person_key", F.coalesce("email_normalized", "user_id"))
    logins = keep_first(keyed, ["user_id"], ["created_at"])
    people = logins.groupBy("person_key").agg(
        F.min_by("user_id", sort_key("created_at", "user_id")).alias("person_id"),
        F.count("*").alias("logins_for_person"),
    )
    return lookup(logins, people, ["person_key"]).select(
        "user_id", "person_id", "email", "email_normalized", "email_domain", "created_at",
        "logins_for_person",
        (F.col("logins_for_person") > 1).alias("is_duplicate_login"),
        (F.col("user_id") != F.col("person_id")).alias("is_secondary_login"),
        F.when(F.col("logins_for_person") > 1, "exact_email_match").otherwise("single_login")
        .alias("person_resolution_method"),
    )


def build_memberships(members: DataFrame, identity: DataFrame, org_accounts: DataFrame) -> DataFrame:
    """One row per person and org, with the account the org resolved to."""
    per_login = members.groupBy("user_id", "org_id").agg(
        F.min("member_created_at").alias("since"), F.count("*").alias("rows"))
    people = lookup_inner(per_login, identity.select("user_id", "person_id"), ["user_id"])
    memberships = people.groupBy("person_id", "org_id").agg(
        F.min("since").alias("first_member_created_at"),
        F.sum("rows").alias("logins_in_org"),
    )
    orgs = org_accounts.select(
        "org_id", "account_id",
        F.col("resolution_status").alias("org_resolution_status"), "mapping_confidence")
    return lookup(memberships, orgs, ["org_id"])


def resolve_member_accounts(identity: DataFrame, memberships: DataFrame) -> DataFrame:
    """One row per person. An account only when all their orgs lead to that one account."""
    people = identity.groupBy("person_id").agg(
        F.max("email_normalized").alias("email"),
        F.max("email_domain").alias("email_domain"),
        F.count("*").alias("login_count"),
        F.min("created_at").alias("first_login_created_at"),
    )
    footprint = memberships.groupBy("person_id").agg(
        F.count("org_id").alias("orgs"),
        F.countDistinct("account_id").alias("accounts"),
        F.min("account_id").alias("one_account"),
        count_if(F.col("account_id").isNull()).alias("unmapped_orgs"),
        F.min("mapping_confidence").alias("weakest_link"),
        F.lit(True).alias("is_member"),
    )

    decided = (F.col("accounts") == 1) & (F.col("unmapped_orgs") == 0)
    status = ladder(
        (F.col("is_member").isNull(), "no_membership"),
        (F.col("accounts") == 0, "org_not_mapped"),
        (F.col("accounts") > 1, "ambiguous_multi_account"),
        (F.col("unmapped_orgs") > 0, "partially_mapped"),
        otherwise="resolved",
    )
    return (
        people.join(footprint, "person_id", "left")
        .select(
            "person_id", "email", "email_domain", "login_count", "first_login_created_at",
            F.coalesce("orgs", F.lit(0)).alias("org_count"),
            F.coalesce("accounts", F.lit(0)).alias("account_count"),
            F.when(decided, F.col("one_account")).alias("account_id"),
            F.when(decided, F.col("weakest_link")).alias("account_confidence"),
            (F.coalesce("unmapped_orgs", F.lit(0)) > 0).alias("has_unmapped_org"),
            (F.coalesce("accounts", F.lit(0)) > 1).alias("is_ambiguous"),
            status.alias("resolution_status"),
        )
    )


def api_key_hints(api_keys: DataFrame, identity: DataFrame) -> DataFrame:
    """One row per API key with its person; names are hints and attribute nothing."""
    keys = keep_first(api_keys, ["api_key_id"], ["key_hash"])
    return lookup(keys, identity.select("user_id", "person_id"), ["user_id"]).select(
        "api_key_id", "person_id", "user_id", "org_id", "key_hash", "key_name",
        is_cli_named(F.col("key_name")).alias("is_cli_named"),
        is_automation_named(F.col("key_name")).alias("is_automation_named"),
    )
