"""External companies to CRM accounts.

A key value may belong to very many accounts and be probed by very many companies, so company-account
pairs are never formed to decide anything. Accounts are first grouped by key value; a company then
meets one row per key: how many accounts have it, and which one when it is only one. Whether
a shared key contains the chosen account is a join on (key, account).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountlens.config import DEFAULTS, Settings
from accountlens.functions.ladders import ladder
from accountlens.functions.measures import truthy
from accountlens.operators.dedupe import sort_key
from accountlens.operators.joins import lookup

KEY = ["key_type", "key_value"]

# Match method -> (company column, kind of key). Two methods may probe the same kind of key.
PROBES = {
    "linkedin_slug": ("linkedin_slug", "slug"),
    "website_domain": ("domain_key", "domain"),
    "linkedin_domain": ("second_domain_key", "domain"),
    "company_name": ("name_key", "name"),
}
ACCOUNT_KEYS = {"slug": "linkedin_slug", "domain": "domain_key", "name": "name_key"}


def _long(df: DataFrame, id_column: str, entries: list[Column]) -> DataFrame:
    return (
        df.select(F.col("entity_id").alias(id_column), F.explode(F.array(*entries)).alias("k"))
        .select(id_column, "k.*").filter(F.col("key_value").isNotNull())
    )


def account_keys(match_keys: DataFrame) -> DataFrame:
    """(key_type, key_value, account_id): every key of every account, once."""
    entries = [F.struct(F.lit(t).alias("key_type"), F.col(c).alias("key_value"))
               for t, c in ACCOUNT_KEYS.items()]
    return _long(match_keys.filter("entity_type = 'account'"), "account_id", entries).distinct()


def company_keys(match_keys: DataFrame) -> DataFrame:
    """(company_id, match_method, key_type, key_value): every key a company can be matched by."""
    entries = [F.struct(F.lit(m).alias("match_method"), F.lit(t).alias("key_type"), F.col(c).alias("key_value"))
               for m, (c, t) in PROBES.items()]
    return _long(match_keys.filter("entity_type = 'company'"), "company_id", entries).distinct()


def key_groups(keys: DataFrame) -> DataFrame:
    """One row per account key value: number of accounts, and the account when it is one."""
    sizes = keys.groupBy(*KEY).agg(F.count("*").alias("accounts_for_key"), F.min("account_id").alias("one"))
    return sizes.select(*KEY, "accounts_for_key", F.when(F.col("accounts_for_key") == 1, F.col("one")).alias("sole_account"))


def matched_keys(match_keys: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per company and method that matched at least one account."""
    return (
        lookup(company_keys(match_keys), key_groups(account_keys(match_keys)), KEY)
        .filter(F.col("accounts_for_key").isNotNull())
        .join(rules.select("match_method", "precedence", "base_confidence", "can_resolve"), "match_method")
        .select(
            "company_id", "match_method", F.col("key_value").alias("matched_value"), "key_type",
            "precedence", "base_confidence", "can_resolve", "accounts_for_key",
            (F.col("accounts_for_key") == 1).alias("is_unique_for_key"), "sole_account",
        )
    )


def match_candidates(matched: DataFrame) -> DataFrame:
    """One row per company and method: the key, how many accounts have it, and the account when it is one.

    The accounts of a shared key stand in ``account_keys``, one row each; the two tables joined on the
    key are all company-account pairs, whose number grows with the square of a popular key.
    """
    return matched.select(
        "company_id", "match_method", "key_type", "matched_value", "precedence", "base_confidence", "can_resolve",
        "accounts_for_key", "is_unique_for_key", "sole_account")


def _supported(deciding: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds ``agrees``: the key's accounts include the winner."""
    member = ["key_type", "matched_value", "winner"]
    shared = deciding.filter("not is_unique_for_key and winner is not null").select(*member)
    agreeing = (
        shared.distinct()
        .join(keys.select("key_type", F.col("key_value").alias("matched_value"),
                          F.col("account_id").alias("winner")), member, "left_semi")
        .withColumn("in_group", F.lit(True))
    )
    checked = lookup(deciding, agreeing, member)
    return checked.withColumn(
        "agrees",
        F.when(F.col("is_unique_for_key"), truthy(F.col("sole_account") == F.col("winner")))
        .otherwise(F.coalesce("in_group", F.lit(False))))


def _evidence() -> Column:
    """The keys of a company, at most three, each with its account or the number of accounts that share it."""
    accounts = F.when(F.col("is_unique_for_key"), F.col("sole_account")).otherwise(
        F.concat(F.col("accounts_for_key").cast("string"), F.lit(" accounts")))
    line = F.concat("match_method", F.lit("="), "matched_value", F.lit(" -> "), accounts)
    return F.array_join(F.array_sort(F.collect_set(line)), ", ")


def resolve_companies(match_keys: DataFrame, matched: DataFrame, keys: DataFrame,
                      cfg: Settings = DEFAULTS) -> DataFrame:
    """Every company with its outcome. ``matched`` is ``matched_keys``, ``keys`` is ``account_keys``.

    The best deciding key that points at one account names the winner. Every other deciding key that
    matched has to include the winner, else the company is in conflict.
    """
    companies = match_keys.filter("entity_type = 'company'").select(
        F.col("entity_id").alias("company_id"), F.col("entity_name").alias("company_name"),
        F.col("domain_key").alias("website_domain"), "linkedin_slug",
        F.col("second_domain_key").alias("linkedin_domain"),
        F.coalesce("domain_key", "linkedin_slug", "second_domain_key").isNotNull().alias("has_any_key"),
        F.col("is_domain_shared").alias("is_website_shared_in_feed"),
    )
    deciding = matched.filter("can_resolve")
    winners = (
        deciding.filter("is_unique_for_key").groupBy("company_id")
        .agg(F.min_by(F.struct("match_method", "sole_account", "base_confidence"),
                      sort_key("precedence", "sole_account")).alias("w"))
        .select("company_id", F.col("w.match_method").alias("winning_method"),
                F.col("w.sole_account").alias("winner"), F.col("w.base_confidence").alias("winning_confidence"))
    )
    def set_size(c: Column) -> Column:
        return F.size(F.collect_set(c)).cast("bigint")

    # A company has at most three deciding keys, so joins and groups by company cannot be skewed.
    checked = _supported(deciding.join(winners, "company_id", "left"), keys)
    agrees = F.col("agrees")
    summary = checked.groupBy("company_id").agg(
        set_size(F.col("match_method")).alias("keys_matched"),
        set_size(F.when(agrees, F.col("match_method"))).alias("keys_agreeing"),
        # One value seen in two vendor fields is one piece of evidence.
        set_size(F.when(agrees & F.col("is_unique_for_key"), F.col("matched_value"))).alias("unique_keys_agreeing"),
        F.max("winner").alias("winner"),
        F.max("winning_method").alias("winning_method"),
        F.max("winning_confidence").alias("winning_confidence"),
        F.lit(True).alias("is_matched"),
        _evidence().alias("match_evidence"),
    )
    hints = matched.filter("match_method = 'company_name' and is_unique_for_key").select(
        "company_id", F.col("sole_account").alias("name_match_account_id"))
    joined = companies.join(summary, "company_id", "left").join(hints, "company_id", "left")

    status = ladder(
        (~F.col("has_any_key"), "no_identifiers"),
        (F.col("is_matched").isNull(), "unmatched"),
        (F.col("winner").isNull(), "ambiguous"),
        (F.col("keys_matched") > F.col("keys_agreeing"), "conflict"),
        otherwise="resolved",
    )
    staged = joined.withColumn("resolution_status", status).withColumn(
        "name_contradicts", truthy(F.col("name_match_account_id") != F.col("winner")))
    resolved = F.col("resolution_status") == "resolved"
    contradicts = F.col("name_contradicts")
    confidence = F.least(
        F.lit(cfg.confidence_cap),
        F.col("winning_confidence")
        + F.when(F.col("unique_keys_agreeing") >= 2, cfg.corroboration_bonus).otherwise(0.0)
        - F.when(contradicts, cfg.contradiction_penalty).otherwise(0.0),
    )
    action = ladder(
        (resolved & contradicts, "confirm_match"),
        (resolved, "attach_to_account"),
        (F.col("resolution_status").isin("conflict", "ambiguous"), "steward_review"),
        (F.col("name_match_account_id").isNotNull(), "steward_review"),
        (F.col("resolution_status") == "unmatched", "net_new_prospect"),
        otherwise="enrich_identifiers",
    )
    return staged.select(
        "company_id", "company_name", "website_domain", "linkedin_slug", "linkedin_domain",
        "resolution_status",
        F.when(resolved, F.col("winner")).alias("account_id"),
        F.when(resolved, F.col("winning_method")).alias("match_method"),
        F.when(resolved, F.round(confidence, 2)).alias("match_confidence"),
        (resolved & contradicts).alias("needs_review"),
        (F.col("resolution_status") == "conflict").alias("is_conflict"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("keys_matched", "keys_agreeing", "unique_keys_agreeing")],
        "match_evidence", "name_match_account_id",
        F.when(resolved, truthy(F.col("name_match_account_id") == F.col("winner"))).alias("name_agrees_with_match"),
        "is_website_shared_in_feed",
        action.alias("next_action"),
    )


# Combinations of key kinds, with the sign they have when the sizes of overlapping sets are added up.
_COMBINATIONS = [
    (("domain",), 1), (("slug",), 1), (("name",), 1),
    (("domain", "slug"), -1), (("domain", "name"), -1), (("slug", "name"), -1),
    (("domain", "slug", "name"), 1),
]


def _combination(kinds: tuple[str, ...], values: dict[str, Column]) -> Column:
    """The key kinds and values as one struct, null when a value is missing."""
    present = F.lit(True)
    for k in kinds:
        present = present & values[k].isNotNull()
    fields = [values[k] if k in kinds else F.lit(None).cast("string") for k in ("domain", "slug", "name")]
    return F.when(present, F.struct(
        F.lit("+".join(kinds)).alias("kinds"),
        *[F.coalesce(f, F.lit("")).alias(k) for f, k in zip(fields, ("domain", "slug", "name"), strict=True)]))


def review_queue_sizes(match_keys: DataFrame, resolution: DataFrame) -> DataFrame:
    """Per account: distinct companies with a key pointing at it, by the two review actions.

    A company can reach an account by up to three keys and counts once. The sets of companies that
    share each key are counted per key value and added up by inclusion and exclusion, so the
    company-account pairs are never formed.
    """
    key_cols = ["kinds", "domain", "slug", "name"]
    companies = (
        match_keys.filter("entity_type = 'company'").withColumnRenamed("entity_id", "company_id")
        .join(resolution.filter(F.col("next_action").isin("steward_review", "confirm_match"))
              .select("company_id", "next_action"), "company_id")
        .withColumn("d", F.explode_outer(F.array_compact(F.array_distinct(
            F.array("domain_key", "second_domain_key")))))
    )
    values = {"domain": F.col("d"), "slug": F.col("linkedin_slug"), "name": F.col("name_key")}
    # Combinations without a domain must count once for a company with two domains.
    entries = F.array_compact(F.array(*[_combination(k, values) for k, _ in _COMBINATIONS]))
    reach = companies.select("company_id", "next_action", F.explode(entries).alias("k")).distinct()
    sizes = reach.groupBy(*[F.col(f"k.{c}").alias(c) for c in key_cols]).agg(
        F.count_if(F.col("next_action") == "steward_review").alias("pending"),
        F.count_if(F.col("next_action") == "confirm_match").alias("awaiting"),
    )
    own = {"domain": F.col("domain_key"), "slug": F.col("linkedin_slug"), "name": F.col("name_key")}
    signed = F.array_compact(F.array(*[
        F.when(_combination(k, own).isNotNull(), F.struct(_combination(k, own).alias("k"), F.lit(sign).alias("sign")))
        for k, sign in _COMBINATIONS]))
    accounts = (
        match_keys.filter("entity_type = 'account'")
        .select(F.col("entity_id").alias("account_id"), F.explode(signed).alias("e"))
        .select("account_id", "e.sign", "e.k.*")
    )
    return (
        accounts.join(sizes, key_cols, "left")
        .groupBy("account_id")
        .agg(F.sum(F.col("sign") * F.col("pending")).alias("external_records_pending_review"),
             F.sum(F.col("sign") * F.col("awaiting")).alias("external_records_awaiting_confirmation"))
    )
