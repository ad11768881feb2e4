"""Resolution scorecard: 19 ratios, one aggregate per input table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountlens.functions.measures import count_if, safe_ratio
from accountlens.plans.activity import OBJECTS

_ALL = "true"
_MAPPED = "account_id is not null"
_RESOLVED = "resolution_status = 'resolved'"
_MADE = f"activity_type in {OBJECTS}"

# Number, area and wording of each metric. Input -> (number, area, metric, counted, out of),
# the last two as conditions on a row.
METRICS: dict[str, list[tuple[int, str, str, str, str]]] = {
    "identity": [
        (1, "identity", "Logins merged into an existing person (exact email)", "is_secondary_login", _ALL),
    ],
    "orgs": [
        (2, "identity", "Product orgs mapped to a Salesforce account", _MAPPED, _ALL),
        (3, "identity", "Mapped orgs whose link is low confidence (fallback)",
         "resolution_status = 'resolved_low_confidence'", _MAPPED),
    ],
    "people": [
        (4, "identity", "People resolved to exactly one account", _RESOLVED, _ALL),
        (5, "identity", "People flagged ambiguous (belong to 2+ accounts)", "is_ambiguous", _ALL),
    ],
    "activity": [
        (6, "activity", "Product activities attributed to an account", _MAPPED, _ALL),
        (8, "activity", "Objects whose creating surface is unknown", "surface = 'unknown'", _MADE),
        (9, "activity", "Objects created by automation (CI / production jobs)", "actor_type = 'automation'", _MADE),
    ],
    "pages": [
        (7, "activity", "Page views that are anonymous (cannot be attributed)", "user_id is null", _ALL),
    ],
    "companies": [
        (10, "external", "External companies resolved to an account", _RESOLVED, _ALL),
        (11, "external", "Resolved companies confirmed by 2+ independent keys (distinct values)",
         f"{_RESOLVED} and unique_keys_agreeing >= 2", _RESOLVED),
        (12, "external", "Resolved companies whose name also agrees (audit proxy)",
         "name_agrees_with_match", _RESOLVED),
        (13, "external", "External companies in conflict (keys disagree)", "resolution_status = 'conflict'", _ALL),
        (14, "external", "External companies left unresolved (any reason)", "resolution_status <> 'resolved'", _ALL),
        (19, "external", "Resolved companies whose name points at a different account (held for review)",
         "needs_review", _RESOLVED),
    ],
    "signals": [
        (15, "external", "External signals attached to an account", _MAPPED, _ALL),
        (16, "external", "News headlines that name a different company (entity mismatch)",
         "is_entity_mismatch", "signal_family = 'news'"),
    ],
    "accounts": [
        (17, "crm", "Salesforce accounts with no domain and no LinkedIn", "has_no_match_keys", _ALL),
        (18, "crm", "Salesforce accounts sharing a domain with another account", "is_domain_shared", _ALL),
    ],
}


def _measure(df: DataFrame, metrics: list[tuple[int, str, str, str, str]]) -> DataFrame:
    """All metrics of one input in one pass, then one row per metric."""
    sums = df.agg(*[c for i, (_, _, _, num, den) in enumerate(metrics)
                    for c in (count_if(F.expr(num)).alias(f"n{i}"),
                              (F.count("*") if den == _ALL else count_if(F.expr(den))).alias(f"d{i}"))])
    rows = F.array(*[F.struct(F.lit(o).alias("metric_order"), F.lit(a).alias("area"), F.lit(m).alias("metric"),
                              F.col(f"n{i}").alias("numerator"), F.col(f"d{i}").alias("denominator"))
                     for i, (o, a, m, _, _) in enumerate(metrics)])
    return sums.select(F.explode(rows).alias("m")).select("m.*")


def resolution_quality(inputs: dict[str, DataFrame]) -> DataFrame:
    """``inputs`` by the names in METRICS; ``accounts`` is the account side of the match keys."""
    rows = reduce(DataFrame.unionByName, [_measure(inputs[name], m) for name, m in METRICS.items()])
    return rows.withColumn("rate", safe_ratio(F.col("numerator"), F.col("denominator")))
