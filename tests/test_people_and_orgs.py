from __future__ import annotations

from conftest import rows

from accountlens.config import DEFAULTS
from accountlens.plans.identity import api_key_hints, build_memberships, resolve_member_accounts, resolve_user_identity
from accountlens.plans.orgs import resolve_org_accounts
from accountlens.sources.rules import load_rules

USERS = "user_id string, email string, created_at timestamp_ntz"
LOGINS = [
    ("u1", "Kim@Nimbus.io", "2025-01-02"), ("u2", " kim@nimbus.io", "2025-01-01"), ("u3", "lee@nimbus.io", None),
    ("u4", None, "2025-01-01"), ("u5", None, "2025-01-01"), ("u6", "lee@nimbus.io", None),
    ("u1", "other@nimbus.io", "2026-01-01"),        # the same login delivered twice: the earlier row counts
]


def users(spark, logins=LOGINS):
    return spark.createDataFrame(logins, "user_id string, email string, c string").selectExpr(
        "user_id", "email", "CAST(c AS timestamp_ntz) AS created_at")


def test_identity(spark):
    assert rows(resolve_user_identity(users(spark)), "user_id", "person_id", "email_normalized", "email_domain",
                "logins_for_person", "is_secondary_login", "person_resolution_method") == [
        ("u1", "u2", "kim@nimbus.io", "nimbus.io", 2, True, "exact_email_match"),
        ("u2", "u2", "kim@nimbus.io", "nimbus.io", 2, False, "exact_email_match"),
        ("u3", "u3", "lee@nimbus.io", "nimbus.io", 2, False, "exact_email_match"),
        ("u4", "u4", None, None, 1, False, "single_login"),
        ("u5", "u5", None, None, 1, False, "single_login"),
        ("u6", "u3", "lee@nimbus.io", "nimbus.io", 2, True, "exact_email_match"),
    ]


ORGS = [("contract", "Enterprise"), ("parent", "PRO"), ("fallback", "free"), ("odd", "trial"), ("two", None),
        ("gone", "pro"), ("none", "pro"), ("null_only", "pro"), ("null_first", "pro")]
LINKS = [
    ("contract", "A", "Contract"), ("contract", "A", "org_c_fallback"),      # best source of a repeated link
    ("parent", "A", "billing_parent"), ("fallback", "B", "org_c_fallback"), ("odd", "B", "guesswork"),
    ("two", "A", "org_c_fallback"), ("two", "B", "contract"),
    ("gone", "Z", "contract"), ("null_only", None, "contract"),
    ("null_first", None, "contract"), ("null_first", "A", "org_c_fallback"),
]


def org_accounts(spark, cfg=DEFAULTS):
    orgs = spark.createDataFrame([(o, o.title(), None, p) for o, p in ORGS],
                                 "org_id string, org_name string, created_at timestamp_ntz, plan string")
    links = spark.createDataFrame(LINKS, "org_id string, account_id string, mapping_source string")
    accounts = spark.createDataFrame([("A",), ("B",)], "account_id string")
    return resolve_org_accounts(orgs, links, accounts, load_rules(spark, "org_mapping_sources"), cfg)


def test_every_org_status(spark):
    got = {r.org_id: (r.resolution_status, r.account_id, r.mapping_source, r.mapping_confidence,
                      r.candidate_account_count, r.plan_rank)
           for r in org_accounts(spark).collect()}
    assert got == {
        "contract": ("resolved", "A", "contract", 0.95, 1, 3),
        "parent": ("resolved", "A", "billing_parent", 0.85, 1, 2),
        "fallback": ("resolved_low_confidence", "B", "org_c_fallback", 0.5, 1, 1),
        "odd": ("resolved_low_confidence", "B", "guesswork", 0.3, 1, 0),
        "two": ("ambiguous", None, None, None, 2, 0),
        "gone": ("broken_link", None, "contract", 0.95, 1, 2),
        "none": ("unmapped", None, None, None, 0, 2),
        "null_only": ("broken_link", None, None, None, 0, 2),
        # The better link names no account, so the one account that is linked is not trusted.
        "null_first": ("broken_link", None, "contract", 0.95, 1, 2),
    }


def test_people(spark):
    logins = [("alice", "a@x", None), ("bob", "b@x", None), ("cleo", "c@x", None), ("dan", "d@x", None),
              ("eve", "e@x", None), ("alice2", "A@X", None)]
    identity = resolve_user_identity(users(spark, logins)).cache()
    members = spark.createDataFrame(
        [("contract", "alice"), ("parent", "alice"), ("parent", "alice2"), ("fallback", "bob"), ("contract", "bob"),
         ("contract", "cleo"), ("none", "cleo"), ("none", "dan"), ("contract", "stranger")],
        "org_id string, user_id string").selectExpr("*", "CAST('2025-05-01' AS timestamp_ntz) AS member_created_at")
    memberships = build_memberships(members, identity, org_accounts(spark)).cache()
    assert rows(memberships, "person_id", "org_id", "logins_in_org", "account_id") == [
        ("alice", "contract", 1, "A"), ("alice", "parent", 2, "A"), ("bob", "contract", 1, "A"),
        ("bob", "fallback", 1, "B"), ("cleo", "contract", 1, "A"), ("cleo", "none", 1, None), ("dan", "none", 1, None)]
    people = resolve_member_accounts(identity, memberships)
    assert rows(people, "person_id", "resolution_status", "account_id", "account_confidence", "login_count", "org_count",
                "account_count", "has_unmapped_org") == [
        ("alice", "resolved", "A", 0.85, 2, 2, 1, False),
        ("bob", "ambiguous_multi_account", None, None, 1, 2, 2, False),
        ("cleo", "partially_mapped", None, None, 1, 2, 1, True),
        ("dan", "org_not_mapped", None, None, 1, 1, 0, True),
        ("eve", "no_membership", None, None, 1, 0, 0, False)]


def test_api_key_hints(spark):
    identity = resolve_user_identity(users(spark, [("u", "u@x", None)]))
    keys = spark.createDataFrame(
        [("k1", "u", "o", "h", "My-CLI"), ("k2", "u", "o", "h", "ci-nightly"), ("k3", "u", "o", "h", "deploy-CI"),
         ("k4", "x", "o", "h", "robot"), ("k5", None, "o", "h", "plain"), ("k6", "u", "o", "h", None),
         ("k1", "u", "o", "z", "again")],
        "api_key_id string, user_id string, org_id string, key_hash string, key_name string")
    assert rows(api_key_hints(keys, identity), "api_key_id", "person_id", "is_cli_named", "is_automation_named") == [
        ("k1", "u", True, False), ("k2", "u", False, True), ("k3", "u", False, True), ("k4", None, False, True),
        ("k5", None, False, False), ("k6", "u", None, None)]
