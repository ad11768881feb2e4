"""Company resolution against a brute-force listing of every company-account pair."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from accountlens.plans import resolution as R
from accountlens.plans.match_keys import build_match_keys, normalised_entities
from accountlens.sources.rules import load_rules
from accountlens.sources.storage import Scratch
from test_keys import ACCOUNT_SCHEMA, COMPANY_SCHEMA

METHODS = {"linkedin_slug": (1, 0.90, True), "website_domain": (2, 0.85, True), "linkedin_domain": (3, 0.75, True),
           "company_name": (99, 0.0, False)}


def run(spark, accounts, companies):
    save = Scratch(spark).save
    keys = save(build_match_keys(normalised_entities(spark.createDataFrame(accounts, ACCOUNT_SCHEMA).coalesce(1),
                                                     spark.createDataFrame(companies, COMPANY_SCHEMA).coalesce(1))), "keys")
    matched = save(R.matched_keys(keys, load_rules(spark, "external_match_rules")), "matched")
    return keys, matched, save(R.resolve_companies(keys, matched, R.account_keys(keys)), "resolved")


def url(slug):
    return slug and f"https://linkedin.com/company/{slug}"


def account(i, name, domain=None, slug=None):
    return (i, name, domain, url(slug), None)


def company(i, name, domain=None, slug=None, second=None):
    return (i, name, domain, url(slug), second)


ACCOUNTS = [
    account("A", "Alpha Inc", "alpha.com", "alpha"), account("B", "Beta", "beta.com", "beta"),
    account("C", "Gamma", "shared.com", "gamma"), account("D", "Delta", "shared.com", "delta"),
    account("E", "Twin", None, None),
]
COMPANIES = [
    company("two_keys", "Alpha", "alpha.com", "alpha"),
    company("same_value_twice", "Other", "alpha.com", None, "www.alpha.com"),
    company("second_domain", "Unlisted", "elsewhere.com", None, "beta.com"),
    company("conflict", "Mixed", "alpha.com", "beta"),
    company("shared_supports", "Gamma LLC", "shared.com", "gamma"),
    company("shared_elsewhere", "Mixed", "shared.com", "alpha"),
    company("shared_only", "Mixed", "shared.com"),
    company("unmatched", "New", "new.com", "new"),
    company("unmatched_hint", "Beta", "new.com"),
    company("no_keys", "Blank"),
    company("no_keys_hint", "Twin"),
    company("wrong_name", "Twin", None, "beta"),
]
# status, account, method, confidence, needs review, keys matched / agreeing / independent, next action
EXPECTED = {
    "two_keys": ("resolved", "A", "linkedin_slug", 0.95, False, 2, 2, 2, "attach_to_account"),
    "same_value_twice": ("resolved", "A", "website_domain", 0.85, False, 2, 2, 1, "attach_to_account"),
    "second_domain": ("resolved", "B", "linkedin_domain", 0.75, False, 1, 1, 1, "attach_to_account"),
    "conflict": ("conflict", None, None, None, False, 2, 1, 1, "steward_review"),
    "shared_supports": ("resolved", "C", "linkedin_slug", 0.90, False, 2, 2, 1, "attach_to_account"),
    "shared_elsewhere": ("conflict", None, None, None, False, 2, 1, 1, "steward_review"),
    "shared_only": ("ambiguous", None, None, None, False, 1, 0, 0, "steward_review"),
    "unmatched": ("unmatched", None, None, None, False, 0, 0, 0, "net_new_prospect"),
    "unmatched_hint": ("unmatched", None, None, None, False, 0, 0, 0, "steward_review"),
    "no_keys": ("no_identifiers", None, None, None, False, 0, 0, 0, "enrich_identifiers"),
    "no_keys_hint": ("no_identifiers", None, None, None, False, 0, 0, 0, "steward_review"),
    "wrong_name": ("resolved", "B", "linkedin_slug", 0.70, True, 1, 1, 1, "confirm_match"),
}
OUTCOME = ["company_id", "resolution_status", "account_id", "match_method", "match_confidence", "needs_review",
           "keys_matched", "keys_agreeing", "unique_keys_agreeing", "next_action"]


def test_every_outcome(spark):
    _, _, resolved = run(spark, ACCOUNTS, COMPANIES)
    assert {r[0]: tuple(r[1:]) for r in resolved.select(*OUTCOME).collect()} == EXPECTED


def test_evidence_is_readable(spark):
    _, _, resolved = run(spark, ACCOUNTS, COMPANIES)
    text = {r.company_id: r.match_evidence for r in resolved.collect()}
    assert text["shared_supports"] == "linkedin_slug=gamma -> C, website_domain=shared.com -> 2 accounts"
    assert text["same_value_twice"] == "linkedin_domain=alpha.com -> A, website_domain=alpha.com -> A"
    assert text["unmatched"] is None


def world(seed):
    """Few key values, so that most are shared; one of them by a third of each side."""
    r = random.Random(seed)

    def pick(prefix, n):
        x = r.random()
        return None if x < 0.2 else f"{prefix}0" if x < 0.5 else f"{prefix}{r.randrange(1, n)}"

    accounts = [account(f"A{i:03}", f"name {pick('n', 40)}", pick("d", 25), pick("s", 40)) for i in range(60)]
    companies = [company(f"c{i:03}", f"name {pick('n', 40)}", pick("d", 25), pick("s", 40), pick("d", 25))
                 for i in range(120)]
    return accounts, companies


def brute_force(keys):
    """Pairs per (company, method), and the outcome of every company, from first principles."""
    side = {"account": [], "company": []}
    for k in keys:
        side[k.entity_type].append(k)
    pairs, outcome = {}, {}
    for c in side["company"]:
        probes = {"linkedin_slug": ("linkedin_slug", c.linkedin_slug), "website_domain": ("domain_key", c.domain_key),
                  "linkedin_domain": ("domain_key", c.second_domain_key), "company_name": ("name_key", c.name_key)}
        found = {m: {a.entity_id for a in side["account"] if v is not None and a[f] == v} for m, (f, v) in probes.items()}
        found = {m: a for m, a in found.items() if a}
        pairs[c.entity_id] = {(m, a) for m, ids in found.items() for a in ids}
        deciding = {m: a for m, a in found.items() if m != "company_name"}
        unique = sorted((METHODS[m][0], m) for m, a in deciding.items() if len(a) == 1)
        hint = found.get("company_name", set())
        hint = next(iter(hint)) if len(hint) == 1 else None
        if not (c.domain_key or c.linkedin_slug or c.second_domain_key):
            status, winner = "no_identifiers", None
        elif not deciding:
            status, winner = "unmatched", None
        elif not unique:
            status, winner = "ambiguous", None
        else:
            [winner] = deciding[unique[0][1]]
            status = "resolved" if all(winner in a for a in deciding.values()) else "conflict"
        wrong = winner is not None and hint is not None and hint != winner
        values = {probes[m][1] for m, a in deciding.items() if a == {winner}}
        confidence = None
        if status == "resolved":
            confidence = round(min(0.99, METHODS[unique[0][1]][1] + 0.05 * (len(values) > 1) - 0.2 * wrong), 2)
        action = ("confirm_match" if wrong else "attach_to_account") if status == "resolved" else \
            "steward_review" if status in ("conflict", "ambiguous") or hint else \
            "net_new_prospect" if status == "unmatched" else "enrich_identifiers"
        outcome[c.entity_id] = (status, winner if status == "resolved" else None, confidence, action)
    return pairs, outcome


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    accounts, companies = world(seed)
    keys, matched, resolved = run(spark, accounts, companies)
    pairs, outcome = brute_force(keys.collect())
    got = {r[0]: tuple(r[1:]) for r in
           resolved.select("company_id", "resolution_status", "account_id", "match_confidence", "next_action").collect()}
    assert got == outcome

    # All pairs can be had from the two key tables.
    joined = R.company_keys(keys).join(R.account_keys(keys), R.KEY)
    by_company = {c: set() for c in pairs}
    for r in joined.collect():
        by_company[r.company_id].add((r.match_method, r.account_id))
    assert by_company == pairs
    listed = {}
    for r in R.match_candidates(matched).collect():
        listed[r.company_id, r.match_method] = r
    assert set(listed) == {(c, m) for c, found in pairs.items() for m, _ in found}
    for (c, method), r in listed.items():
        accounts_of_key = {a for m, a in pairs[c] if m == method}
        assert r.accounts_for_key == len(accounts_of_key)
        assert r.sole_account == (next(iter(accounts_of_key)) if len(accounts_of_key) == 1 else None)
    evidence = {r.company_id: r.match_evidence for r in resolved.collect()}
    for c, found in pairs.items():
        methods = {m for m, _ in found} - {"company_name"}
        lines = sorted({f"{m}={listed[c, m].matched_value} -> {listed[c, m].sole_account or f'{listed[c, m].accounts_for_key} accounts'}"
                        for m in methods})
        assert evidence[c] == (", ".join(lines) if lines else None)

    queues = {}
    for c, found in pairs.items():
        for a in {a for _, a in found}:
            q = queues.setdefault(a, [0, 0])
            q[0] += outcome[c][3] == "steward_review"
            q[1] += outcome[c][3] == "confirm_match"
    sizes = R.review_queue_sizes(keys, resolved).collect()
    assert {r.account_id: [r[1] or 0, r[2] or 0] for r in sizes if r[1] or r[2]} == {
        a: q for a, q in queues.items() if any(q)}


def test_row_order_and_partitions_do_not_matter(spark):
    accounts, companies = world(3)
    _, _, once = run(spark, accounts, companies)
    keys = build_match_keys(normalised_entities(spark.createDataFrame(accounts[::-1], ACCOUNT_SCHEMA).repartition(7),
                                                spark.createDataFrame(companies[::-1], COMPANY_SCHEMA).repartition(3)))
    keys = Scratch(spark).save(keys, "keys")
    matched = Scratch(spark).save(R.matched_keys(keys, load_rules(spark, "external_match_rules")), "matched")
    assert rows(once) == rows(R.resolve_companies(keys, matched, R.account_keys(keys)))


def test_one_key_shared_by_a_thousand_accounts(spark):
    """Rows grow in step with the data: no pair of the 1000 accounts and 500 companies is ever made."""
    accounts = [account(f"A{i:04}", f"Name {i}", "popular.com", f"s{i}") for i in range(1000)]
    companies = [company(f"c{i:03}", f"Other {i}", "popular.com", f"s{i}" if i % 2 else None) for i in range(500)]
    keys, matched, resolved = run(spark, accounts, companies)
    assert matched.count() == 500 + 250
    assert R.account_keys(keys).count() == 3 * 1000
    got = {r.company_id: (r.resolution_status, r.account_id, r.match_evidence) for r in resolved.collect()}
    assert got["c001"] == ("resolved", "A0001", "linkedin_slug=s1 -> A0001, website_domain=popular.com -> 1000 accounts")
    assert got["c002"] == ("ambiguous", None, "website_domain=popular.com -> 1000 accounts")


def test_no_companies_and_no_accounts(spark):
    _, _, none = run(spark, ACCOUNTS, [])
    assert none.count() == 0
    _, _, alone = run(spark, [], COMPANIES)
    assert {r.resolution_status for r in alone.collect()} == {"unmatched", "no_identifiers"}
