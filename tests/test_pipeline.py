"""The whole pipeline over the CSV files of ``world.py``; expectations are worked out from the rules."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from conftest import rows

import world
from accountlens.config import DEFAULTS
from accountlens.plans import check_suite as S
from accountlens.plans import reports
from accountlens.plans.pipeline import MARTS, RESOLVED, SHARED, Pipeline
from accountlens.sources.staging import csv_sources
from accountlens.sources.storage import Published
from pyspark.sql import functions as F

CFG = replace(DEFAULTS, as_of_date="2026-03-31")


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    return csv_sources(spark, world.write_csv(tmp_path_factory.mktemp("csv")))


@pytest.fixture(scope="module")
def run(spark, sources):
    return Pipeline(spark, sources, CFG)


@pytest.fixture(scope="module")
def marts(run):
    return {name: run.scratch.save(run.table(name), name) for name in MARTS}


def test_csv_is_read_as_delivered(run):
    assert rows(run.staged("experiments").filter("experiment_id = 'e1'"), "repo_commit", "repo_branch", "repo_is_dirty",
                "repo_author_name", "repo_commit_time", "meta_eval_name", "meta_source") == [
        ("c1", "main", True, "kim", dt.datetime(2026, 3, 1), "x", None)]
    assert rows(run.staged("news_events").filter("news_id = 'n2'"), "summary", "vendor_confidence", "product_name") == [
        ('Kite hires, says "wow"', 0.69, None)]


def test_companies(run):
    assert rows(run.table("companies"), "company_id", "resolution_status", "account_id", "match_confidence", "next_action") == [
        ("c_bare", "no_identifiers", None, None, "steward_review"),
        ("c_clash", "conflict", None, None, "steward_review"),
        ("c_free", "unmatched", None, None, "net_new_prospect"),
        ("c_kite", "resolved", "B_KITE", 0.9, "attach_to_account"),
        ("c_nim", "resolved", "A_NIM", 0.95, "attach_to_account"),
        ("c_twin", "resolved", "D_TWIN", 0.7, "confirm_match")]


def test_member_surfaces(run, marts):
    grid = marts["member_surfaces"]
    assert grid.count() == 5 * 5
    assert rows(grid.filter("person_id = 'rob'"), "surface", "usage_events", "evidence_status", "human_evidence_status",
                "usage_actor") == [
        ("cli", 0, "no_evidence", "no_evidence", None), ("mcp", 0, "no_evidence", "no_evidence", None),
        ("sdk", 2, "usage_proven", "no_evidence", "automation_only"), ("ui", 0, "no_evidence", "no_evidence", None),
        ("unknown", 0, "no_evidence", "no_evidence", None)]
    assert rows(grid.filter("person_id = 'kim'"), "surface", "evidence_status", "signal_codes", "max_confidence") == [
        ("cli", "intent_only", "cli_key_name_hint", 0.2), ("mcp", "intent_only", "mcp_docs_click", 0.3),
        ("sdk", "usage_proven", "code_repo_info", 0.9), ("ui", "usage_proven", "ui_page_view", 0.95),
        ("unknown", "origin_unknown", "object_origin_unknown", 0.0)]
    assert rows(grid.filter("person_id = 'lou' and surface = 'sdk'"), "evidence_status", "human_evidence_status") == [
        ("usage_likely", "no_evidence")]


def test_members(marts):
    assert rows(marts["members"], "person_id", "member_type", "sdk_evidence", "sdk_evidence_any_actor", "api_key_count",
                "has_automation_named_key", "account_id") == [
        ("kim", "human", "usage_proven", "usage_proven", 2, False, "A_NIM"),
        ("lou", "human", "no_evidence", "usage_likely", 0, False, "B_KITE"),
        ("new", "human", "usage_proven", "usage_proven", 0, False, None),
        ("pat", "human", "usage_proven", "usage_proven", 0, False, None),
        ("rob", "automation_identity", "no_evidence", "usage_proven", 1, True, "A_NIM")]


def test_adoption(marts):
    def of(account):
        return rows(marts["adoption"].filter(f"account_id = '{account}'"), "surface", "account_evidence_status",
                    "evidence_level", "pct_members_usage_proven", "honest_summary")

    assert of("A_NIM") == [
        ("cli", "intent_only", "member", None, "CLI usage is not measurable; 1 of 3 known members showed setup intent "
         "(intent from 1 member(s) who also belong to another account is not counted)"),
        ("mcp", "intent_only", "member", None, "MCP usage is not measurable; 1 of 3 known members showed setup intent"),
        ("sdk", "usage_proven", "member", 0.3333, "1 of 3 known members show proven code-based (SDK, or CLI running the SDK) "
         "usage; 2 more runs came from automation (CI / production jobs) using a member's key; the org also ingests "
         "traces programmatically (11.0 GB in 7 days, not attributable to a member)"),
        ("ui", "usage_proven", "member", 0.3333, "1 of 3 known members show proven UI usage")]
    assert of("E_BARE") == [
        ("cli", "not_measurable", "none", None, "No product members mapped to this account."),
        ("mcp", "not_measurable", "none", None, "No product members mapped to this account."),
        ("sdk", "no_evidence", "none", None, "No product members mapped to this account."),
        ("ui", "no_evidence", "none", None, "No product members mapped to this account.")]
    # lou's only code event is a server job: the account uses the SDK, no member is counted as likely
    assert rows(marts["adoption"].filter("account_id = 'B_KITE' and surface = 'sdk'"), "members_usage_proven",
                "members_usage_likely", "members_automation_only", "automated_usage_events") == [(1, 0, 1, 1)]


def test_feed(marts):
    assert rows(marts["feed"], "signal_id", "account_id", "headline", "is_actionable", "needs_review", "attribution_confidence") == [
        ("ci_automation:A_NIM", "A_NIM", "2 objects created by automation (CI / production jobs) in the last 30 days", False, False, 0.95),
        ("ci_automation:B_KITE", "B_KITE", "1 objects created by automation (CI / production jobs) in the last 30 days", False, False, 0.85),
        ("news:n1", "A_NIM", "Nimbus launches Cumulus", True, False, 0.95),
        ("news:n2", "B_KITE", 'Kite hires, says "wow"', False, False, 0.9),             # vendor too unsure
        ("news:n3", "B_KITE", "Somebody else hires", False, True, 0.9),                 # names another company
        ("news:n4", "D_TWIN", "Fallback hires", False, True, 0.7),                      # waits for a steward
        ("news:n6", "B_KITE", "Kite expands", False, False, 0.9),                       # first day outside the window
        ("product:q2", "B_KITE", "New product detected: Tail", True, False, 0.9),
        ("surface_intent:A_NIM", "A_NIM", "1 member(s) exploring MCP setup (intent, not proven usage)", True, False, 0.95),
        ("surface_intent:B_KITE", "B_KITE", "1 member(s) exploring CLI setup (intent, not proven usage)", True, False, 0.85),
        ("tech:t1", "A_NIM", "Uses Spark", False, False, 0.95), ("tech:t2", "A_NIM", "Uses Arrow", False, False, 0.95),
        ("usage_surge:B_KITE", "B_KITE", "Trace ingestion up 150% in 7 days (2.0 -> 5.0 GB/day) on a non-Enterprise plan",
         True, False, 0.85)]


def test_account_360(marts):
    assert rows(marts["account_360"], "priority_rank", "account_id", "actionable_signals", "top_action_reason", "best_plan",
                "active_members_in_lookback", "members_shared_with_other_accounts", "crm_identifier_gaps") == [
        (1, "B_KITE", 3, "Trace ingestion up 150% in 7 days (2.0 -> 5.0 GB/day) on a non-Enterprise plan", "pro", 2, 1,
         "missing domain"),
        (2, "A_NIM", 2, "Nimbus launches Cumulus", "enterprise", 1, 1, None),
        (3, "C_FALL", 0, None, "free", 0, 0, "missing LinkedIn"),
        (4, "D_TWIN", 0, None, None, 0, 0, None),
        (5, "E_BARE", 0, None, None, 0, 0, "missing domain and LinkedIn")]
    assert rows(marts["account_360"], "account_id", "signals_in_lookback", "signals_needing_review", "external_companies_linked",
                "external_records_pending_review", "external_records_awaiting_confirmation", "latest_external_headline",
                "technologies_detected") == [
        ("A_NIM", 3, 0, 1, 1, 0, "Nimbus launches Cumulus", 2),
        ("B_KITE", 5, 1, 1, 1, 0, "New product detected: Tail", 0),
        ("C_FALL", 0, 0, 0, 0, 1, None, 0), ("D_TWIN", 0, 1, 1, 0, 1, None, 0),
        ("E_BARE", 0, 0, 0, 1, 0, None, 0)]


def test_prospects(marts):
    assert rows(marts["prospects"], "prospect_id", "domain", "product_plan", "product_members", "signals_in_lookback",
                "latest_headline") == [
        ("external:c_free", "free.agent", None, 0, 1, "Free Agent raises money"),
        ("product:o_new", "start.up", "free", 1, 1, None)]


def test_scorecard(marts):
    got = {r.metric_order: (r.numerator, r.denominator, r.rate) for r in marts["quality"].collect()}
    assert got == {
        1: (1, 6, 0.1667), 2: (3, 4, 0.75), 3: (1, 3, 0.3333), 4: (3, 5, 0.6), 5: (1, 5, 0.2), 6: (13, 15, 0.8667),
        7: (1, 3, 0.3333), 8: (3, 9, 0.3333), 9: (3, 9, 0.3333), 10: (3, 6, 0.5), 11: (1, 3, 0.3333), 12: (2, 3, 0.6667),
        13: (1, 6, 0.1667), 14: (3, 6, 0.5), 15: (8, 9, 0.8889), 16: (1, 6, 0.1667), 17: (1, 5, 0.2), 18: (2, 5, 0.4),
        19: (1, 3, 0.3333)}


def test_reports(run, marts):
    assert rows(run.table("cli_answer"), "account_id", "known_product_members", "members_with_cli_setup_intent",
                "intent_from_multi_account_members_not_counted") == [("A_NIM", 3, 1, 1), ("B_KITE", 2, 1, 1)]
    profile = reports.column_profile(run.sources["segment_pages"], "pages")
    assert rows(profile, "column_name", "rows_total", "rows_populated", "rows_null_or_blank", "distinct_values", "is_unique_key") == [
        ("anonymous_id", 3, 3, 0, 2, False), ("path", 3, 3, 0, 2, False), ("timestamp", 3, 3, 0, 2, False),
        ("user_id", 3, 2, 1, 2, False)]
    assert rows(reports.totals(run.table("activity"), profile)) == [(3, 4, 9, 15, 13, 1, 12)]


def test_every_extract_can_be_read(run, marts):
    tables = {n: run.table(n) for n in ("companies", "match_keys", "people", "org_trend")} | marts | {
        "orgs": run.table("org_accounts")}
    for name, (_, columns, _) in reports.EXTRACTS.items():
        extract = reports.review_extract(name, tables)
        assert extract.columns == [c.removeprefix("-") for c in columns]
        assert extract.count() > 0


def test_checks(run, marts):
    def table(name):
        return marts[name] if name in marts else run.table(name)

    cross = S.cross_checks(table)
    report = S.check_report(S.DECLARED, table, cross).collect()
    assert len(report) == len(S.DECLARED) + len(cross)
    # The world has a duplicate person, a fallback link, a foreign headline. Nothing else is wrong.
    assert {r.check_name: (r.failing_rows, r.status) for r in report if r.status != "pass"} == {
        "logins_sharing_an_email": (2, "warn"), "org_mapped_by_fallback_only": (1, "warn"),
        "headline_names_a_different_company": (1, "warn")}


def test_checks_on_rows_are_counted_while_writing(run, marts):
    written = [c for c in S.RESOLVED_CHECKS + S.MART_CHECKS if c.table in SHARED or c.table in ("adoption", "feed")]
    report = S.check_report(written, run.saved, counts=run.counts)
    scanned = S.check_report(written, lambda n: marts[n] if n in marts else run.table(n))
    assert rows(report) == rows(scanned)
    # Conditions, ranges, nulls and accepted values of 13 shared tables: nothing is read again.
    single = [c for c in written if c.failing]
    assert len({c.table for c in single}) >= 8
    plan = S.check_report(single, run.saved, counts=run.counts)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Exchange" not in plan
    assert run.counts("stg_users") is None and run.counts("feed")[S.ROWS] == marts["feed"].count()


def test_counts_see_damage(spark):
    bad = spark.sql("SELECT 's' || id AS signal_id, cast(null AS string) AS account_id, 'x' AS signal_source, 7.0 AS signal_confidence, "
                    "id < 2 AS needs_review, true AS is_actionable FROM range(5)")
    df, counts = S.watched(bad, "feed")
    df.write.format("noop").mode("overwrite").save()
    assert counts() == {S.ROWS: 5, "not_null_feed_signal_id": 0, "not_null_feed_account_id": 5, "accepted_values_feed_signal_source": 5,
                        "between_feed_signal_confidence": 5, "flagged_signals_never_actionable": 2}


def test_cross_checks_catch_damage(run, marts):
    lost = run.table("signals").filter("signal_id <> 'news:n1'")
    assert S.no_signal_lost(run.staged("news_events"), run.staged("products"), run.staged("tech_detections"), lost).count() == 1
    assert S.one_exit_per_company(marts["signal_companies"], marts["prospects"].limit(0)).count() == 1
    grid = marts["member_surfaces"].filter("not (person_id = 'kim' and surface = 'ui') and person_id <> 'lou'")
    assert rows(S.complete_member_grid(grid, run.table("people")), "person_id", "surfaces_present") == [("kim", 4), ("lou", 0)]
    moved = run.table("activity").selectExpr("activity_id", "project_id", "'X' AS account_id")
    assert S.objects_follow_project(moved, run.staged("projects"), run.table("org_accounts")).count() == 8
    inflated = marts["account_360"].selectExpr("account_id", "known_members", "known_members AS active_members_in_lookback")
    assert rows(S.automation_never_active(inflated, run.table("memberships"), marts["members"]), "account_id") == [("A_NIM",)]


def test_lists_are_long_tables(run):
    assert rows(run.table("action_reasons"), "account_id", "headline", "signal_confidence")[:2] == [
        ("A_NIM", "1 member(s) exploring MCP setup (intent, not proven usage)", 0.3), ("A_NIM", "Nimbus launches Cumulus", 0.9)]
    assert rows(run.table("account_tech")) == [("A_NIM", "Arrow"), ("A_NIM", "Spark")]
    assert rows(run.table("person_api_keys")) == [("kim", "kim-cli"), ("kim", "laptop"), ("rob", "ci-runner")]
    assert {r.person_id for r in run.table("person_logins").collect()} == {"kim", "lou", "new", "pat", "rob"}


def test_a_plan_writes_nothing(spark, sources, monkeypatch):
    with Pipeline(spark, sources, CFG) as p:
        with pytest.raises(LookupError, match="build"):
            p.plan("account_360")
        p.build(["account_360"])
        saved = set(p._saved)
        monkeypatch.setattr(p.scratch, "write", lambda *_: pytest.fail("a plan has written"))
        assert p.plan("account_360").count() == 5
        assert set(p._saved) == saved


def test_empty_inputs(spark, sources):
    empty = Pipeline(spark, {s: df.limit(0) for s, df in sources.items()}, CFG)
    for name in MARTS:
        assert empty.table(name).count() == (19 if name == "quality" else 0)


def test_publish(spark, sources, marts):
    with Pipeline(spark, sources, CFG) as p:
        views = p.publish("dev")
        # A filter on the lookback opens the files of its days only.
        recent = p.plan("activity").filter("is_in_lookback and account_id is not null")
        plan = recent._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
        assert "run#" in filters and "activity_day#" in filters
        days = {r.activity_day for r in spark.table("dev_cleansed.activity").select("activity_day").distinct().collect()}
        opened = {f.split("activity_day=")[1].split("/")[0] for f in recent.inputFiles()}
        assert opened == {str(d) for d in days if d and dt.date(2026, 3, 1) < d <= dt.date(2026, 3, 31)} and len(opened) < len(days)
        runs = [p.visible("dev")]
    # The scratch tables are gone; another session of the catalog reads the views.
    other = spark.newSession()
    assert "dev_unified.account_360" in views
    assert {t.name for t in other.catalog.listTables("dev_cleansed")} >= set(RESOLVED)
    assert other.table("dev_cleansed.activity").filter("activity_day is null").count() == 1     # the API key hint
    assert rows(other.table("dev_unified.prospects")) == rows(marts["prospects"])
    assert rows(other.table("dev_unified.account_360")) == rows(marts["account_360"])
    assert spark.table("dev_raw__stg_users").count() == 6
    for _ in range(2):
        with Pipeline(spark, {s: df.limit(0) for s, df in sources.items()}, CFG) as p:
            p.publish("dev")
            runs.append(p.visible("dev"))
    assert other.table("dev_unified.prospects").count() == 0
    # The run before stays, older ones are gone, days and rows without a day alike.
    assert sorted(set(runs)) == runs and p.visible("test") is None
    kept = {r[0].split("/")[0] for t in ("unified.quality__runs", "cleansed.activity__runs")
            for r in other.sql(f"SHOW PARTITIONS dev_{t}").collect()}
    assert kept <= {f"run={r}" for r in runs[1:]}
