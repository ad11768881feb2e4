from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from conftest import rows

from accountlens.config import DEFAULTS
from accountlens.plans import activity as A
from accountlens.plans.external import external_signals, one_stream
from accountlens.plans.trends import account_trace_trend, org_trace_trend, tracing_orgs
from accountlens.sources.rules import load_rules
from accountlens.sources.staging import delivered_schema, stage

CFG = replace(DEFAULTS, as_of_date="2026-03-31")


def staged(spark, source, data):
    return stage(spark.createDataFrame(data, delivered_schema(source)), source)


EXPERIMENTS = [
    # id, metadata, repo_info -> signal, actor, detail
    ("run_id", '{"ci_run_id":"r1"}', None, "code_ci_run", "automation", "metadata.ci_run_id present"),
    ("flag", '{"ci":"Yes"}', '{"dirty":true}', "code_ci_run", "automation", "metadata.ci = true"),
    ("flag_no", '{"ci":"no"}', None, "object_origin_unknown", "unknown", "no repo_info, no metadata tags"),
    ("source", '{"source":"CI-x"}', None, "code_ci_run", "automation", "metadata.source = CI-x"),
    ("author", None, '{"author_name":"Dependabot[bot]"}', "code_ci_run", "automation",
     "repo_info.author_name = Dependabot[bot]"),
    ("runner", None, '{"author_name":"my-ci-runner-2"}', "code_ci_run", "automation",
     "repo_info.author_name = my-ci-runner-2"),
    ("dirty", None, '{"dirty":true,"author_name":"kim"}', "code_repo_info", "human",
     "repo_info.dirty = true (uncommitted local run)"),
    ("clean", '{"source":"laptop"}', '{"dirty":false}', "code_repo_info", "human", "repo_info present, committed code"),
    ("odd_dirty", None, '{"dirty":"maybe"}', "code_repo_info", "human", "repo_info present, committed code"),
    ("server", '{"source":"lambda"}', None, "code_runtime_source", "automation",
     "metadata.source = lambda (server-side process)"),
    ("json_null", '{"source":null}', None, "object_origin_unknown", "unknown", "no repo_info, no metadata tags"),
    ("bad_json", '{"source":', " ", "object_origin_unknown", "unknown", "no repo_info, no metadata tags"),
]


def test_experiment_ladders(spark):
    df = staged(spark, "experiments", [(i, "p", "u", "2026-03-01", repo, meta) for i, meta, repo, *_ in EXPERIMENTS])
    got = {r.object_id: (r.signal_code, r.actor_type, r.evidence_detail) for r in A.experiments(df).collect()}
    assert got == {i: tuple(rest) for i, _, _, *rest in EXPERIMENTS}


def test_dataset_ladder(spark):
    data = [("a", "p", "u", None, '{"source":"ci_daily"}'), ("b", "p", "u", None, '{"source":"MANUAL"}'),
            ("c", "p", "u", None, '{"source":"upload"}'), ("d", "p", "u", None, None)]
    assert rows(A.datasets(staged(spark, "datasets", data)), "object_id", "signal_code", "actor_type", "evidence_detail") == [
        ("a", "code_ci_run", "automation", "metadata.source = ci_daily"),
        ("b", "object_origin_unknown", "human", "metadata.source = MANUAL"),
        ("c", "object_origin_unknown", "unknown", "metadata.source = upload"),
        ("d", "object_origin_unknown", "unknown", "no metadata")]


def sources(spark):
    keys = spark.createDataFrame([("k1", "u1", "o1", "My CLI", True), ("k2", "u1", "o1", "plain", False)],
                                 "api_key_id string, user_id string, org_id string, key_name string, is_cli_named boolean")
    return {
        "experiments": staged(spark, "experiments", [
            ("e1", "p1", "u1", "2026-03-10 10:00:00", None, None),
            ("e1", "p1", "u2", "2026-03-11 10:00:00", None, None),          # delivered again, later
            ("e2", "p_low", "u2", "2026-03-01", None, '{"source":"job"}'),  # last day outside the window
            ("e3", "p_amb", "u1", "2026-03-31 23:59:59", None, None),
            ("e4", "p_missing", "u1", "2026-04-01 00:00:00", None, None),
            (None, "p1", "u1", "2026-03-05", None, None), (None, "p1", "u1", "2026-03-05", None, None)]),
        "datasets": staged(spark, "datasets", [("d1", None, "u1", "2026-03-02", None)]),
        "prompts": staged(spark, "prompts", [("r1", "p1", "nobody", "2026-03-20")]),
        "segment_pages": staged(spark, "segment_pages", [
            ("x", "u1", "2026-03-20 08:00:00", "/a"), ("x", "u1", "2026-03-20 08:00:00", "/a"),
            ("x", "u1", "2026-03-20 08:00:00", None), (None, "u2", "2026-03-20 08:00:00.5", None),
            ("x", None, "2026-03-20 08:00:00", "/a")]),
        "cli_wizard": staged(spark, "cli_wizard", [("u1", "2026-03-20 09:00:00"), ("u1", None)]),
        "docs_mcp_events": staged(spark, "docs_mcp_events", [("u2", "2026-03-20 09:00:00", "install_mcp_server")]),
        "api_keys": keys,
    }


def activity(spark, cfg=CFG):
    events = A.classified_events(sources(spark)).cache()
    projects = spark.createDataFrame([("p1", "o1"), ("p_low", "o2"), ("p_amb", "o3")], "project_id string, org_id string")
    identity = spark.createDataFrame([("u1", "u1"), ("u2", "u2")], "user_id string, person_id string")
    people = spark.createDataFrame([("u1", "B", "resolved", 0.85), ("u2", None, "no_membership", None)],
                                   "person_id string, account_id string, resolution_status string, account_confidence double")
    orgs = spark.createDataFrame(
        [("o1", "A", "resolved", 0.95), ("o2", "C", "resolved_low_confidence", 0.5), ("o3", None, "ambiguous", None)],
        "org_id string, account_id string, resolution_status string, mapping_confidence double")
    return A.product_activity(events, projects, identity, people, orgs, load_rules(spark, "surface_signals"), cfg)


EXPECTED_ACTIVITY = [
    # id, account, attribution, confidence, surface, in lookback
    ("api_key:k1", "A", "org_account", 0.95, "cli", False),
    ("cli_wizard:u1:", "B", "single_account_member", 0.85, "cli", False),
    ("cli_wizard:u1:2026-03-20 09:00:00", "B", "single_account_member", 0.85, "cli", True),
    ("dataset:d1", "B", "single_account_member", 0.85, "unknown", True),
    ("docs_mcp:u2:2026-03-20 09:00:00:install_mcp_server", None, "person_no_membership", None, "mcp", True),
    ("experiment:e1", "A", "org_account", 0.95, "unknown", True),
    ("experiment:e2", "C", "org_account", 0.5, "sdk", False),
    ("experiment:e3", None, "org_ambiguous", None, "unknown", True),
    ("experiment:e4", "B", "single_account_member", 0.85, "unknown", False),
    ("page_view::u2:2026-03-20 08:00:00.5:", None, "person_no_membership", None, "ui", True),
    ("page_view:x:u1:2026-03-20 08:00:00:", "B", "single_account_member", 0.85, "ui", True),
    ("page_view:x:u1:2026-03-20 08:00:00:/a", "B", "single_account_member", 0.85, "ui", True),
    ("prompt:r1", "A", "org_account", 0.95, "unknown", True),
]


def test_activity_attribution(spark):
    columns = ["activity_id", "account_id", "account_attribution", "account_confidence", "surface", "is_in_lookback"]
    got = rows(activity(spark), *columns)
    assert [r for r in got if r[0]] == EXPECTED_ACTIVITY
    assert len([r for r in got if r[0] is None]) == 2           # objects without an id are kept apart


def test_first_delivery_wins(spark):
    assert rows(activity(spark).filter("activity_id = 'experiment:e1'"), "user_id") == [("u1",)]


KEYS = [("company", "c1", "Kite Works", "kite", True), ("company", "c2", "The Works", "the", False),
        ("account", "c1", "Not this", "not", True)]
RESOLUTION = [("c1", "A", "resolved", "linkedin_slug", 0.95, False), ("c2", None, "unmatched", None, None, False)]


def signals(spark, cfg=CFG):
    news = staged(spark, "news_events", [
        ("1", "c1", "Launches", "Kite Works launches Loft", "2026-03-02", "0.9", " Loft ", "s"),
        ("2", "c1", "hires", "Someone else hires", "2026-03-01", None, None, "s"),
        ("3", "c2", "hires", "No name at all", None, "0.5", "loft", "s"),
        ("4", "c9", "launches", "Unknown company", "2026-03-31", "0.5", "Loft", "s"),
        ("1", "c1", "Launches", "Kite Works launches Loft", "2026-03-03", "0.9", "Loft", "s")])
    products = staged(spark, "products", [
        ("1", "c1", "LOFT", "x", "2026-03-01", "s"), ("2", "c2", "Loft", "x", "2026-03-04", "s"),
        ("3", "c1", "Hangar", "x", "2026-03-04", "s"), ("4", None, "Loft", "x", "2026-03-04", "s")])
    tech = staged(spark, "tech_detections", [("1", "c1", "Loft", "2026-03-04", "0.7")])
    keys = spark.createDataFrame(KEYS, "entity_type string, entity_id string, entity_name string, "
                                       "name_first_token string, name_token_is_specific boolean")
    resolution = spark.createDataFrame(RESOLUTION, "company_id string, account_id string, resolution_status string, "
                                                   "match_method string, match_confidence double, needs_review boolean")
    return external_signals(one_stream(news, products, tech), keys, resolution, cfg)


def test_external_signals(spark):
    assert rows(signals(spark), "signal_id", "company_name", "is_corroborated_by_product_feed",
                "is_entity_mismatch", "is_in_lookback", "account_id") == [
        ("news:1", "Kite Works", True, False, True, "A"),
        ("news:2", "Kite Works", False, True, False, "A"),
        ("news:3", "The Works", False, False, None, None),         # not a launch; word too short to test
        ("news:4", None, False, False, True, None),
        ("product:2", "The Works", False, False, True, None),
        ("product:3", "Kite Works", False, False, True, "A"),
        ("product:4", None, False, False, True, None),
        ("tech:1", "Kite Works", False, False, True, "A")]


def test_earliest_copy_of_a_record_is_kept(spark):
    assert rows(signals(spark).filter("signal_id = 'news:1'"), "occurred_at") == [(dt.datetime(2026, 3, 2),)]


TRACES = [
    ("full", "2026-03-24", "10"), ("full", "2026-03-25", "1"), ("full", "2026-03-31", "6.5"), ("full", "2026-03-31", "6.5"),
    ("full", "2026-03-23", "99"), ("full", "2026-04-01", "99"),      # outside the closed window
    ("one", "2026-03-30", "4"), ("zero", "2026-03-24", "0"), ("zero", "2026-03-30", "4"), (None, "2026-03-30", "1"),
]


def test_org_trend(spark):
    trend = org_trace_trend(staged(spark, "trace_volume", TRACES), CFG)
    assert rows(trend, "org_id", "days_compared", "days_with_data", "gb_last_7d", "gb_baseline_day", "gb_last_day",
                "growth_7d") == [
        ("full", 7, 2, 14.0, 10.0, 13.0, 0.3), ("one", 0, 1, 4.0, 4.0, 4.0, 0.0), ("zero", 6, 1, 4.0, 0.0, 4.0, None)]


def test_account_trend(spark):
    trend = org_trace_trend(staged(spark, "trace_volume", TRACES), CFG)
    orgs = spark.createDataFrame([("full", "A"), ("one", "A"), ("zero", "B"), ("other", None)], "org_id string, account_id string")
    assert rows(account_trace_trend(trend, orgs, CFG), "account_id", "orgs_sending_traces",
                "trace_gb_last_7d", "trace_growth_7d", "is_usage_surge") == [
        ("A", 2, 18.0, 0.2143, False), ("B", 1, 4.0, None, False)]
    assert rows(tracing_orgs(trend, orgs), "account_id", "org_id") == [("A", "full"), ("A", "one"), ("B", "zero")]


def test_window_filter_reaches_the_scan_of_a_landed_table(spark, tmp_path):
    """A typed table keeps its columns, so the days of the window are a partition or pushed filter, and only they are read."""
    landed = spark.sql("SELECT concat('o', id % 7) AS org_id, date_add(DATE'2026-01-01', CAST(id % 90 AS INT)) AS ds, "
                       "1.0D AS ingested_gb FROM range(900)")
    landed.write.parquet(str(tmp_path / "plain"))
    landed.write.partitionBy("ds").parquet(str(tmp_path / "by_day"))
    expected = rows(org_trace_trend(stage(landed, "trace_volume"), CFG))
    for path, mark in (("plain", "PushedFilters: [IsNotNull(ds)"), ("by_day", "PartitionFilters: [isnotnull(ds")):
        trend = org_trace_trend(stage(spark.read.parquet(str(tmp_path / path)), "trace_volume"), CFG)
        plan = trend._jdf.queryExecution().executedPlan().toString()
        assert mark in plan
        assert rows(trend) == expected and expected


def test_the_as_of_day_can_be_today(spark):
    df = spark.sql("SELECT current_timestamp() AS t UNION ALL SELECT current_timestamp() - INTERVAL 60 DAYS")
    from accountlens.functions.measures import in_lookback
    from pyspark.sql import functions as F
    assert rows(df.select(in_lookback(F.col("t"), replace(DEFAULTS, as_of_date="today")))) == [(False,), (True,)]


def test_a_rule_table_of_too_many_surfaces_is_refused(spark, monkeypatch):
    from accountlens.plans import adoption
    from accountlens.sources.rules import load_rules

    monkeypatch.setattr(adoption, "MOST_SURFACES", 2)
    accounts = spark.createDataFrame([("a", "A")], "account_id string, account_name string")
    with pytest.raises(ValueError, match="more than 2 surfaces"):
        adoption.account_surface_adoption(accounts, accounts, accounts, accounts, load_rules(spark, "surface_signals"))
