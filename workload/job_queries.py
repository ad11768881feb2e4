"""The jobs over the derived feeds: name -> (Spark query, DuckDB statement)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.plans import check_suite as S
from accountlens.plans import reports
from accountlens.plans.pipeline import Pipeline
from accountlens.plans.trends import DailyVolume
from accountlens.sources.staging import DELIVERED
from workload import oracle_checks
from workload.feeds import CFG, feeds
from workload.oracle import statement
from workload.oracle_extracts import EXTRACTS

Query = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, tuple[Query, str]] = {}


_RUNS: dict[tuple, Pipeline] = {}


def _versions(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of change of every file below a folder, by Hadoop's file system."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    """One run per application and version of the input files.

    The resolved tables are written by the first query that reads them and read by the later ones, as
    a nightly build writes them for all reports of the day. Marts and reports are computed anew.
    """
    run = (spark.sparkContext.applicationId, sf_dir, _versions(spark, sf_dir))
    if run not in _RUNS:
        _RUNS[run] = Pipeline(spark, feeds(spark, sf_dir), CFG)
    return _RUNS[run]


def _plan(name: str) -> Query:
    return lambda spark, sf_dir: pipeline(spark, sf_dir).table(name)


# Registered name -> job.
_OUTPUTS = {
    "user_identity": "identity",
    "org_account_resolution": "org_accounts",
    "org_trace_trend": "org_trend",
    "account_trace_trend": "account_trend",
    "match_keys": "match_keys",
    "memberships": "memberships",
    "api_key_hints": "api_keys",
    "member_account_resolution": "people",
    "company_resolution": "companies",
    "product_activity": "activity",
    "external_signals": "signals",
    "member_surface_activity": "member_surfaces",
    "members": "members",
    "account_surface_adoption": "adoption",
    "account_signals": "feed",
    "signal_companies": "signal_companies",
    "account_360": "account_360",
    "net_new_prospects": "prospects",
    "resolution_quality": "quality",
    "cli_answer": "cli_answer",
}
for _name, _job in _OUTPUTS.items():
    JOBS[_name] = (_plan(_job), statement(f"SELECT * FROM {_job}"))

JOBS["match_candidates"] = (
    _plan("candidates"),
    statement("""
        SELECT DISTINCT company_id, match_method, matched_value, precedence, base_confidence, can_resolve,
               accounts_for_key, is_unique_for_key, CASE WHEN is_unique_for_key THEN account_id END AS sole_account,
               CASE match_method WHEN 'linkedin_slug' THEN 'slug' WHEN 'company_name' THEN 'name' ELSE 'domain' END AS key_type
        FROM candidates"""))

# The lists behind the counts of the wide tables: name -> (job, statement).
_LISTS = {
    "account_keys": """
        SELECT DISTINCT k.t AS key_type, k.v AS key_value, account_id FROM (
            SELECT entity_id AS account_id, unnest([{'t': 'slug', 'v': linkedin_slug}, {'t': 'domain', 'v': domain_key},
                {'t': 'name', 'v': name_key}]) AS k FROM match_keys WHERE entity_type = 'account') WHERE k.v IS NOT NULL""",
    "company_keys": """
        SELECT DISTINCT company_id, k.m AS match_method, k.t AS key_type, k.v AS key_value FROM (
            SELECT entity_id AS company_id, unnest([
                {'m': 'linkedin_slug', 't': 'slug', 'v': linkedin_slug}, {'m': 'website_domain', 't': 'domain', 'v': domain_key},
                {'m': 'linkedin_domain', 't': 'domain', 'v': second_domain_key}, {'m': 'company_name', 't': 'name', 'v': name_key}]) AS k
            FROM match_keys WHERE entity_type = 'company') WHERE k.v IS NOT NULL""",
    "org_candidates": """
        SELECT org_id, account_id, src AS mapping_source, confidence AS mapping_confidence, precedence, in_crm FROM org_links""",
    "person_logins": "SELECT DISTINCT person_id, user_id FROM identity",
    "person_orgs": "SELECT DISTINCT person_id, org_id FROM memberships",
    "person_accounts": "SELECT DISTINCT person_id, account_id FROM memberships WHERE account_id IS NOT NULL",
    "person_api_keys": """
        SELECT DISTINCT person_id, key_name FROM api_keys WHERE person_id IS NOT NULL AND key_name IS NOT NULL""",
    "account_orgs": "SELECT DISTINCT account_id, org_id FROM org_accounts WHERE account_id IS NOT NULL",
    "account_tracing_orgs": """
        SELECT o.account_id, t.org_id FROM org_trend t JOIN org_accounts o USING (org_id) WHERE o.account_id IS NOT NULL""",
    "account_tech": """
        SELECT DISTINCT account_id, product_name FROM signals
        WHERE signal_family = 'tech' AND resolution_status = 'resolved' AND product_name IS NOT NULL""",
    "action_reasons": """
        SELECT account_id, signal_confidence, occurred_at, signal_id, headline FROM feed
        WHERE is_actionable AND headline IS NOT NULL""",
}
for _name, _sql in _LISTS.items():
    JOBS[_name] = (_plan(_name), statement(_sql))


def job(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        JOBS[f.__name__] = (f, statement(sql))
        return f
    return register


@job("""SELECT a.entity_id AS account_id, coalesce(q.pending, 0) AS pending, coalesce(q.awaiting, 0) AS awaiting
        FROM match_keys a LEFT JOIN review_queue q ON q.account_id = a.entity_id WHERE a.entity_type = 'account'""")
def review_queue(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    sizes = p.table("review_queue")
    return p.table("account_names").select("account_id").join(sizes, "account_id", "left").select(
        "account_id", F.coalesce("external_records_pending_review", F.lit(0)).alias("pending"),
        F.coalesce("external_records_awaiting_confirmation", F.lit(0)).alias("awaiting"))


@job("""SELECT signal_code, surface, evidence_kind, attribution, confidence_score, actor_type, count(*) AS events
        FROM activity GROUP BY ALL""")
def surface_summary(spark, sf_dir):
    return reports.surface_summary(pipeline(spark, sf_dir).table("activity"))


@job("""SELECT surface, attribution, count(*) AS objects FROM activity
        WHERE activity_type IN ('experiment', 'dataset', 'prompt') GROUP BY ALL""")
def object_summary(spark, sf_dir):
    return reports.object_summary(pipeline(spark, sf_dir).table("activity"))


class _Tables(dict):
    """Tables of a pipeline by the names the extracts use, computed when asked for."""

    def __init__(self, p: Pipeline):
        super().__init__()
        self.p = p

    def __missing__(self, name: str) -> DataFrame:
        return self.p.table({"orgs": "org_accounts"}.get(name, name))


for _name in reports.EXTRACTS:
    JOBS[f"extract_{_name}"] = (
        (lambda n: lambda spark, sf_dir: reports.review_extract(n, _Tables(pipeline(spark, sf_dir))))(_name),
        statement(EXTRACTS[_name]))


_STAGED = sorted(DELIVERED)

# Staged columns whose content is compared, where it is not all of them: opened JSON instead of its text.
_CONTENT = {
    "experiments": "experiment_id, project_id, user_id, created_at, has_repo_info, repo_commit, repo_branch, repo_is_dirty, "
                   "repo_author_name, repo_commit_time, meta_eval_name, meta_model, meta_source, meta_ci_run_id, meta_ci_flag",
    "datasets": "dataset_id, project_id, user_id, created_at, meta_source",
}


def _staged_content(source: str) -> Query:
    columns = [c.strip() for c in _CONTENT.get(source, "*").split(",")]
    return lambda spark, sf_dir: pipeline(spark, sf_dir).staged(source).select(*columns)


for _name in _STAGED:
    JOBS[f"staged_{_name}"] = (_staged_content(_name), statement(f"SELECT {_CONTENT.get(_name, '*')} FROM stg_{_name}"))


@job(" UNION ALL ".join(f"SELECT 'stg_{s}' AS table_name, count(*) AS rows FROM stg_{s}" for s in _STAGED))
def staged_row_counts(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return reports.table_row_counts({f"stg_{s}": p.staged(s) for s in _STAGED})


@job(" UNION ALL ".join(f"SELECT '{s}' AS source, count(*) AS rows_in, count(*) AS rows_staged, 0 AS rows_rejected FROM stg_{s}" for s in _STAGED))
def staging_balance(spark, sf_dir):
    """All records of the 18 sources are staged: none of their cells is wrong."""
    return pipeline(spark, sf_dir).staging_balance()


@job("SELECT * FROM org_trend")
def org_trace_trend_by_days(spark, sf_dir):
    """The trend from daily sums that are kept: first without the rows of small volume, which then come late."""
    p = pipeline(spark, sf_dir)
    volume = p.staged("trace_volume")
    kept = DailyVolume(spark, f"{p.scratch.folder}/daily-{uuid.uuid4().hex[:8]}")
    kept.refresh(volume.filter("ingested_gb >= 1"))
    kept.refresh(volume, volume.filter("NOT ingested_gb >= 1"))
    return kept.trend(CFG)


# Delivered cells of each source as conditions on its staged columns: null where the cell is null or blank.
_CELLS = {
    "account_org_map": ["org_id", "account_id", "mapping_source"],
    "api_keys": ["api_key_id", "user_id", "org_id", "key_hash", "key_name"],
    "cli_wizard": ["user_id", "event_at"],
    "datasets": ["dataset_id", "project_id", "user_id", "created_at", "meta_source"],
    "docs_mcp_events": ["user_id", "event_at", "action"],
    "experiments": ["experiment_id", "project_id", "user_id", "created_at", "repo_info_json",
                    "coalesce(meta_eval_name, meta_model, meta_source, meta_ci_run_id)"],
    "members": ["org_id", "user_id", "member_created_at"],
    "news_events": ["news_id", "company_id", "category", "summary", "found_at", "vendor_confidence", "product_name",
                    "source_url"],
    "organizations": ["org_id", "org_name", "created_at", "plan"],
    "products": ["product_id", "company_id", "product_name", "category", "first_seen_at", "source_url"],
    "projects": ["project_id", "org_id", "project_name"],
    "prompts": ["prompt_id", "project_id", "user_id", "created_at"],
    "salesforce_accounts": ["account_id", "account_name", "domain", "linkedin_company_url", "ticker"],
    "segment_pages": ["anonymous_id", "user_id", "viewed_at", "page_path"],
    "signal_companies": ["company_id", "company_name", "company_website", "linkedin_url", "linkedin_domain"],
    "tech_detections": ["detection_id", "company_id", "technology_name", "first_seen_at", "vendor_score"],
    "trace_volume": ["org_id", "activity_date", "ingested_gb"],
    "users": ["user_id", "email", "created_at"],
}


def _totals_sql() -> str:
    profile = " UNION ALL ".join(
        f"""SELECT count(*) AS n, {len(cells)} AS columns, {' + '.join(
            f"count(*) FILTER (WHERE {c} IS NULL)" for c in cells)} AS empty FROM stg_{s}"""
        for s, cells in _CELLS.items())
    return f"""
        SELECT CAST(sum(n) AS BIGINT) AS source_rows, CAST(sum(columns) AS BIGINT) AS source_columns,
               (SELECT count(*) FILTER (WHERE activity_type IN ('experiment', 'dataset', 'prompt')) FROM activity) AS objects,
               (SELECT count(*) FROM activity) AS activities, (SELECT count(account_id) FROM activity) AS attributed,
               CAST(sum(empty) AS BIGINT) AS null_cells, CAST(sum(n * columns) AS BIGINT) AS cells FROM ({profile})"""


@job(_totals_sql())
def totals(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    profile = reports.column_profiles({s: p.sources[s] for s in sorted(DELIVERED)})
    return reports.totals(p.table("activity"), profile)


def _report_sql(checks: list[tuple[str, str, str, str]], cross: dict[str, str] | None = None) -> str:
    rows = [f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{severity}' AS severity, "
            f"CAST(({count}) AS BIGINT) AS failing_rows" for name, table, severity, count in checks]
    rows += [f"SELECT '{n}', '', 'error', CAST(({q}) AS BIGINT)" for n, q in (cross or {}).items()]
    return f"""SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
               FROM ({' UNION ALL '.join(rows)})"""


_CROSS_SQL = {
    "no_signal_lost_between_layers": """
        SELECT CASE WHEN (SELECT count(*) FROM stg_news_events) + (SELECT count(*) FROM stg_products)
             + (SELECT count(*) FROM stg_tech_detections) = (SELECT count(*) FROM signals)
             + (SELECT count(DISTINCT dropped) FROM launch_pairs) THEN 0 ELSE 1 END""",
    "every_company_has_one_exit": """
        SELECT count(*) FROM signal_companies c WHERE (c.next_action = 'net_new_prospect') <>
            (('external:' || c.company_id) IN (SELECT prospect_id FROM prospects))""",
    "every_person_has_every_surface": """
        SELECT count(*) FROM people p WHERE 5 <> (SELECT count(DISTINCT surface) FROM member_surfaces m
                                                  WHERE m.person_id = p.person_id)""",
    "objects_follow_their_project": """
        SELECT count(*) FROM activity a JOIN stg_projects p USING (project_id) JOIN org_accounts o ON o.org_id = p.org_id
        WHERE o.account_id IS NOT NULL AND a.account_id IS DISTINCT FROM o.account_id""",
    "automation_never_counted_as_active": """
        SELECT count(*) FROM account_360 a WHERE a.active_members_in_lookback > a.known_members -
            (SELECT count(DISTINCT m.person_id) FROM memberships m JOIN members d USING (person_id)
             WHERE m.account_id = a.account_id AND d.member_type = 'automation_identity')""",
}


@job(_report_sql(oracle_checks.STAGING))
def checks_staging(spark, sf_dir):
    return S.check_report(S.STAGING_CHECKS + S.RULE_CHECKS, pipeline(spark, sf_dir).table)


@job(_report_sql(oracle_checks.RESOLVED))
def checks_resolved(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return S.check_report(S.RESOLVED_CHECKS, p.saved, counts=p.counts)


@job(_report_sql(oracle_checks.MARTS, _CROSS_SQL))
def checks_marts(spark, sf_dir):
    """Each mart is written once in a run; its checks on single rows are counted then."""
    p = pipeline(spark, sf_dir)
    return S.check_report(S.MART_CHECKS, p.saved, S.cross_checks(p.saved), p.counts)
