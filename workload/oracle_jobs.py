"""The jobs as DuckDB SQL over the staged feeds, written straight from the rules.

Companies are resolved here by listing every company-account pair, which the Spark jobs never do.
Every entry is one CTE; ``oracle.py`` puts together those a query needs.
"""

from __future__ import annotations

AS_OF = "DATE '2024-01-30'"

# Surfaces in reading order, and what can be seen of each.
SURFACES = [
    ("ui", 1, "Observable: logged-in page views (raw_segment_pages.user_id)"),
    ("sdk", 2, "Observable: repo_info / CI tags on objects, trace ingestion at org level. Cannot be split from CLI"),
    ("cli", 3, "Not observable: only setup-wizard views and API key names (intent)"),
    ("mcp", 4, "Not observable: only docs install/copy clicks (intent)"),
    ("unknown", 5, "Objects with no origin metadata: UI, or SDK outside a git repo"),
]

# Number, input, area, wording, what is counted, out of what.
METRICS = [
    (1, "identity", "identity", "Logins merged into an existing person (exact email)", "is_secondary_login", "true"),
    (2, "orgs", "identity", "Product orgs mapped to a Salesforce account", "account_id is not null", "true"),
    (3, "orgs", "identity", "Mapped orgs whose link is low confidence (fallback)",
     "resolution_status = 'resolved_low_confidence'", "account_id is not null"),
    (4, "people", "identity", "People resolved to exactly one account", "resolution_status = 'resolved'", "true"),
    (5, "people", "identity", "People flagged ambiguous (belong to 2+ accounts)", "is_ambiguous", "true"),
    (6, "activity", "activity", "Product activities attributed to an account", "account_id is not null", "true"),
    (7, "pages", "activity", "Page views that are anonymous (cannot be attributed)", "user_id is null", "true"),
    (8, "activity", "activity", "Objects whose creating surface is unknown",
     "surface = 'unknown'", "activity_type in ('experiment', 'dataset', 'prompt')"),
    (9, "activity", "activity", "Objects created by automation (CI / production jobs)",
     "actor_type = 'automation'", "activity_type in ('experiment', 'dataset', 'prompt')"),
    (10, "companies", "external", "External companies resolved to an account",
     "resolution_status = 'resolved'", "true"),
    (11, "companies", "external", "Resolved companies confirmed by 2+ independent keys (distinct values)",
     "resolution_status = 'resolved' and unique_keys_agreeing >= 2", "resolution_status = 'resolved'"),
    (12, "companies", "external", "Resolved companies whose name also agrees (audit proxy)",
     "name_agrees_with_match", "resolution_status = 'resolved'"),
    (13, "companies", "external", "External companies in conflict (keys disagree)",
     "resolution_status = 'conflict'", "true"),
    (14, "companies", "external", "External companies left unresolved (any reason)",
     "resolution_status <> 'resolved'", "true"),
    (15, "signals", "external", "External signals attached to an account", "account_id is not null", "true"),
    (16, "signals", "external", "News headlines that name a different company (entity mismatch)",
     "is_entity_mismatch", "signal_family = 'news'"),
    (17, "accounts", "crm", "Salesforce accounts with no domain and no LinkedIn", "has_no_match_keys", "true"),
    (18, "accounts", "crm", "Salesforce accounts sharing a domain with another account", "is_domain_shared", "true"),
    (19, "companies", "external", "Resolved companies whose name points at a different account (held for review)",
     "needs_review", "resolution_status = 'resolved'"),
]


def half_up(x: str, digits: int = 4) -> str:
    """Round half away from zero on the decimal value, as Spark does."""
    return f"CAST(round(CAST({x} AS DECIMAL(30, 12)), {digits}) AS DOUBLE)"


def recent(ts: str) -> str:
    return f"(CAST({ts} AS DATE) BETWEEN {AS_OF} - 29 AND {AS_OF})"


def count_if(p: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {p}) AS BIGINT)"


def any_of(p: str) -> str:
    return f"coalesce(bool_or({p}), false)"


def listed(x: str, sep: str = ", ") -> str:
    return f"array_to_string(list_sort(list_distinct(list({x}) FILTER (WHERE {x} IS NOT NULL))), '{sep}')"


def _host(x: str) -> str:
    plain = f"replace(replace(lower(trim({x})), 'https://', ''), 'http://', '')"
    cut = rf"regexp_extract(regexp_replace({plain}, '^www\.', ''), '^[^/?#:]*')"
    return rf"nullif(regexp_replace({cut}, '\.$', ''), '')"


_WORDS = (
    "trim(regexp_replace(trim(translate(lower(trim(entity_name)), '-.,()''', ' ')), "
    "' (incorporated|corporation|company|limited|gmbh|corp|inc|llc|ltd|plc|co)$', ''))"
)
_SURFACE_ROWS = ", ".join(f"('{s}', {o}, '{w}')" for s, o, w in SURFACES)
_SIGNAL_RULES = """(VALUES
    ('ui_page_view', 'ui', 'usage', 'deterministic', 0.95::DOUBLE),
    ('code_repo_info', 'sdk', 'usage', 'deterministic', 0.90),
    ('code_ci_run', 'sdk', 'usage', 'deterministic', 0.90),
    ('code_runtime_source', 'sdk', 'usage', 'heuristic', 0.60),
    ('object_origin_unknown', 'unknown', 'usage', 'none', 0.00),
    ('cli_setup_wizard', 'cli', 'intent', 'heuristic', 0.30),
    ('cli_key_name_hint', 'cli', 'intent', 'heuristic', 0.20),
    ('mcp_docs_click', 'mcp', 'intent', 'heuristic', 0.30),
    ('org_trace_ingestion', 'sdk', 'usage', 'deterministic', 0.85)
) AS r(signal_code, surface, evidence_kind, attribution, confidence_score)"""

_EVENT_COLUMNS = ("activity_id, source_table, activity_type, object_id, user_id, project_id, direct_org_id, "
                  "activity_at, signal_code, actor_type, evidence_detail")
_CI_WHY = """CASE WHEN meta_ci_run_id IS NOT NULL THEN 'metadata.ci_run_id present'
    WHEN lower(meta_ci_flag) IN ('true', '1', 'yes') THEN 'metadata.ci = true'
    WHEN starts_with(lower(meta_source), 'ci') THEN 'metadata.source = ' || meta_source
    WHEN regexp_matches(lower(repo_author_name), 'ci-runner|\\[bot\\]')
    THEN 'repo_info.author_name = ' || repo_author_name END"""

JOBS: dict[str, str] = {
    "rule_org_mapping_sources": """
        SELECT * FROM (VALUES ('contract', 0.95, 1), ('billing_parent', 0.85, 2), ('org_c_fallback', 0.5, 3))
            AS r(mapping_source, confidence_score, precedence)""",
    "rule_external_match_rules": """
        SELECT * FROM (VALUES ('linkedin_slug', 1, 0.9, true), ('website_domain', 2, 0.85, true),
            ('linkedin_domain', 3, 0.75, true), ('company_name', 99, 0.0, false))
            AS r(match_method, precedence, base_confidence, can_resolve)""",
    "rule_surface_signals": f"SELECT * FROM {_SIGNAL_RULES}",
    "surface_names": f"SELECT * FROM (VALUES {_SURFACE_ROWS}) AS s(surface, surface_order, what_we_can_see)",

    # ------------------------------------------------------------------ people
    "identity": """
        SELECT u.user_id, g.person_id, u.email, lower(trim(u.email)) AS email_normalized,
               split_part(lower(trim(u.email)), '@', 2) AS email_domain, u.created_at, g.n AS logins_for_person,
               g.n >= 2 AS is_duplicate_login, u.user_id <> g.person_id AS is_secondary_login,
               if(g.n >= 2, 'exact_email_match', 'single_login') AS person_resolution_method
        FROM stg_users u JOIN (
            SELECT coalesce(lower(trim(email)), user_id) AS k, count(*) AS n,
                   first(user_id ORDER BY created_at NULLS LAST, user_id) AS person_id
            FROM stg_users GROUP BY k) g ON g.k = coalesce(lower(trim(u.email)), u.user_id)""",
    "org_links": """
        SELECT m.org_id, m.account_id, arg_min(m.src, m.precedence) AS src, min(m.precedence) AS precedence,
               arg_min(m.confidence, m.precedence) AS confidence, bool_or(a.account_id IS NOT NULL) AS in_crm
        FROM (SELECT org_id, account_id, lower(mapping_source) AS src,
                     CASE lower(mapping_source) WHEN 'contract' THEN 0.95 WHEN 'billing_parent' THEN 0.85
                          WHEN 'org_c_fallback' THEN 0.5 ELSE 0.3 END::DOUBLE AS confidence,
                     CASE lower(mapping_source) WHEN 'contract' THEN 1 WHEN 'billing_parent' THEN 2
                          WHEN 'org_c_fallback' THEN 3 ELSE 99 END AS precedence
              FROM stg_account_org_map) m
        LEFT JOIN stg_salesforce_accounts a ON a.account_id = m.account_id
        GROUP BY m.org_id, m.account_id""",
    "org_accounts": f"""
        WITH g AS (
            SELECT org_id, count(DISTINCT account_id) AS n,
                   first(struct_pack(a := account_id, s := src, c := confidence, ok := in_crm)
                         ORDER BY precedence, account_id NULLS LAST) AS best
            FROM org_links GROUP BY org_id)
        SELECT o.org_id, o.org_name, lower(o.plan) AS plan,
               coalesce(list_position(['free', 'pro', 'enterprise'], lower(o.plan)), 0)::INTEGER AS plan_rank, o.created_at,
               CASE WHEN g.n = 1 AND g.best.ok THEN g.best.a END AS account_id,
               CASE WHEN g.n = 1 THEN g.best.s END AS mapping_source,
               CASE WHEN g.n = 1 THEN g.best.c END AS mapping_confidence,
               coalesce(g.n, 0) AS candidate_account_count,
               coalesce(g.n > 1, false) AS is_ambiguous,
               CASE WHEN g.n IS NULL THEN 'unmapped' WHEN g.n > 1 THEN 'ambiguous' WHEN NOT g.best.ok THEN 'broken_link'
                    WHEN g.best.c < 0.7 THEN 'resolved_low_confidence' ELSE 'resolved' END AS resolution_status
        FROM stg_organizations o LEFT JOIN g USING (org_id)""",
    "memberships": """
        SELECT i.person_id, m.org_id, min(m.member_created_at) AS first_member_created_at, count(*) AS logins_in_org,
               any_value(o.account_id) AS account_id, any_value(o.resolution_status) AS org_resolution_status,
               any_value(o.mapping_confidence) AS mapping_confidence
        FROM stg_members m JOIN identity i USING (user_id) LEFT JOIN org_accounts o ON o.org_id = m.org_id
        GROUP BY i.person_id, m.org_id""",
    "people": f"""
        WITH p AS (
            SELECT person_id, max(email_normalized) AS email, max(email_domain) AS email_domain, count(*) AS login_count,
                   min(created_at) AS first_login_created_at
            FROM identity GROUP BY person_id),
        m AS (
            SELECT person_id, count(*) AS orgs, count(DISTINCT account_id) AS accts, any_value(account_id) AS one, count(*) - count(account_id) AS unmapped,
                   min(mapping_confidence) AS weakest
            FROM memberships GROUP BY person_id)
        SELECT p.*, coalesce(m.orgs, 0) AS org_count, coalesce(m.accts, 0) AS account_count,
               CASE WHEN m.accts = 1 AND m.unmapped = 0 THEN m.one END AS account_id,
               CASE WHEN m.accts = 1 AND m.unmapped = 0 THEN m.weakest END AS account_confidence,
               coalesce(m.unmapped > 0, false) AS has_unmapped_org, coalesce(m.accts > 1, false) AS is_ambiguous,
               CASE WHEN m.orgs IS NULL THEN 'no_membership' WHEN m.accts = 0 THEN 'org_not_mapped'
                    WHEN m.accts > 1 THEN 'ambiguous_multi_account' WHEN m.unmapped > 0 THEN 'partially_mapped'
                    ELSE 'resolved' END AS resolution_status
        FROM p LEFT JOIN m USING (person_id)""",
    "api_keys": """
        SELECT k.api_key_id, i.person_id, k.user_id, k.org_id, k.key_hash, k.key_name,
               contains(lower(k.key_name), 'cli') AS is_cli_named,
               regexp_matches(lower(k.key_name), '^ci-|-ci$|service|bot') AS is_automation_named
        FROM stg_api_keys k LEFT JOIN identity i USING (user_id)""",

    # ------------------------------------------------------------------ traces
    "org_trend": f"""
        WITH d AS (
            SELECT org_id, activity_date AS day, sum(ingested_gb) AS gb FROM stg_trace_volume
            WHERE activity_date BETWEEN {AS_OF} - 7 AND {AS_OF} GROUP BY ALL),
        g AS (
            SELECT org_id, min(day) AS baseline_day, max(day) AS last_day,
                   count(*) FILTER (WHERE day > {AS_OF} - 7) AS days_with_data,
                   coalesce(sum(gb) FILTER (WHERE day > {AS_OF} - 7), 0) AS total,
                   arg_min(gb, day) AS b, arg_max(gb, day) AS l
            FROM d GROUP BY org_id)
        SELECT org_id, baseline_day, last_day, CAST(last_day - baseline_day AS INTEGER) AS days_compared, days_with_data,
               {half_up('total', 2)} AS gb_last_7d, b AS gb_baseline_day, l AS gb_last_day,
               CASE WHEN b > 0 THEN {half_up('(l - b) / b')} END AS growth_7d
        FROM g""",
    "account_trend": f"""
        WITH g AS (
            SELECT o.account_id, count(*) AS n, sum(t.gb_last_7d) AS total,
                   sum(t.gb_baseline_day) AS b, sum(t.gb_last_day) AS l, max(t.last_day) AS last_day
            FROM org_trend t JOIN org_accounts o USING (org_id) WHERE o.account_id IS NOT NULL GROUP BY o.account_id)
        SELECT account_id, n AS orgs_sending_traces, {half_up('total', 2)} AS trace_gb_last_7d,
               b AS gb_baseline_day, l AS gb_last_day, last_day,
               CASE WHEN b > 0 THEN {half_up('(l - b) / b')} END AS trace_growth_7d,
               coalesce(CASE WHEN b > 0 THEN (l - b) / b END >= 0.25, false) AS is_usage_surge
        FROM g""",

    # --------------------------------------------------------------- companies
    "match_keys": f"""
        WITH e AS (
            SELECT 'account' AS entity_type, account_id AS entity_id, account_name AS entity_name, domain AS w,
                   linkedin_company_url AS l, NULL::VARCHAR AS d2, ticker AS t FROM stg_salesforce_accounts
            UNION ALL
            SELECT 'company', company_id, company_name, company_website, linkedin_url, linkedin_domain, NULL
            FROM stg_signal_companies),
        k AS (
            SELECT entity_type, entity_id, entity_name, {_host('w')} AS domain_key, {_host('d2')} AS second_domain_key,
                   nullif(regexp_extract(lower(trim(l)), '/company/([^/?#]*)', 1), '') AS linkedin_slug,
                   nullif(replace({_WORDS}, ' ', ''), '') AS name_key, nullif(string_split({_WORDS}, ' ')[1], '') AS name_first_token,
                   upper(t) AS ticker, CASE WHEN contains(t, ':') THEN upper(string_split(t, ':')[1]) END AS ticker_exchange,
                   upper(CASE WHEN contains(t, ':') THEN string_split(t, ':')[2] ELSE t END) AS ticker_symbol
            FROM e)
        SELECT k.*, coalesce(length(name_first_token) > 3, false) AS name_token_is_specific,
               domain_key IS NULL AS is_missing_domain, linkedin_slug IS NULL AS is_missing_linkedin,
               domain_key IS NULL AND linkedin_slug IS NULL AS has_no_match_keys,
               (entity_type, domain_key) IN (SELECT (entity_type, domain_key) FROM k WHERE domain_key IS NOT NULL
                   GROUP BY entity_type, domain_key HAVING count(*) > 1) AND domain_key IS NOT NULL AS is_domain_shared,
               (entity_type, linkedin_slug) IN (SELECT (entity_type, linkedin_slug) FROM k WHERE linkedin_slug IS NOT NULL
                   GROUP BY entity_type, linkedin_slug HAVING count(*) > 1) AND linkedin_slug IS NOT NULL AS is_linkedin_shared
        FROM k""",
    "account_names": "SELECT entity_id AS account_id, entity_name AS account_name FROM match_keys WHERE entity_type = 'account'",
    "candidates": """
        WITH probe AS (
            SELECT entity_id AS company_id, unnest([
                {'m': 'linkedin_slug', 't': 'slug', 'v': linkedin_slug}, {'m': 'website_domain', 't': 'domain', 'v': domain_key},
                {'m': 'linkedin_domain', 't': 'domain', 'v': second_domain_key}, {'m': 'company_name', 't': 'name', 'v': name_key}]) AS p
            FROM match_keys WHERE entity_type = 'company'),
        target AS (
            SELECT entity_id AS account_id, unnest([{'t': 'slug', 'v': linkedin_slug}, {'t': 'domain', 'v': domain_key},
                {'t': 'name', 'v': name_key}]) AS k
            FROM match_keys WHERE entity_type = 'account'),
        pairs AS (
            SELECT DISTINCT company_id, p.m AS match_method, p.v AS matched_value, account_id
            FROM probe JOIN target ON p.t = k.t AND p.v = k.v)
        SELECT company_id, match_method, matched_value, account_id,
               list_position(['linkedin_slug', 'website_domain', 'linkedin_domain'], match_method) AS pos,
               coalesce(pos, 99)::INTEGER AS precedence,
               coalesce([0.9, 0.85, 0.75][pos], 0)::DOUBLE AS base_confidence, pos IS NOT NULL AS can_resolve,
               count(*) OVER w AS accounts_for_key, count(*) OVER w = 1 AS is_unique_for_key
        FROM pairs WINDOW w AS (PARTITION BY company_id, match_method)""",
    "companies": f"""
        WITH best AS (
            SELECT company_id, arg_min(struct_pack(a := account_id, m := match_method, c := base_confidence), precedence) AS w
            FROM candidates WHERE can_resolve AND is_unique_for_key GROUP BY company_id),
        facts AS (
            SELECT d.company_id, any_value(b.w) AS w, count(DISTINCT match_method) AS keys_matched,
                   count(DISTINCT match_method) FILTER (WHERE account_id = b.w.a) AS keys_agreeing,
                   count(DISTINCT matched_value) FILTER (WHERE account_id = b.w.a AND is_unique_for_key) AS unique_keys_agreeing,
                   {listed("match_method || '=' || matched_value || ' -> ' || if(is_unique_for_key, account_id, accounts_for_key || ' accounts')")}
                       AS match_evidence
            FROM candidates d LEFT JOIN best b USING (company_id) WHERE can_resolve GROUP BY d.company_id),
        hint AS (
            SELECT company_id, account_id AS h FROM candidates WHERE match_method = 'company_name' AND is_unique_for_key),
        s AS (
            SELECT k.entity_id AS company_id, k.entity_name AS company_name, k.domain_key AS website_domain, k.linkedin_slug,
                   k.second_domain_key AS linkedin_domain, k.is_domain_shared AS is_website_shared_in_feed, f.* EXCLUDE (company_id),
                   hint.h, coalesce(hint.h <> f.w.a, false) AS contradicts,
                   CASE WHEN k.domain_key IS NULL AND k.linkedin_slug IS NULL AND k.second_domain_key IS NULL THEN 'no_identifiers'
                        WHEN f.company_id IS NULL THEN 'unmatched' WHEN f.w IS NULL THEN 'ambiguous'
                        WHEN f.keys_matched > f.keys_agreeing THEN 'conflict' ELSE 'resolved' END AS resolution_status
            FROM match_keys k LEFT JOIN facts f ON f.company_id = k.entity_id LEFT JOIN hint ON hint.company_id = k.entity_id
            WHERE k.entity_type = 'company')
        SELECT company_id, company_name, website_domain, linkedin_slug, linkedin_domain, resolution_status,
               CASE resolution_status WHEN 'resolved' THEN w.a END AS account_id,
               CASE resolution_status WHEN 'resolved' THEN w.m END AS match_method,
               CASE resolution_status WHEN 'resolved' THEN {half_up(
                   'least(0.99, w.c + if(unique_keys_agreeing > 1, 0.05, 0) - if(contradicts, 0.2, 0))', 2)} END AS match_confidence,
               resolution_status = 'resolved' AND contradicts AS needs_review, resolution_status = 'conflict' AS is_conflict,
               coalesce(keys_matched, 0) AS keys_matched, coalesce(keys_agreeing, 0) AS keys_agreeing,
               coalesce(unique_keys_agreeing, 0) AS unique_keys_agreeing, match_evidence,
               h AS name_match_account_id, CASE resolution_status WHEN 'resolved' THEN coalesce(h = w.a, false) END AS name_agrees_with_match,
               is_website_shared_in_feed,
               CASE WHEN resolution_status = 'resolved' THEN if(contradicts, 'confirm_match', 'attach_to_account')
                    WHEN resolution_status IN ('conflict', 'ambiguous') OR h IS NOT NULL THEN 'steward_review'
                    WHEN resolution_status = 'unmatched' THEN 'net_new_prospect' ELSE 'enrich_identifiers' END AS next_action
        FROM s""",

    # ---------------------------------------------------------------- activity
    "events_raw": f"""
        WITH x AS (SELECT *, {_CI_WHY} AS ci FROM stg_experiments)
        SELECT 'experiment:' || experiment_id AS activity_id, 'raw_experiments' AS source_table, 'experiment' AS activity_type,
               experiment_id AS object_id, user_id, project_id, NULL::VARCHAR AS direct_org_id, created_at AS activity_at,
               CASE WHEN ci IS NOT NULL THEN 'code_ci_run' WHEN has_repo_info THEN 'code_repo_info'
                    WHEN meta_source IS NOT NULL THEN 'code_runtime_source' ELSE 'object_origin_unknown' END AS signal_code,
               CASE WHEN ci IS NOT NULL THEN 'automation' WHEN has_repo_info THEN 'human'
                    WHEN meta_source IS NOT NULL THEN 'automation' ELSE 'unknown' END AS actor_type,
               CASE WHEN ci IS NOT NULL THEN ci WHEN repo_is_dirty THEN 'repo_info.dirty = true (uncommitted local run)'
                    WHEN has_repo_info THEN 'repo_info present, committed code'
                    WHEN meta_source IS NOT NULL THEN 'metadata.source = ' || meta_source || ' (server-side process)'
                    ELSE 'no repo_info, no metadata tags' END AS evidence_detail
        FROM x
        UNION ALL BY NAME
        SELECT 'dataset:' || dataset_id AS activity_id, 'raw_datasets' AS source_table, 'dataset' AS activity_type,
               dataset_id AS object_id, user_id, project_id, created_at AS activity_at,
               if(coalesce(meta_source LIKE 'ci%', false), 'code_ci_run', 'object_origin_unknown') AS signal_code,
               CASE lower(meta_source) WHEN 'manual' THEN 'human' WHEN 'ci-nightly' THEN 'automation' ELSE 'unknown' END AS actor_type,
               coalesce('metadata.source = ' || meta_source, 'no metadata') AS evidence_detail
        FROM stg_datasets
        UNION ALL BY NAME
        SELECT 'prompt:' || prompt_id AS activity_id, 'raw_prompts' AS source_table, 'prompt' AS activity_type,
               prompt_id AS object_id, user_id, project_id, created_at AS activity_at, 'object_origin_unknown' AS signal_code,
               'unknown' AS actor_type, 'prompts carry no origin metadata' AS evidence_detail
        FROM stg_prompts
        UNION ALL BY NAME
        SELECT concat_ws(':', 'page_view', coalesce(anonymous_id, ''), user_id, CAST(viewed_at AS VARCHAR), coalesce(page_path, '')) AS activity_id,
               'raw_segment_pages' AS source_table, 'page_view' AS activity_type, page_path AS object_id, user_id,
               viewed_at AS activity_at, 'ui_page_view' AS signal_code, 'human' AS actor_type,
               'logged-in page view: ' || page_path AS evidence_detail
        FROM stg_segment_pages WHERE user_id IS NOT NULL
        UNION ALL BY NAME
        SELECT 'cli_wizard:' || user_id || ':' || CAST(event_at AS VARCHAR) AS activity_id, 'raw_cli_wizard' AS source_table,
               'cli_setup_wizard' AS activity_type, user_id, event_at AS activity_at, 'cli_setup_wizard' AS signal_code,
               'human' AS actor_type, 'opened CLI setup wizard (browser)' AS evidence_detail
        FROM stg_cli_wizard
        UNION ALL BY NAME
        SELECT 'docs_mcp:' || user_id || ':' || CAST(event_at AS VARCHAR) || ':' || action AS activity_id,
               'raw_docs_mcp_events' AS source_table, 'docs_mcp_click' AS activity_type, action AS object_id, user_id,
               event_at AS activity_at, 'mcp_docs_click' AS signal_code, 'human' AS actor_type, 'docs click: ' || action AS evidence_detail
        FROM stg_docs_mcp_events
        UNION ALL BY NAME
        SELECT 'api_key:' || api_key_id AS activity_id, 'raw_api_keys' AS source_table, 'api_key' AS activity_type,
               api_key_id AS object_id, user_id, org_id AS direct_org_id, 'cli_key_name_hint' AS signal_code,
               'unknown' AS actor_type, 'API key named "' || key_name || '"' AS evidence_detail
        FROM api_keys WHERE is_cli_named""",
    "events_once": f"""
        SELECT DISTINCT ON (activity_id) {_EVENT_COLUMNS} FROM events_raw
        ORDER BY activity_id, activity_at NULLS LAST, source_table, activity_type, object_id NULLS LAST, user_id NULLS LAST,
                 project_id NULLS LAST, direct_org_id NULLS LAST, signal_code, actor_type, evidence_detail NULLS LAST""",
    "activity": f"""
        WITH placed AS (
            SELECT e.*, coalesce(p.org_id, e.direct_org_id) AS org_id, i.person_id
            FROM events_once e LEFT JOIN stg_projects p USING (project_id) LEFT JOIN identity i ON i.user_id = e.user_id),
        j AS (
            SELECT placed.*, r.* EXCLUDE (signal_code), o.account_id AS oa, o.resolution_status AS os, o.mapping_confidence AS oc,
                   w.account_id AS pa, w.resolution_status AS ps, w.account_confidence AS pc,
                   coalesce(o.resolution_status LIKE 'resolved%', false) AS org_ok,
                   placed.org_id IS NULL AND coalesce(w.resolution_status = 'resolved', false) AS person_ok
            FROM placed LEFT JOIN org_accounts o ON o.org_id = placed.org_id LEFT JOIN people w ON w.person_id = placed.person_id
            LEFT JOIN rule_surface_signals r ON r.signal_code = placed.signal_code)
        SELECT activity_id, source_table, activity_type, object_id, user_id, person_id, project_id, org_id, activity_at,
               coalesce({recent('activity_at')}, false) AS is_in_lookback, signal_code, surface, evidence_kind, attribution,
               confidence_score, actor_type, evidence_detail,
               CASE WHEN org_ok THEN oa WHEN person_ok THEN pa END AS account_id,
               CASE WHEN org_ok THEN 'org_account' WHEN org_id IS NOT NULL THEN 'org_' || os
                    WHEN person_ok THEN 'single_account_member' ELSE 'person_' || coalesce(ps, 'unknown') END AS account_attribution,
               CASE WHEN org_ok THEN oc WHEN person_ok THEN pc END AS account_confidence
        FROM j""",

    # ----------------------------------------------------------------- signals
    "signals_raw": """
        SELECT 'news:' || news_id AS signal_id, news_id AS source_record_id, company_id, 'news' AS signal_family,
               lower(category) AS signal_type, summary AS headline, product_name, found_at AS occurred_at, vendor_confidence, source_url
        FROM stg_news_events
        UNION ALL BY NAME
        SELECT 'product:' || product_id AS signal_id, product_id AS source_record_id, company_id, 'product' AS signal_family,
               'product_detected' AS signal_type, 'New product detected: ' || product_name AS headline, product_name,
               first_seen_at AS occurred_at, source_url
        FROM stg_products
        UNION ALL BY NAME
        SELECT 'tech:' || detection_id AS signal_id, detection_id AS source_record_id, company_id, 'tech' AS signal_family,
               'tech_detected' AS signal_type, 'Uses ' || technology_name AS headline, technology_name AS product_name,
               first_seen_at AS occurred_at, vendor_score AS vendor_confidence
        FROM stg_tech_detections""",
    "launch_pairs": """
        SELECT DISTINCT p.signal_id AS dropped, n.signal_id AS kept
        FROM signals_raw p JOIN signals_raw n ON n.company_id = p.company_id
             AND lower(trim(n.product_name)) = lower(trim(p.product_name))
        WHERE p.signal_family = 'product' AND n.signal_family = 'news' AND n.signal_type = 'launches'""",
    "signals": f"""
        SELECT s.signal_id, s.source_record_id, s.company_id, k.entity_name AS company_name, s.signal_family, s.signal_type,
               s.headline, s.product_name, s.occurred_at, s.vendor_confidence, s.source_url,
               s.signal_id IN (SELECT kept FROM launch_pairs) AS is_corroborated_by_product_feed,
               CASE WHEN s.signal_family = 'news' AND coalesce(k.name_token_is_specific, false)
                    THEN NOT contains(replace(lower(s.headline), ' ', ''), k.name_first_token) ELSE false END AS is_entity_mismatch,
               {recent('s.occurred_at')} AS is_in_lookback, c.account_id, c.resolution_status, c.match_method, c.match_confidence,
               coalesce(c.needs_review, false) AS is_match_pending_review
        FROM signals_raw s ANTI JOIN launch_pairs d ON d.dropped = s.signal_id
        LEFT JOIN match_keys k ON k.entity_type = 'company' AND k.entity_id = s.company_id
        LEFT JOIN companies c ON c.company_id = s.company_id""",

    # ------------------------------------------------------------------- marts
    "member_surfaces": f"""
        WITH a AS (
            SELECT person_id, surface, evidence_kind = 'usage' AS u, evidence_kind = 'intent' AS t, attribution = 'deterministic' AS det,
                   attribution = 'heuristic' AS heu, actor_type = 'automation' AS bot, actor_type = 'human' AS hum,
                   is_in_lookback, activity_at, confidence_score, signal_code
            FROM activity),
        g AS (
            SELECT person_id, surface, count(*) AS signal_events, {count_if('u')} AS usage_events, {count_if('t')} AS intent_events,
                   {count_if('u AND hum')} AS human_usage_events, {count_if('u AND bot')} AS automated_usage_events,
                   {count_if('NOT bot')} AS manual, {count_if('is_in_lookback')} AS events_in_lookback,
                   min(activity_at) AS first_seen_at, max(activity_at) AS last_seen_at, max(confidence_score) AS max_confidence,
                   {any_of('u AND det')} AS p, {any_of('u AND heu')} AS l, {any_of('u AND det AND NOT bot')} AS hp,
                   {any_of('u AND heu AND NOT bot')} AS hl, {any_of('t')} AS i, {listed('signal_code')} AS signal_codes
            FROM a GROUP BY person_id, surface)
        SELECT w.person_id, w.email, w.account_id, w.resolution_status AS account_resolution_status, s.surface, s.surface_order,
               coalesce(g.signal_events, 0) AS signal_events, coalesce(g.usage_events, 0) AS usage_events,
               coalesce(g.intent_events, 0) AS intent_events, coalesce(g.human_usage_events, 0) AS human_usage_events,
               coalesce(g.automated_usage_events, 0) AS automated_usage_events, coalesce(g.events_in_lookback, 0) AS events_in_lookback,
               g.first_seen_at, g.last_seen_at, coalesce(g.max_confidence, 0) AS max_confidence,
               CASE WHEN s.surface = 'unknown' AND g.signal_events > 0 THEN 'origin_unknown' WHEN p THEN 'usage_proven'
                    WHEN l THEN 'usage_likely' WHEN i THEN 'intent_only' ELSE 'no_evidence' END AS evidence_status,
               CASE WHEN s.surface = 'unknown' AND g.manual > 0 THEN 'origin_unknown' WHEN hp THEN 'usage_proven'
                    WHEN hl THEN 'usage_likely' WHEN i THEN 'intent_only' ELSE 'no_evidence' END AS human_evidence_status,
               CASE WHEN g.usage_events > 0 THEN CASE WHEN g.human_usage_events > 0 AND g.automated_usage_events > 0 THEN 'human_and_automation'
                    WHEN g.automated_usage_events > 0 THEN 'automation_only' WHEN g.human_usage_events > 0 THEN 'human'
                    ELSE 'unknown' END END AS usage_actor,
               g.signal_codes, s.what_we_can_see
        FROM people w CROSS JOIN surface_names s LEFT JOIN g ON g.person_id = w.person_id AND g.surface = s.surface""",
    "members": f"""
        WITH v AS (
            SELECT person_id, {', '.join(f"max(human_evidence_status) FILTER (WHERE surface = '{s}') AS {s}_evidence" for s in ('ui', 'sdk', 'cli', 'mcp'))},
                   max(evidence_status) FILTER (WHERE surface = 'sdk') AS sdk_evidence_any_actor,
                   max(usage_actor) FILTER (WHERE surface = 'sdk') AS sdk_usage_actor,
                   CAST(sum(if(surface = 'ui', usage_events, 0)) AS BIGINT) AS ui_page_views,
                   CAST(sum(if(surface = 'sdk', usage_events, 0)) AS BIGINT) AS sdk_objects,
                   CAST(sum(if(surface = 'unknown', usage_events, 0)) AS BIGINT) AS objects_origin_unknown,
                   CAST(sum(if(surface IN ('cli', 'mcp'), intent_events, 0)) AS BIGINT) AS cli_mcp_intent_events,
                   CAST(sum(human_usage_events) AS BIGINT) AS human_usage_events,
                   CAST(sum(automated_usage_events) AS BIGINT) AS automated_usage_events,
                   CAST(sum(events_in_lookback) AS BIGINT) AS events_in_lookback, max(last_seen_at) AS last_seen_at
            FROM member_surfaces GROUP BY person_id),
        k AS (SELECT person_id, count(*) AS n, bool_or(is_automation_named) AS bot FROM api_keys GROUP BY person_id)
        SELECT w.person_id, w.email, w.email_domain, w.login_count, w.login_count > 1 AS has_duplicate_logins, w.org_count, w.account_count,
               w.account_id, w.account_confidence, w.resolution_status AS account_resolution_status,
               CASE WHEN v.human_usage_events > 0 THEN 'human'
                    WHEN v.automated_usage_events > 0 AND v.objects_origin_unknown = 0 THEN 'automation_identity'
                    ELSE 'undetermined' END AS member_type,
               v.* EXCLUDE (person_id), coalesce(k.n, 0) AS api_key_count,
               coalesce(k.bot, false) AS has_automation_named_key
        FROM people w LEFT JOIN v USING (person_id) LEFT JOIN k USING (person_id)""",
    "adoption": f"""
        WITH am AS (SELECT DISTINCT account_id, person_id FROM memberships WHERE account_id IS NOT NULL),
        mc AS (SELECT account_id, count(*) AS known FROM am GROUP BY ALL),
        pp AS (
            SELECT account_id, surface, person_id, evidence_kind = 'usage' AND actor_type = 'automation' AS bot,
                   evidence_kind = 'usage' AND actor_type <> 'automation' AND attribution = 'deterministic' AS p,
                   evidence_kind = 'usage' AND actor_type <> 'automation' AND attribution = 'heuristic' AS l,
                   evidence_kind = 'intent' AS i, evidence_kind = 'usage' AS u
            FROM activity WHERE account_id IS NOT NULL AND surface <> 'unknown'),
        best AS (
            SELECT account_id, surface, person_id, CASE WHEN bool_or(p) THEN 3 WHEN bool_or(l) THEN 2 WHEN bool_or(i) THEN 1 ELSE 0 END AS grade,
                   bool_or(bot) AS bot, count(*) FILTER (WHERE u) AS uses, count(*) FILTER (WHERE bot) AS runs
            FROM pp GROUP BY ALL),
        r AS (
            SELECT account_id, surface, {count_if('grade = 3')} AS proven, {count_if('grade = 2')} AS likely, {count_if('grade = 1')} AS intent,
                   {count_if('bot AND grade < 2')} AS machines, CAST(sum(uses) AS BIGINT) AS uses, CAST(sum(runs) AS BIGINT) AS runs
            FROM best GROUP BY ALL),
        un AS (
            SELECT am.account_id, a.surface, count(DISTINCT a.person_id) AS n FROM activity a JOIN am USING (person_id)
            WHERE a.account_id IS NULL AND a.surface <> 'unknown' GROUP BY ALL),
        f AS (
            SELECT n.account_id, n.account_name, s.surface, s.surface_order, s.surface IN ('ui', 'sdk') AS measurable,
                   coalesce(known, 0) AS known, coalesce(proven, 0) AS proven, coalesce(likely, 0) AS likely, coalesce(intent, 0) AS intent,
                   coalesce(machines, 0) AS machines, coalesce(un.n, 0) AS lost, coalesce(uses, 0) AS uses, coalesce(runs, 0) AS runs,
                   CASE WHEN s.surface = 'sdk' THEN coalesce(t.trace_gb_last_7d, 0) END AS gb
            FROM account_names n CROSS JOIN surface_names s LEFT JOIN mc ON mc.account_id = n.account_id
            LEFT JOIN r ON r.account_id = n.account_id AND r.surface = s.surface
            LEFT JOIN un ON un.account_id = n.account_id AND un.surface = s.surface
            LEFT JOIN account_trend t ON t.account_id = n.account_id WHERE s.surface <> 'unknown')
        SELECT account_id, account_name, surface, surface_order, measurable AS usage_is_measurable, known AS known_members,
               proven AS members_usage_proven, likely AS members_usage_likely, intent AS members_intent_only,
               machines AS members_automation_only, lost AS members_with_unattributed_signals, uses AS usage_events,
               runs AS automated_usage_events, gb AS org_level_trace_gb_last_7d,
               CASE WHEN proven + runs > 0 OR gb > 0 THEN 'usage_proven' WHEN likely > 0 THEN 'usage_likely' WHEN intent > 0 THEN 'intent_only'
                    WHEN measurable THEN 'no_evidence' ELSE 'not_measurable' END AS account_evidence_status,
               CASE WHEN proven + likely + intent > 0 THEN 'member' WHEN runs > 0 OR gb > 0 THEN 'org' ELSE 'none' END AS evidence_level,
               CASE WHEN measurable AND known > 0 THEN {half_up('proven::DOUBLE / known')} END AS pct_members_usage_proven,
               CASE WHEN known > 0 THEN {half_up('intent::DOUBLE / known')} END AS pct_members_intent_only,
               CASE WHEN known = 0 THEN 'No product members mapped to this account.'
                    WHEN measurable THEN format('{{}} of {{}} known members show proven {{}} usage', proven, known,
                            if(surface = 'sdk', 'code-based (SDK, or CLI running the SDK)', upper(surface)))
                        || if(runs > 0, format('; {{}} more runs came from automation (CI / production jobs) using a member''s key', runs), '')
                        || if(coalesce(gb, 0) > 0, format('; the org also ingests traces programmatically ({{:.1f}} GB in 7 days, not attributable to a member)', gb), '')
                    ELSE format('{{}} usage is not measurable; {{}} of {{}} known members showed setup intent', upper(surface), intent, known)
                        || if(lost > 0, format(' (intent from {{}} member(s) who also belong to another account is not counted)', lost), '')
                    END AS honest_summary
        FROM f""",
    "feed": f"""
        WITH op AS (SELECT account_id, max(plan_rank) AS best, min(mapping_confidence) AS weak FROM org_accounts
                    WHERE account_id IS NOT NULL GROUP BY account_id),
        act AS (SELECT * FROM activity WHERE account_id IS NOT NULL AND is_in_lookback),
        x AS (
            SELECT signal_id, account_id, 'external' AS signal_source, signal_type, occurred_at, headline,
                   coalesce(vendor_confidence, 0.8) AS signal_confidence, 'external_id_' || match_method AS attribution,
                   match_confidence AS attribution_confidence, is_entity_mismatch OR is_match_pending_review AS needs_review,
                   is_in_lookback AND signal_family <> 'tech' AND coalesce(vendor_confidence, 0.8) >= 0.7 AND match_confidence >= 0.7
                       AND NOT (is_entity_mismatch OR is_match_pending_review) AS is_actionable, company_id AS source_entity_id
            FROM signals WHERE resolution_status = 'resolved'
            UNION ALL BY NAME
            SELECT 'usage_surge:' || t.account_id AS signal_id, t.account_id, 'product' AS signal_source, 'usage_surge' AS signal_type,
                   CAST(t.last_day AS TIMESTAMP) AS occurred_at,
                   format('Trace ingestion up {{}}% in 7 days ({{:.1f}} -> {{:.1f}} GB/day){{}}', CAST(round(100 * t.trace_growth_7d, 0) AS BIGINT),
                          t.gb_baseline_day, t.gb_last_day, if(op.best < 3, ' on a non-Enterprise plan', '')) AS headline,
                   0.85::DOUBLE AS signal_confidence, 'org_trace_ingestion' AS attribution, op.weak AS attribution_confidence,
                   op.weak < 0.7 AS needs_review, op.weak >= 0.7 AS is_actionable, t.account_id AS source_entity_id
            FROM account_trend t JOIN op USING (account_id) WHERE t.is_usage_surge
            UNION ALL BY NAME
            SELECT 'ci_automation:' || account_id AS signal_id, account_id, 'product' AS signal_source, 'ci_automation' AS signal_type,
                   max(activity_at) AS occurred_at, count(*) || ' objects created by automation (CI / production jobs) in the last 30 days' AS headline,
                   0.9::DOUBLE AS signal_confidence, 'org_account' AS attribution, min(account_confidence) AS attribution_confidence,
                   false AS needs_review, false AS is_actionable, account_id AS source_entity_id
            FROM act WHERE surface = 'sdk' AND actor_type = 'automation' GROUP BY account_id
            UNION ALL BY NAME
            SELECT 'surface_intent:' || account_id AS signal_id, account_id, 'product' AS signal_source, 'surface_intent' AS signal_type,
                   max(activity_at) AS occurred_at,
                   count(DISTINCT person_id) || ' member(s) exploring ' || upper({listed('surface')}) || ' setup (intent, not proven usage)' AS headline,
                   0.3::DOUBLE AS signal_confidence, max(account_attribution) AS attribution, min(account_confidence) AS attribution_confidence,
                   min(account_confidence) < 0.7 AS needs_review, min(account_confidence) >= 0.7 AS is_actionable, account_id AS source_entity_id
            FROM act WHERE evidence_kind = 'intent' GROUP BY account_id)
        SELECT x.*, n.account_name FROM x JOIN account_names n USING (account_id)""",
    "signal_companies": f"""
        WITH s AS (
            SELECT company_id, count(*) AS n, {count_if('is_in_lookback')} AS r, {count_if('is_entity_mismatch')} AS m, max(occurred_at) AS latest
            FROM signals GROUP BY company_id)
        SELECT c.* EXCLUDE (unique_keys_agreeing), a.account_name, h.account_name AS name_match_account_name,
               coalesce(s.n, 0) AS signals_total, coalesce(s.r, 0) AS signals_in_lookback, coalesce(s.m, 0) AS signals_entity_mismatch,
               s.latest AS latest_signal_at
        FROM companies c LEFT JOIN s USING (company_id) LEFT JOIN account_names a ON a.account_id = c.account_id
        LEFT JOIN account_names h ON h.account_id = c.name_match_account_id""",
    "review_queue": f"""
        SELECT x.account_id, count(DISTINCT x.company_id) FILTER (WHERE next_action = 'steward_review') AS pending,
               count(DISTINCT x.company_id) FILTER (WHERE next_action = 'confirm_match') AS awaiting
        FROM candidates x JOIN companies c USING (company_id) GROUP BY x.account_id""",
    "account_360": f"""
        WITH o AS (
            SELECT account_id, count(*) AS product_orgs, max(plan_rank) AS best,
                   min(mapping_confidence) AS weak, bool_or(resolution_status = 'resolved_low_confidence') AS unverified
            FROM org_accounts WHERE account_id IS NOT NULL GROUP BY account_id),
        ad AS (
            SELECT account_id, any_value(known_members) AS known,
                   {', '.join(f"any_value(account_evidence_status) FILTER (WHERE surface = '{s}') AS {s}" for s in ('ui', 'sdk', 'cli', 'mcp'))},
                   any_value(members_usage_proven) FILTER (WHERE surface = 'ui') AS ui_n,
                   any_value(members_usage_proven) FILTER (WHERE surface = 'sdk') AS sdk_n,
                   any_value(evidence_level) FILTER (WHERE surface = 'sdk') AS sdk_level,
                   {listed("upper(surface) || ' — ' || honest_summary", ' | ')} AS plain
            FROM adoption GROUP BY account_id),
        ac AS (
            SELECT account_id, count(DISTINCT person_id) FILTER (WHERE actor_type <> 'automation' AND evidence_kind = 'usage') AS active,
                   {count_if("activity_type IN ('experiment', 'dataset', 'prompt')")} AS made,
                   {count_if("activity_type IN ('experiment', 'dataset', 'prompt') AND actor_type = 'automation'")} AS machine_made,
                   {count_if("surface = 'unknown'")} AS unknown_made, max(activity_at) AS last_at
            FROM activity WHERE account_id IS NOT NULL AND is_in_lookback GROUP BY account_id),
        mm AS (
            SELECT m.account_id, count(DISTINCT m.person_id) AS torn FROM memberships m JOIN people p USING (person_id)
            WHERE p.is_ambiguous AND m.account_id IS NOT NULL GROUP BY m.account_id),
        ec AS (SELECT account_id, count(*) AS linked FROM companies WHERE resolution_status = 'resolved' GROUP BY account_id),
        te AS (SELECT account_id, count(DISTINCT product_name) AS stack FROM signals
               WHERE signal_family = 'tech' AND resolution_status = 'resolved' GROUP BY account_id),
        s AS (
            SELECT account_id, {count_if(f"NOT needs_review AND {recent('occurred_at')}")} AS in_window, {count_if('is_actionable')} AS actionable,
                   {count_if('needs_review')} AS review,
                   first(headline ORDER BY signal_confidence DESC NULLS LAST, occurred_at DESC NULLS LAST, signal_id)
                       FILTER (WHERE is_actionable AND headline IS NOT NULL) AS reason,
                   first(struct_pack(h := headline, at := occurred_at) ORDER BY occurred_at DESC NULLS LAST, signal_id)
                       FILTER (WHERE signal_source = 'external' AND NOT needs_review) AS latest
            FROM feed GROUP BY account_id)
        SELECT k.entity_id AS account_id, k.entity_name AS account_name, k.domain_key AS crm_domain, k.linkedin_slug AS crm_linkedin_slug, k.ticker,
               CASE WHEN k.has_no_match_keys THEN 'missing domain and LinkedIn' WHEN k.is_missing_domain THEN 'missing domain'
                    WHEN k.is_missing_linkedin THEN 'missing LinkedIn' END AS crm_identifier_gaps,
               k.is_domain_shared AS crm_domain_shared_with_other_account, coalesce(o.product_orgs, 0) AS product_orgs,
               ['free', 'pro', 'enterprise'][o.best] AS best_plan, o.weak AS weakest_org_link_confidence,
               coalesce(o.unverified, false) AS has_unverified_org_link, coalesce(ad.known, 0) AS known_members,
               coalesce(ac.active, 0) AS active_members_in_lookback, coalesce(mm.torn, 0) AS members_shared_with_other_accounts,
               ad.ui AS ui_adoption, ad.sdk AS sdk_adoption, ad.sdk_level AS sdk_evidence_level, ad.cli AS cli_adoption, ad.mcp AS mcp_adoption,
               coalesce(ad.ui_n, 0) AS ui_members_proven, coalesce(ad.sdk_n, 0) AS sdk_members_proven, ad.plain AS adoption_in_plain_english,
               coalesce(ac.made, 0) AS objects_created_in_lookback, coalesce(ac.machine_made, 0) AS automated_objects_in_lookback,
               coalesce(ac.unknown_made, 0) AS objects_origin_unknown_in_lookback, ac.last_at AS last_product_activity_at,
               t.trace_gb_last_7d, t.trace_growth_7d, coalesce(ec.linked, 0) AS external_companies_linked,
               coalesce(s.in_window, 0) AS signals_in_lookback, s.latest.h AS latest_external_headline, s.latest.at AS latest_external_signal_at,
               coalesce(te.stack, 0) AS technologies_detected, coalesce(q.pending, 0) AS external_records_pending_review,
               coalesce(q.awaiting, 0) AS external_records_awaiting_confirmation, coalesce(s.review, 0) AS signals_needing_review,
               coalesce(s.actionable, 0) AS actionable_signals, s.reason AS top_action_reason,
               row_number() OVER (ORDER BY coalesce(s.actionable, 0) DESC, coalesce(t.trace_growth_7d, -1) DESC, k.entity_id) AS priority_rank
        FROM match_keys k LEFT JOIN o ON o.account_id = k.entity_id LEFT JOIN ad ON ad.account_id = k.entity_id
        LEFT JOIN ac ON ac.account_id = k.entity_id LEFT JOIN mm ON mm.account_id = k.entity_id
        LEFT JOIN account_trend t ON t.account_id = k.entity_id LEFT JOIN ec ON ec.account_id = k.entity_id
        LEFT JOIN te ON te.account_id = k.entity_id LEFT JOIN s ON s.account_id = k.entity_id
        LEFT JOIN review_queue q ON q.account_id = k.entity_id WHERE k.entity_type = 'account'""",
    "prospects": f"""
        SELECT 'external:' || c.company_id AS prospect_id, 'external_signal' AS prospect_source, c.company_name AS prospect_name,
               c.website_domain AS domain, c.linkedin_slug, NULL::VARCHAR AS product_plan, 0::BIGINT AS product_members,
               CAST(c.signals_in_lookback AS BIGINT) AS signals_in_lookback, c.latest_signal_at AS last_seen_at,
               'External activity from a company with no CRM account' AS why_it_matters,
               (SELECT first(s.headline ORDER BY s.occurred_at DESC NULLS LAST, s.signal_id) FROM signals s
                WHERE s.company_id = c.company_id AND s.signal_family = 'news') AS latest_headline
        FROM signal_companies c WHERE c.next_action = 'net_new_prospect'
        UNION ALL BY NAME
        SELECT 'product:' || o.org_id AS prospect_id, 'product_signup' AS prospect_source, o.org_name AS prospect_name,
               m.domain AS domain, o.plan AS product_plan, coalesce(m.n, 0) AS product_members,
               coalesce(a.n, 0) AS signals_in_lookback, a.at AS last_seen_at,
               'Product sign-up using us today with no CRM account' AS why_it_matters
        FROM org_accounts o
        LEFT JOIN (SELECT org_id, count(DISTINCT person_id) AS n, max(p.email_domain) AS domain
                   FROM memberships JOIN people p USING (person_id) GROUP BY org_id) m ON m.org_id = o.org_id
        LEFT JOIN (SELECT org_id, {count_if('is_in_lookback')} AS n, max(activity_at) AS at FROM activity GROUP BY org_id) a ON a.org_id = o.org_id
        WHERE o.resolution_status = 'unmapped'""",
    "cli_answer": """
        SELECT c.account_id, c.account_name, c.known_members AS known_product_members, 'not measurable' AS cli_usage,
               c.members_intent_only AS members_with_cli_setup_intent,
               c.members_with_unattributed_signals AS intent_from_multi_account_members_not_counted,
               s.members_usage_proven AS members_with_code_based_usage_sdk_or_cli, c.honest_summary
        FROM adoption c JOIN adoption s ON s.account_id = c.account_id AND s.surface = 'sdk'
        WHERE c.surface = 'cli' AND c.known_members > 0""",
}

_INPUT = {"orgs": "org_accounts", "pages": "stg_segment_pages", "accounts": "match_keys"}
JOBS["quality"] = " UNION ALL BY NAME ".join(
    f"""SELECT {order} AS metric_order, '{area}' AS area, '{metric}' AS metric, {count_if(num)} AS numerator,
        {count_if(den)} AS denominator,
        CASE WHEN count(*) FILTER (WHERE {den}) > 0 THEN
            {half_up(f'(count(*) FILTER (WHERE {num}))::DOUBLE / count(*) FILTER (WHERE {den})')} END AS rate
        FROM {_INPUT.get(name, name)} {"WHERE entity_type = 'account'" if name == 'accounts' else ''}"""
    for order, name, area, metric, num, den in METRICS)
