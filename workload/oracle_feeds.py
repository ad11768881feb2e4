"""The feeds of ``feeds.py`` as DuckDB SQL, already typed and cleaned: one CTE per staged table."""

from __future__ import annotations

SHIFT = "INTERVAL 8217 DAY"
_LABEL = r"regexp_extract(url, '([a-z-]+)[.]example[.]', 1)"
_LANG = r"regexp_extract(url, '[.][a-z]+/([a-z]+)/', 1)"
_NUM = r"regexp_extract(url, '/([0-9]+)', 1)"
_SUB = r"regexp_extract(url, '://(www|blog|m)[.]', 1)"
_HOST = r"regexp_extract(url, '://([^/]+)', 1)"
_K = "json_extract_string(props, '$.k')"

FEEDS: dict[str, str] = {
    "stg_users": f"""
        SELECT 'u' || c_custkey AS user_id,
               CASE WHEN c_acctbal >= 0 THEN c_mktsegment || '.' || CAST(floor(c_acctbal / 250) AS BIGINT) || '@'
                    || replace(n_name, ' ', '-') || '.Example.com' END AS email,
               f.d + {SHIFT} AS created_at
        FROM customer JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT o_custkey AS c, min(o_orderdate) AS d FROM orders GROUP BY ALL) f ON f.c = c_custkey""",
    "stg_members": f"""
        SELECT 's' || CASE WHEN l_quantity = 50 THEN l_suppkey ELSE o_custkey % 40 + 1 END AS org_id, 'u' || o_custkey AS user_id,
               min(o_orderdate) + {SHIFT} AS member_created_at
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2""",
    "stg_organizations": """
        SELECT 's' || s_suppkey AS org_id, s_name AS org_name, NULL::TIMESTAMP AS created_at,
               CASE WHEN s_acctbal >= 7000 THEN 'Enterprise' WHEN s_acctbal >= 4000 THEN 'pro'
                    WHEN s_acctbal >= 1000 THEN 'Free' END AS plan
        FROM supplier""",
    "stg_projects": """
        SELECT DISTINCT 'p' || l_suppkey || l_returnflag AS project_id, 's' || l_suppkey AS org_id,
               'Project ' || l_returnflag AS project_name
        FROM lineitem""",
    "stg_experiments": f"""
        SELECT l_orderkey || '-' || l_linenumber AS experiment_id, 'p' || l_suppkey || l_returnflag AS project_id,
               'u' || o_custkey AS user_id, l_shipdate + {SHIFT} AS created_at,
               CASE WHEN l_linestatus = 'O' THEN 'json' END AS repo_info_json, l_linestatus = 'O' AS has_repo_info,
               CASE WHEN l_linestatus = 'O' THEN TIMESTAMP '2024-01-20 00:00:00' END AS repo_commit_time,
               CASE WHEN l_linestatus = 'O' THEN 'c' || l_partkey END AS repo_commit,
               CASE WHEN l_linestatus = 'O' THEN 'main' END AS repo_branch,
               CASE WHEN l_linestatus = 'O' THEN l_discount > 0.05 END AS repo_is_dirty,
               CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_tax > 0.065 THEN 'ci-runner'
                    WHEN l_tax > 0.055 THEN 'renovate[bot]' ELSE 'dev' END END AS repo_author_name,
               CASE WHEN l_linenumber = 5 THEN 'eval' END AS meta_eval_name,
               CASE WHEN l_linenumber = 2 THEN 'm1' END AS meta_model,
               CASE l_linenumber WHEN 3 THEN 'ci-daily' WHEN 4 THEN 'lambda-prod' END AS meta_source,
               CASE WHEN l_linenumber = 1 THEN 'run-' || l_orderkey END AS meta_ci_run_id,
               CASE WHEN l_linenumber = 2 THEN 'true' END AS meta_ci_flag
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "stg_datasets": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS dataset_id, 'p' || o_custkey || 'A' AS project_id,
               'u' || o_custkey AS user_id, o_orderdate + {SHIFT} AS created_at,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Manual' WHEN '2-HIGH' THEN 'ci-nightly'
                    WHEN '3-MEDIUM' THEN 'upload' END AS meta_source
        FROM orders""",
    "stg_prompts": f"""
        SELECT CAST(event_id AS VARCHAR) AS prompt_id, 'p' || {_K} || 'N' AS project_id, 'u' || user_id AS user_id,
               ts AS created_at
        FROM events WHERE event_type = 'error'""",
    "stg_segment_pages": f"""
        SELECT 'a' || {_K} AS anonymous_id, CASE WHEN "value" >= 5 THEN 'u' || user_id END AS user_id,
               ts AS viewed_at, CASE WHEN "value" < 150 THEN '/p/' || {_K} END AS page_path
        FROM events WHERE event_type = 'view'""",
    "stg_cli_wizard": "SELECT 'u' || user_id AS user_id, ts AS event_at FROM events WHERE event_type = 'signup'",
    "stg_docs_mcp_events": f"""
        SELECT 'u' || user_id AS user_id, ts AS event_at,
               CASE WHEN CAST({_K} AS INTEGER) < 50 THEN 'copy_add_mcp_command' ELSE 'install_mcp_server' END AS action
        FROM events WHERE event_type = 'click'""",
    "stg_api_keys": """
        SELECT 'k' || c_custkey AS api_key_id, 'u' || c_custkey AS user_id, 's' || c_nationkey AS org_id,
               'h' || c_custkey AS key_hash,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'ci-build' WHEN 'MACHINERY' THEN 'robot arm'
                    WHEN 'HOUSEHOLD' THEN 'House-CLI' WHEN 'FURNITURE' THEN 'cli-ci' ELSE 'laptop' END AS key_name
        FROM customer""",
    "stg_trace_volume": f"""
        SELECT 's' || l_suppkey AS org_id, CAST(l_shipdate + {SHIFT} AS DATE) AS activity_date,
               l_quantity AS ingested_gb
        FROM lineitem""",
    "stg_salesforce_accounts": f"""
        SELECT 'acc' || page_id AS account_id, {_LABEL} || ' ' || {_LANG} || ' Inc.' AS account_name,
               CASE WHEN {_LANG} <> 'de' THEN url END AS domain,
               CASE WHEN {_SUB} <> 'blog' THEN 'https://www.linkedin.com/company/' || {_NUM} || '/?x=1' END
                   AS linkedin_company_url,
               CASE WHEN url LIKE '%.com/%' THEN 'nyse:' || {_LABEL} WHEN url LIKE '%.net/%' THEN {_LABEL} END AS ticker
        FROM pages WHERE starts_with(url, 'https:')""",
    "stg_account_org_map": """
        SELECT 's' || s_suppkey AS org_id, CASE WHEN s_acctbal >= 300 THEN 'acc' || s_suppkey END AS account_id,
               CASE WHEN s_nationkey < 8 THEN 'contract' WHEN s_nationkey < 14 THEN 'Billing_Parent'
                    WHEN s_nationkey < 20 THEN 'org_c_fallback' ELSE 'partner_guess' END AS mapping_source
        FROM supplier WHERE s_acctbal >= 0
        UNION ALL BY NAME
        SELECT 's' || s_suppkey AS org_id, 'acc' || s_nationkey AS account_id, 'billing_parent' AS mapping_source
        FROM supplier WHERE s_acctbal >= 8500""",
    "stg_signal_companies": f"""
        SELECT 'c' || page_id AS company_id, upper({_LABEL}) || ' ' || {_LANG} || ', LLC' AS company_name,
               CASE WHEN {_LANG} <> 'es' THEN replace(url, 'example', 'EXAMPLE') END AS company_website,
               CASE WHEN {_SUB} <> 'm' THEN 'http://uk.LinkedIn.com/company/' || {_NUM} || '#about' END AS linkedin_url,
               CASE WHEN {_SUB} = 'www' THEN {_HOST} || '.' END AS linkedin_domain
        FROM pages""",
    "stg_news_events": """
        SELECT CAST(doc_id AS VARCHAR) AS news_id, 'c' || doc_id AS company_id,
               CASE lang WHEN 'en' THEN 'Launches' WHEN 'de' THEN 'hires' ELSE 'expands' END AS category,
               nullif(trim(text), '') AS summary,
               TIMESTAMP '2024-01-30 12:00:00' - to_days(CAST(n_chars % 45 AS INTEGER)) AS found_at,
               CASE WHEN n_chars % 7 > 0 THEN (n_chars % 100) / 100::DOUBLE END AS vendor_confidence,
               nullif(trim(source), '') AS product_name, 'https://news.example/' || doc_id AS source_url
        FROM documents""",
    "stg_products": """
        SELECT CAST(doc_id AS VARCHAR) AS product_id, 'c' || doc_id AS company_id,
               CASE WHEN quality = 1 THEN upper(source) ELSE source || '-x' END AS product_name, lang AS category,
               TIMESTAMP '2024-01-30 00:00:00' - to_days(CAST(n_chars % 60 AS INTEGER)) AS first_seen_at,
               'https://shop.example/' || doc_id AS source_url
        FROM documents JOIN labels USING (doc_id)""",
    "stg_tech_detections": f"""
        SELECT CAST(event_id AS VARCHAR) AS detection_id, 'c' || user_id AS company_id, 'tech-' || {_K} AS technology_name,
               ts AS first_seen_at, CAST({_K} AS INTEGER) / 100::DOUBLE AS vendor_score
        FROM events WHERE event_type = 'purchase'""",
}
