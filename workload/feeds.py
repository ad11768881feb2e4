"""Delivered sources derived from the supplied tables, every column as text.

Tables are read whole and take roles, so the work grows with them:

- customer are the logins, supplier the product orgs; those with a balance of 0 or more have a CRM link
- lineitem gives memberships (of 50 pieces in the supplier's org, else in the buyer's home org), projects,
  experiments and traces, a row each
- orders give datasets; events give prompts, page views, wizard views, docs clicks, detections
- pages are the external companies; those served over https are also the CRM accounts
- documents are the news, labelled documents the detected products

Order dates are moved so that the last one falls on the last day of the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.config import Settings

AS_OF = "2024-01-30"
# Days from the last order date of the supplied tables to AS_OF.
ORDER_SHIFT_DAYS = 8217

# Orgs that buyers are at home in.
HOME_ORGS = 40

CFG = Settings(as_of_date=AS_OF)


def _moved(column: str) -> str:
    return f"CAST({column} + INTERVAL {ORDER_SHIFT_DAYS} DAYS AS STRING)"


def _host(url: str = "url") -> str:
    return f"regexp_extract({url}, '://([^/]+)', 1)"


_LABEL = "regexp_extract(url, '([a-z-]+)[.]example[.]', 1)"
_LANG = "regexp_extract(url, '[.][a-z]+/([a-z]+)/', 1)"
_NUMBER = "regexp_extract(url, '/([0-9]+)', 1)"
_SUB = "regexp_extract(url, '://(www|blog|m)[.]', 1)"


# Schemas of the supplied tables that are used, so that no file is opened to plan a query.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    customer, supplier, nation = table("customer"), table("supplier"), table("nation")
    orders, lineitem, events = table("orders"), table("lineitem"), table("events")
    pages, documents, labels = table("pages"), table("documents"), table("labels")

    first_order = orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    customers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(first_order, F.col("c_custkey") == F.col("o_custkey"), "left")
    # Both sides grow alike, so neither is broadcast, at any scale.
    ordered = lineitem.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    # Only what the experiments tell goes through the join: three authors, dirty or not, of lines that are open.
    told = lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate",
        "CASE WHEN l_linestatus = 'O' THEN l_partkey END AS partkey",
        "CASE WHEN l_linestatus = 'O' THEN CAST(CASE WHEN l_discount > 0.05 THEN 4 ELSE 1 END + "
        "CASE WHEN l_tax > 0.065 THEN 2 WHEN l_tax > 0.055 THEN 1 ELSE 0 END AS TINYINT) END AS repo")
    lines = told.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    k = "get_json_object(props, '$.k')"

    def of_type(kind: str) -> DataFrame:
        return events.filter(F.col("event_type") == kind)

    links = supplier.selectExpr(
        "concat('s', s_suppkey) AS org_id",
        "CASE WHEN s_acctbal >= 300 THEN concat('acc', s_suppkey) END AS account_id",
        "CASE WHEN s_nationkey < 8 THEN 'contract' WHEN s_nationkey < 14 THEN 'Billing_Parent' "
        "WHEN s_nationkey < 20 THEN 'org_c_fallback' ELSE 'partner_guess' END AS mapping_source",
        "s_acctbal", "s_nationkey")
    first = links.filter("s_acctbal >= 0").select("org_id", "account_id", "mapping_source")
    second = links.filter("s_acctbal >= 8500").selectExpr(
        "org_id", "concat('acc', s_nationkey) AS account_id", "'billing_parent' AS mapping_source")

    return {
        "users": customers.selectExpr(
            "concat('u', c_custkey) AS user_id",
            "CASE WHEN c_acctbal >= 0 THEN concat(' ', c_mktsegment, '.', CAST(floor(c_acctbal / 250) AS STRING), "
            "'@', replace(n_name, ' ', '-'), '.Example.com') END AS email",
            f"{_moved('first_order')} AS created_at"),
        "members": ordered.selectExpr(
            f"CASE WHEN l_quantity = 50 THEN l_suppkey ELSE o_custkey % {HOME_ORGS} + 1 END AS org", "o_custkey", "o_orderdate")
        .groupBy("org", "o_custkey").agg(F.min("o_orderdate").alias("since")).selectExpr(
            "concat('s', org) AS org_id", "concat('u', o_custkey) AS user_id",
            f"{_moved('since')} AS member_created_at"),
        "organizations": supplier.selectExpr(
            "concat('s', s_suppkey) AS org_id", "s_name AS org_name", "CAST(NULL AS STRING) AS created_at",
            "CASE WHEN s_acctbal >= 7000 THEN 'Enterprise' WHEN s_acctbal >= 4000 THEN ' pro ' "
            "WHEN s_acctbal >= 1000 THEN 'Free' ELSE '' END AS plan"),
        "projects": lineitem.select("l_suppkey", "l_returnflag").distinct().selectExpr(
            "concat('p', l_suppkey, l_returnflag) AS project_id", "concat('s', l_suppkey) AS org_id",
            "concat('Project ', l_returnflag) AS name"),
        "experiments": lines.selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS id", "concat('p', l_suppkey, l_returnflag) AS project_id",
            "concat('u', o_custkey) AS user_id", f"{_moved('l_shipdate')} AS created",
            "CASE WHEN repo IS NOT NULL THEN concat('{\"commit\":\"c', partkey, '\",\"branch\":\"main\",\"dirty\":', "
            "CASE WHEN repo > 3 THEN 'true' ELSE 'false' END, ',\"author_name\":\"', "
            "CASE WHEN repo IN (3, 6) THEN 'ci-runner' WHEN repo IN (2, 5) THEN 'renovate[bot]' ELSE 'dev' END, "
            "'\",\"commit_time\":\"2024-01-20 00:00:00\"}') END AS repo_info",
            "CASE l_linenumber WHEN 1 THEN concat('{\"ci_run_id\":\"run-', l_orderkey, '\"}') "
            "WHEN 2 THEN '{\"ci\":\"true\",\"model\":\"m1\"}' WHEN 3 THEN '{\"source\":\"ci-daily\"}' "
            "WHEN 4 THEN '{\"source\":\"lambda-prod\"}' WHEN 5 THEN '{\"eval_name\":\"eval\",\"source\":null}' "
            "WHEN 6 THEN ' ' END AS metadata"),
        "datasets": orders.selectExpr(
            "CAST(o_orderkey AS STRING) AS id", "concat('p', o_custkey, 'A') AS project_id",
            "concat('u', o_custkey) AS user_id", f"{_moved('o_orderdate')} AS created",
            "CASE o_orderpriority WHEN '1-URGENT' THEN '{\"source\":\"Manual\"}' "
            "WHEN '2-HIGH' THEN '{\"source\":\"ci-nightly\"}' WHEN '3-MEDIUM' THEN '{\"source\":\"upload\"}' "
            "END AS metadata"),
        "prompts": of_type("error").selectExpr(
            "CAST(event_id AS STRING) AS id", f"concat('p', {k}, 'N') AS project_id",
            "concat('u', user_id) AS user_id", "CAST(ts AS STRING) AS created"),
        "segment_pages": of_type("view").selectExpr(
            f"concat('a', {k}) AS anonymous_id",
            "CASE WHEN value >= 5 THEN concat('u', user_id) END AS user_id", "CAST(ts AS STRING) AS timestamp",
            f"CASE WHEN value < 150 THEN concat('/p/', {k}) END AS path"),
        "cli_wizard": of_type("signup").selectExpr(
            "concat('u', user_id) AS user_id", "CAST(ts AS STRING) AS timestamp"),
        "docs_mcp_events": of_type("click").selectExpr(
            "concat('u', user_id) AS user_id", "CAST(ts AS STRING) AS timestamp",
            f"CASE WHEN CAST({k} AS INT) < 50 THEN 'copy_add_mcp_command' ELSE 'install_mcp_server' END AS action"),
        "api_keys": customer.selectExpr(
            "concat('k', c_custkey) AS id", "concat('u', c_custkey) AS user_id",
            "concat('s', c_nationkey) AS org_id", "concat('h', c_custkey) AS key_hash",
            "CASE c_mktsegment WHEN 'BUILDING' THEN 'ci-build' WHEN 'MACHINERY' THEN 'robot arm' "
            "WHEN 'HOUSEHOLD' THEN 'House-CLI' WHEN 'FURNITURE' THEN 'cli-ci' ELSE 'laptop' END AS name"),
        "trace_volume": lineitem.selectExpr(
            "concat('s', l_suppkey) AS org_id",
            f"CAST(CAST(l_shipdate + INTERVAL {ORDER_SHIFT_DAYS} DAYS AS DATE) AS STRING) AS ds",
            "CAST(l_quantity AS STRING) AS ingested_gb"),
        "salesforce_accounts": pages.filter("url LIKE 'https:%'").selectExpr(
            "concat('acc', page_id) AS account_id",
            f"concat({_LABEL}, ' ', {_LANG}, ' Inc.') AS account_name",
            f"CASE WHEN {_LANG} <> 'de' THEN url END AS domain",
            f"CASE WHEN {_SUB} <> 'blog' THEN concat('https://www.linkedin.com/company/', {_NUMBER}, '/?x=1') END "
            "AS linkedin_company_url",
            f"CASE WHEN url LIKE '%.com/%' THEN concat('nyse:', {_LABEL}) WHEN url LIKE '%.net/%' THEN {_LABEL} END "
            "AS ticker"),
        "account_org_map": first.unionByName(second),
        "signal_companies": pages.selectExpr(
            "concat('c', page_id) AS company_id", f"concat(upper({_LABEL}), ' ', {_LANG}, ', LLC') AS company_name",
            f"CASE WHEN {_LANG} <> 'es' THEN replace(url, 'example', 'EXAMPLE') END AS company_website",
            f"CASE WHEN {_SUB} <> 'm' THEN concat('http://uk.LinkedIn.com/company/', {_NUMBER}, '#about') END "
            "AS linkedin_url",
            f"CASE WHEN {_SUB} = 'www' THEN concat({_host()}, '.') END AS linkedin_domain"),
        "news_events": documents.selectExpr(
            "CAST(doc_id AS STRING) AS id", "concat('c', doc_id) AS company_id",
            "CASE lang WHEN 'en' THEN 'Launches' WHEN 'de' THEN 'hires' ELSE 'expands' END AS category",
            "text AS summary",
            "CAST(TIMESTAMP_NTZ'2024-01-30 12:00:00' - make_interval(0, 0, 0, CAST(n_chars % 45 AS INT)) AS STRING) "
            "AS found_at",
            "CASE WHEN n_chars % 7 > 0 THEN CAST(n_chars % 100 / 100.0D AS STRING) END AS confidence",
            "source AS product_name", "concat('https://news.example/', doc_id) AS source_url"),
        "products": documents.join(labels, "doc_id").selectExpr(
            "CAST(doc_id AS STRING) AS id", "concat('c', doc_id) AS company_id",
            "CASE WHEN quality = 1 THEN concat(upper(source), ' ') ELSE concat(source, '-x') END AS name",
            "lang AS category",
            "CAST(TIMESTAMP_NTZ'2024-01-30 00:00:00' - make_interval(0, 0, 0, CAST(n_chars % 60 AS INT)) AS STRING) "
            "AS first_seen_at", "concat('https://shop.example/', doc_id) AS source_url"),
        "tech_detections": of_type("purchase").selectExpr(
            "CAST(event_id AS STRING) AS id", "concat('c', user_id) AS company_id",
            f"concat('tech-', {k}) AS technology_name", "CAST(ts AS STRING) AS first_seen_at",
            f"CAST(CAST({k} AS INT) / 100.0D AS STRING) AS score"),
    }
