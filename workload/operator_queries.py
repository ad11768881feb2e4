"""Single operators on the supplied tables: name -> (Spark query, DuckDB statement)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.config import Settings
from accountlens.functions import keys as K
from accountlens.functions.ladders import ladder, plan_of_rank, plan_rank
from accountlens.functions.measures import any_true, count_if, in_lookback, safe_ratio, small_list
from accountlens.operators import checks as C
from accountlens.operators.dedupe import keep_first, latest_per_key
from accountlens.operators.joins import lookup
from accountlens.operators.lists import listed as distinct_rows
from accountlens.operators.lists import listed_in_order
from accountlens.operators.rank import global_rank
from accountlens.plans.check_suite import pinned_keys
from accountlens.plans.match_keys import normalised_entities
from accountlens.plans.reports import column_profiles, table_row_counts
from accountlens.sources.freshness import check_source_freshness
from accountlens.sources.staging import clean, rejects, stage
from accountlens.sources.storage import Scratch
from workload.oracle_jobs import half_up, listed

Query = Callable[[SparkSession, str], DataFrame]
OPERATORS: dict[str, tuple[Query, str]] = {}

CFG = Settings(as_of_date="2024-01-30")


def operator(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        OPERATORS[f.__name__] = (f, sql)
        return f
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ staging and keys

@operator("""SELECT event_id, nullif(trim(event_type), '') AS event_type, CAST(ts AS DATE) AS event_day,
             coalesce("value", 0) AS amount FROM events""")
def stage_clean_cast(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", clean(F.col("event_type")).alias("event_type"), F.col("ts").cast("date").alias("event_day"),
        F.coalesce("value", F.lit(0.0)).alias("amount"))


@operator("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             json_extract_string(props, '$.missing') AS missing,
             TRY_CAST(event_type AS INTEGER) IS NOT NULL AS is_number FROM events""")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
        F.col("event_type").try_cast("int").isNotNull().alias("is_number"))


@operator(r"""SELECT page_id, nullif(rtrim(regexp_replace(lower(string_split_regex(
                  regexp_replace(url, '^https?://', ''), '[/?#:]')[1]), '^www\.', ''), '.'), '') AS domain_key,
              nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS slug FROM pages""")
def url_keys(spark, sf_dir):
    profile = F.concat(F.lit(" HTTP://De.LinkedIn.com/company/"), F.regexp_extract("url", "/([0-9]+)", 1), F.lit("?x#y "))
    return table(spark, sf_dir, "pages").select(
        "page_id", K.domain_key(F.upper("url")).alias("domain_key"), K.linkedin_slug(profile).alias("slug"))


_FORMS = ["", " Inc.", ", LLC", " Co", " Company", " GmbH", " Corp.", " (Ltd)", " PLC", " Incorporated", "-Limited"]


@operator("""SELECT p_partkey, replace(p_name, ' ', '') AS name_key, string_split(p_name, ' ')[1] AS first_token,
              length(string_split(p_name, ' ')[1]) > 3 AS is_specific FROM part""")
def name_keys(spark, sf_dir):
    form = F.get(F.array(*[F.lit(f) for f in _FORMS]), F.pmod("p_partkey", F.lit(len(_FORMS))).cast("int"))
    name = F.concat(F.initcap("p_name"), form)
    return table(spark, sf_dir, "part").select(
        "p_partkey", K.company_name_key(name).alias("name_key"), K.name_first_token(name).alias("first_token"),
        K.token_is_specific(K.name_first_token(name), 4).alias("is_specific"))


@operator("""SELECT p_partkey, CASE WHEN p_size > 25 THEN upper(p_brand) END AS exchange,
             upper(CASE WHEN p_size > 25 THEN p_type ELSE p_brand END) AS symbol FROM part""")
def split_ticker(spark, sf_dir):
    ticker = F.when(F.col("p_size") > 25, F.concat("p_brand", F.lit(":"), "p_type")).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", K.ticker_exchange(ticker).alias("exchange"), K.ticker_symbol(ticker).alias("symbol"))


@operator("""SELECT page_id, host, count(*) OVER (PARTITION BY host) > 1 AS is_shared
             FROM (SELECT page_id, lower(regexp_extract(url, '://([^/]+)', 1)) AS host FROM pages)""")
def shared_key_flags(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.lower(F.regexp_extract("url", "://([^/]+)", 1)).alias("host"))
    shared = pages.groupBy("host").agg((F.count("*") > 1).alias("is_shared"))
    return lookup(pages, shared, ["host"])


# Raw website, LinkedIn URL and name, and the keys they must give. One wrong line shows that the check works.
PINNED = [
    ("p1", "https://www.Acme.com/about?x=1", "https://www.linkedin.com/company/Acme-Inc/", "Acme, Inc.", "acme.com", "acme-inc", "acme"),
    ("p2", " HTTP://shop.acme.co.uk.:8080 ", "http://uk.linkedin.com/company/acme?trk=x", "ACME (Holdings) Ltd", "shop.acme.co.uk",
     "acme", "acmeholdings"),
    ("p3", "", None, "  ", None, None, None),
    ("p4", "beta.io", "linkedin.com/in/person", "Beta GmbH", "wrong.io", None, "beta"),
]


@operator(r"""SELECT CAST(page_id AS VARCHAR) AS entity_id, nullif(rtrim(regexp_replace(lower(string_split_regex(
                    regexp_replace(url, '^https?://', ''), '[/?#:]')[1]), '^www\.', ''), '.'), '') AS domain_key,
                    NULL::VARCHAR AS linkedin_slug, NULL::VARCHAR AS name_key, true AS agrees FROM pages
             UNION ALL
             SELECT p.id, p.d, p.s, p.n, p.id <> 'p4' FROM (SELECT unnest([
                 {'id': 'p1', 'd': 'acme.com', 's': 'acme-inc', 'n': 'acme'},
                 {'id': 'p2', 'd': 'shop.acme.co.uk', 's': 'acme', 'n': 'acmeholdings'},
                 {'id': 'p3', 'd': NULL, 's': NULL, 'n': NULL}, {'id': 'p4', 'd': 'beta.io', 's': NULL, 'n': 'beta'}]) AS p)""")
def pinned_normalisers(spark, sf_dir):
    """The keys of every page and of the pinned lines, and whether they are the expected ones: for a page, its host as a
    parser of addresses reads it. Only the line made wrong on purpose disagrees."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("company_id"), F.col("url").alias("company_website"))
    pinned = spark.createDataFrame([p[:4] for p in PINNED], "company_id string, company_website string, linkedin_url string, company_name string")
    companies = pinned.unionByName(pages, allowMissingColumns=True).withColumn("linkedin_domain", F.lit(None).cast("string"))
    accounts = spark.createDataFrame([], "account_id string, account_name string, domain string, linkedin_company_url string, ticker string")
    keys = normalised_entities(accounts, companies)
    expected = spark.createDataFrame([("company", p[0], *p[4:]) for p in PINNED],
                                     "entity_type string, entity_id string, domain_key string, linkedin_slug string, name_key string")
    host = F.rtrim(F.regexp_replace(F.lower(F.try_parse_url("company_website", F.lit("HOST"))), r"^www\.", ""), F.lit("."))
    expected = expected.unionByName(pages.select(F.lit("company").alias("entity_type"), F.col("company_id").alias("entity_id"),
                                                 host.alias("domain_key")), allowMissingColumns=True)
    wrong = pinned_keys(expected, keys).select("entity_id", F.lit(False).alias("agrees"))
    return keys.join(wrong, "entity_id", "left").select(
        "entity_id", "domain_key", "linkedin_slug", "name_key", F.coalesce("agrees", F.lit(True)).alias("agrees"))


# ------------------------------------------------------------- one row per key, lists, rank

@operator("""SELECT event_id, user_id, event_type, ts FROM events
             QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""")
def keep_first_per_day(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return keep_first(events, ["user_id", "event_type", "day"], ["ts"], ["event_id"]).select(
        "event_id", "user_id", "event_type", "ts")


@operator("""SELECT c_custkey, o_orderkey, o_orderdate FROM customer LEFT JOIN (
                 SELECT o_custkey, max_by(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate
                 FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def latest_order_per_customer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    latest = latest_per_key(orders, ["c_custkey"], "o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "customer").select("c_custkey").join(latest, "c_custkey", "left")


@operator(f"""SELECT o_custkey, {listed('o_orderpriority')} AS priorities,
              {listed('CAST(year(o_orderdate) AS VARCHAR)')} AS years FROM orders GROUP BY o_custkey""")
def list_cells(spark, sf_dir):
    """Lists over a fixed domain stay in one cell: five priorities, seven years."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        small_list(F.col("o_orderpriority")).alias("priorities"),
        small_list(F.year("o_orderdate").cast("string")).alias("years"))


@operator("SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS order_day FROM orders WHERE o_orderdate IS NOT NULL")
def list_rows(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderdate").cast("date"), "order_day")


@operator("SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 400000 AND o_orderstatus IS NOT NULL")
def ordered_list_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    return listed_in_order(orders, ["o_custkey"], "o_orderstatus", ["o_orderdate", "o_orderkey"])


@operator("""SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders""")
def global_rank_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return global_rank(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()],
                       ["o_orderkey", "o_totalprice"], "position", Scratch(spark)).select("o_orderkey", "position")


# ------------------------------------------------------------------- filters and aggregates

@operator("""SELECT event_type, count(*) AS events, count(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-24') AS last_7,
             count(*) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-01') AS last_30 FROM events GROUP BY event_type""")
def lookback_counts(spark, sf_dir):
    week = Settings(as_of_date="2024-01-30", lookback_days=7)
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("events"), count_if(in_lookback(F.col("ts"), week)).alias("last_7"),
        count_if(in_lookback(F.col("ts"), CFG)).alias("last_30"))


@operator("""SELECT l_suppkey, count(DISTINCT l_partkey) AS parts,
             count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts,
             CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS BIGINT) AS open_lines,
             coalesce(bool_or(l_discount >= 0.1 AND l_quantity >= 50), false) AS has_big_discount,
             min(l_shipdate) AS first_ship, max(l_tax) AS top_tax FROM lineitem GROUP BY l_suppkey""")
def conditional_aggregates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.countDistinct("l_partkey").alias("parts"),
        F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("returned_parts"),
        count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        any_true((F.col("l_discount") >= 0.1) & (F.col("l_quantity") >= 50)).alias("has_big_discount"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_tax").alias("top_tax"))


@operator(f"""SELECT c_nationkey, {', '.join(f"CAST(count(*) FILTER (WHERE c_mktsegment = '{s}') AS BIGINT) AS {s.lower()}"
                                            for s in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'))},
              {half_up("(count(*) FILTER (WHERE c_acctbal < 0))::DOUBLE / nullif(count(*) FILTER (WHERE c_acctbal > 5000), 0)")} AS debt_ratio
              FROM customer GROUP BY c_nationkey""")
def pivot_and_ratio(spark, sf_dir):
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        *[count_if(F.col("c_mktsegment") == s).alias(s.lower()) for s in segments],
        safe_ratio(count_if(F.col("c_acctbal") < 0), count_if(F.col("c_acctbal") > 5000)).alias("debt_ratio"))


@operator("""
    WITH p AS (SELECT *, CASE WHEN s_acctbal >= 7000 THEN 3 WHEN s_acctbal >= 4000 THEN 2 WHEN s_acctbal >= 1000 THEN 1
                         ELSE 0 END AS r FROM supplier)
    SELECT s_suppkey, r AS plan_rank, ['free', 'pro', 'enterprise'][r] AS plan_again,
           if(s_acctbal >= 5000, 'rich', if(s_acctbal >= 0, 'fine', 'owing')) AS label FROM p""")
def ladders_and_ranks(spark, sf_dir):
    bal = F.col("s_acctbal")
    plan = ladder((bal >= 7000, "enterprise"), (bal >= 4000, "pro"), (bal >= 1000, "free"), otherwise="trial")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", plan_rank(plan).alias("plan_rank"), plan_of_rank(plan_rank(plan)).alias("plan_again"),
        ladder((bal >= 5000, "rich"), (bal >= 0, "fine"), otherwise="owing").alias("label"))


# ----------------------------------------------------------------------------------- joins

@operator("""SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
             LEFT JOIN region ON r_regionkey = n_regionkey""")
def lookup_dimension(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    named = lookup(nation, table(spark, sf_dir, "region"), ["r_regionkey"])
    dim = named.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return lookup(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), dim, ["c_nationkey"]).drop("c_nationkey")


@operator("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey
             WHERE o_custkey = c_custkey AND l_returnflag = 'R' AND l_quantity > 45)""")
def anti_join_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").select("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    buyers = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_custkey").distinct()
    return table(spark, sf_dir, "customer").select("c_custkey").join(
        buyers, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@operator("""SELECT CAST(user_id AS VARCHAR) AS who, 'event' AS kind, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id
             UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'order', count(*) FROM orders GROUP BY o_custkey""")
def union_of_branches(spark, sf_dir):
    events = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")).select(
        F.col("user_id").cast("string").alias("who"), F.lit("event").alias("kind"), "n")
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).select(
        "n", F.lit("order").alias("kind"), F.col("o_custkey").cast("string").alias("who"))
    return events.unionByName(orders)


# ------------------------------------------------------------------------------------ checks

@operator("SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE NOT (l_discount + l_tax <= 0.15)")
def dq_expression_is_true(spark, sf_dir):
    return C.expression_is_true(table(spark, sf_dir, "lineitem"), "l_discount + l_tax <= 0.15").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax")


@operator("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
def dq_between(spark, sf_dir):
    return C.between(table(spark, sf_dir, "customer"), "c_acctbal", 0, 9000).select("c_custkey", "c_acctbal")


@operator("""SELECT d.n AS model_rows, l.n AS compare_rows FROM (SELECT count(*) AS n FROM documents) d,
             (SELECT count(*) AS n FROM labels) l WHERE d.n <> l.n""")
def dq_row_count_matches(spark, sf_dir):
    return C.row_count_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@operator("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_unique_combination(spark, sf_dir):
    return C.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@operator("SELECT p_name, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return C.unique(table(spark, sf_dir, "part"), "p_name")


@operator("""SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def dq_not_null(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return C.not_null(joined, "quality")


@operator("SELECT doc_id, lang FROM documents WHERE lang NOT IN ('en', 'de')")
def dq_accepted_values(spark, sf_dir):
    return C.accepted_values(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", ["en", "de"])


@operator("SELECT event_id, user_id FROM events ANTI JOIN supplier ON s_suppkey = user_id")
def dq_relationships(spark, sf_dir):
    return C.relationships(table(spark, sf_dir, "events").select("event_id", "user_id"), "user_id",
                           table(spark, sf_dir, "supplier"), "s_suppkey")


@operator("""SELECT d.doc_id, d.lang AS expected_lang, CASE WHEN quality = 1 THEN 'en' END AS actual_lang
             FROM documents d LEFT JOIN labels l USING (doc_id)
             WHERE d.lang IS DISTINCT FROM CASE WHEN quality = 1 THEN 'en' END""")
def dq_differences(spark, sf_dir):
    expected = table(spark, sf_dir, "documents").select("doc_id", "lang")
    actual = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "en").alias("lang"))
    return C.differences(expected, actual, ["doc_id"], ["lang"])


# ------------------------------------------------------------------------- profile and freshness

_COLUMNS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                  ("n_chars", "bigint")],
    "embeddings": [("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int")],
    "pages": [("page_id", "bigint"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "bigint"), ("text", "string")],
    "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string")],
}


@operator(" UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{d}' AS data_type, count(*) AS rows_total,
        count("{c}") AS rows_populated,
        CAST(count(*) FILTER (WHERE nullif(trim(CAST("{c}" AS VARCHAR)), '') IS NULL) AS BIGINT) AS rows_null_or_blank,
        count(DISTINCT "{c}") AS distinct_values,
        count(DISTINCT "{c}") = count(*) AND count(*) > 1 AS is_unique_key FROM {t}"""
    for t, columns in _COLUMNS.items() for c, d in columns))
def column_profile(spark, sf_dir):
    return column_profiles({t: table(spark, sf_dir, t) for t in _COLUMNS})


@operator(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _COLUMNS))
def row_counts(spark, sf_dir):
    return table_row_counts({t: table(spark, sf_dir, t) for t in _COLUMNS})


_NOW = "2024-01-30 06:00:00"


@operator(f"""SELECT event_type, max(ts) AS max_loaded_at,
              round(date_diff('second', max(ts), TIMESTAMP '{_NOW}') / 3600.0, 4)::DOUBLE AS age_hours,
              CASE WHEN age_hours > 12 THEN 'error' WHEN age_hours > 3 THEN 'warn' ELSE 'pass' END AS status
              FROM events GROUP BY event_type""")
def freshness(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    now = F.lit(_NOW).cast("timestamp_ntz")
    return check_source_freshness(events, "product", now, loaded_at="ts", by=["event_type"])


# ------------------------------------------------------------- records that staging rejects

#: Events as delivered news: errors carry their name for a time, and large values a word for a confidence.
_DELIVERED_NEWS = """
    SELECT CAST(event_id AS {text}) AS id, CAST(user_id AS {text}) AS company_id, event_type AS category, props AS summary,
           CASE WHEN event_type = 'error' THEN event_type ELSE ' 2024-01-02 03:04:05 ' END AS found_at,
           CASE WHEN value > 150 THEN 'large' WHEN value > 100 THEN '' ELSE '0.5' END AS confidence,
           CAST(NULL AS {text}) AS product_name, 'u' AS source_url FROM events"""


def _delivered_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_DELIVERED_NEWS.format(text="STRING").replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))


@operator(f"""SELECT 'news_events' AS source, concat_ws('; ',
                 CASE WHEN try_cast(trim(found_at) AS TIMESTAMP) IS NULL THEN 'found_at: not a timestamp' END,
                 CASE WHEN confidence <> '' AND try_cast(confidence AS DOUBLE) IS NULL THEN 'confidence: not a double' END) AS reasons,
                 '{{"id":"' || id || '","company_id":"' || company_id || '","category":"' || category || '","summary":"'
                 || replace(summary, '"', chr(92) || '"') || '","found_at":"' || found_at || '","confidence":"' || confidence
                 || '","source_url":"u"}}' AS record
              FROM ({_DELIVERED_NEWS.format(text="VARCHAR")})
              WHERE try_cast(trim(found_at) AS TIMESTAMP) IS NULL OR (confidence <> '' AND try_cast(confidence AS DOUBLE) IS NULL)""")
def rejected_records(spark, sf_dir):
    return rejects(_delivered_news(spark, sf_dir), "news_events")


@operator(f"""SELECT id AS news_id, company_id, category, summary, TIMESTAMP '2024-01-02 03:04:05' AS found_at,
                 CASE WHEN confidence <> '' THEN 0.5::DOUBLE END AS vendor_confidence, NULL::VARCHAR AS product_name, source_url
              FROM ({_DELIVERED_NEWS.format(text="VARCHAR")}) WHERE category <> 'error' AND confidence <> 'large'""")
def staged_beside_rejects(spark, sf_dir):
    return stage(_delivered_news(spark, sf_dir), "news_events")


# ------------------------------------------------------------------------- freshness of the other kinds of sources

def _freshness_sql(source: str, group: str, loaded_at: str, now: str, warn: int, error: int) -> str:
    return f"""SELECT {group}, max({loaded_at}) AS max_loaded_at,
        round(date_diff('second', max({loaded_at}), TIMESTAMP '{now}') / 3600.0, 4)::DOUBLE AS age_hours,
        CASE WHEN age_hours > {error} THEN 'error' WHEN age_hours > {warn} THEN 'warn' ELSE 'pass' END AS status
        FROM {source} GROUP BY {group}"""


# Half a day after the last order, and after the last shipment.
_LAST_ORDER, _LAST_SHIPMENT = "2001-08-01 12:00:00", "2001-11-05 12:00:00"


@operator(_freshness_sql("orders", "o_orderpriority", "o_orderdate", _LAST_ORDER, 6, 24))
def freshness_crm(spark, sf_dir):
    now = F.lit(_LAST_ORDER).cast("timestamp_ntz")
    return check_source_freshness(table(spark, sf_dir, "orders"), "crm", now, loaded_at="o_orderdate", by=["o_orderpriority"])


@operator(_freshness_sql("lineitem", "l_suppkey", "l_shipdate", _LAST_SHIPMENT, 36, 72))
def freshness_signals(spark, sf_dir):
    now = F.lit(_LAST_SHIPMENT).cast("timestamp_ntz")
    return check_source_freshness(table(spark, sf_dir, "lineitem"), "signals", now, loaded_at="l_shipdate", by=["l_suppkey"])
