from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from accountlens.functions import keys as K
from accountlens.plans.check_suite import pinned_keys
from accountlens.plans.match_keys import build_match_keys, normalised_entities
from pyspark.sql import functions as F

DOMAINS = [
    ("https://www.Nimbus.io/a?b=c", "nimbus.io"),
    ("HTTP://nimbus.io", "nimbus.io"),
    ("  WWW.NIMBUS.IO.  ", "nimbus.io"),
    ("HTTPS://WWW.SHOP.ORG.NZ:8443/path", "shop.org.nz"),
    ("nimbus.io?x=1", "nimbus.io"),
    ("nimbus.io#top", "nimbus.io"),
    ("http://http://nimbus.io", "nimbus.io"),
    ("www.www.nimbus.io", "www.nimbus.io"),     # one leading www. only
    ("nimbus.io..", "nimbus.io."),              # one trailing dot only
    (".", None),
    ("https://", None),
    ("", None),
    (None, None),
]
SLUGS = [
    ("https://www.linkedin.com/company/Nimbus-Labs/", "nimbus-labs"),
    ("http://fr.linkedin.com/company/nimbus-labs?trk=1", "nimbus-labs"),
    ("linkedin.com/company/nimbus-labs#about", "nimbus-labs"),
    ("https://linkedin.com/in/somebody", None),
    ("https://linkedin.com/company/", None),
    (None, None),
]
NAMES = [
    ("Nimbus Corporation", "nimbus", "nimbus"),
    ("Nimbus, Inc.", "nimbus", "nimbus"),
    ("Nimbus Cloud Co. Ltd", "nimbuscloudco", "nimbus"),     # one legal form only
    ("The Kite-Works (Pty) LLC", "thekiteworkspty", "the"),
    ("O'Hara GmbH", "ohara", "ohara"),
    ("Inc", "inc", "inc"),                                   # nothing in front of the legal form
    ("Limited Brands", "limitedbrands", "limited"),
    ("   ", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("url,expected", DOMAINS)
def test_domain_key(spark, url, expected):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(K.domain_key(F.col("u"))).first()[0] == expected


def test_linkedin_slug(spark):
    df = spark.createDataFrame(SLUGS, "u string, e string").withColumn("s", K.linkedin_slug(F.col("u")))
    assert [r.s for r in df.collect()] == [e for _, e in SLUGS]


def test_names(spark):
    df = spark.createDataFrame(NAMES, "n string, k string, t string").select(
        K.company_name_key(F.col("n")).alias("key"), K.name_first_token(F.col("n")).alias("token"))
    assert [tuple(r) for r in df.collect()] == [(k, t) for _, k, t in NAMES]


def test_token_is_specific_from_four_letters_on(spark):
    df = spark.createDataFrame([("the",), ("kite",), (None,)], "t string")
    assert [r[0] for r in df.select(K.token_is_specific(F.col("t"), 4)).collect()] == [False, True, False]


def test_ticker(spark):
    df = spark.createDataFrame([("nyse:nmb",), ("nmb",), (None,)], "t string").select(
        K.ticker_exchange(F.col("t")).alias("e"), K.ticker_symbol(F.col("t")).alias("s"))
    assert [tuple(r) for r in df.collect()] == [("NYSE", "NMB"), (None, "NMB"), (None, None)]


@settings(max_examples=1, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"[a-z]{1,8}(\.[a-z]{2,5}){1,2}", fullmatch=True).filter(
    lambda h: not h.startswith("www.")), min_size=50, max_size=50))
def test_domain_key_keeps_plain_hosts(spark, hosts):
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    messy = F.concat(F.lit(" HTTPS://www."), F.col("h"), F.lit(":443/x?y#z"))
    wrong = df.filter((K.domain_key(F.col("h")) != F.col("h")) | (K.domain_key(messy) != F.col("h")))
    assert wrong.count() == 0


ACCOUNTS = [
    ("A1", "Nimbus Corp", "Nimbus.io", "https://www.linkedin.com/company/nimbus", "NYSE:NMB"),
    ("A2", "Twin One", "twin.com", None, None),
    ("A3", "Twin Two", "https://twin.com/", None, "twin"),
    ("A4", "Bare", None, None, None),
]
COMPANIES = [
    ("c1", "Nimbus Corporation", "https://www.nimbus.io/p?q", "http://uk.linkedin.com/company/Nimbus/?t", "nimbus.io"),
    ("c2", "The Kite Company", "HTTPS://WWW.KITE.CO.UK:8443/p", None, None),
    ("c3", "Nothing Ltd", None, None, None),
]
ACCOUNT_SCHEMA = "account_id string, account_name string, domain string, linkedin_company_url string, ticker string"
COMPANY_SCHEMA = ("company_id string, company_name string, company_website string, linkedin_url string, "
                  "linkedin_domain string")


def match_keys(spark):
    return build_match_keys(normalised_entities(spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA),
                                                spark.createDataFrame(COMPANIES, COMPANY_SCHEMA)))


def test_both_sides_get_the_same_keys(spark):
    assert rows(match_keys(spark), "entity_id", "domain_key", "second_domain_key", "linkedin_slug", "name_key",
                "name_first_token", "name_token_is_specific", "is_domain_shared", "has_no_match_keys") == sorted([
        ("A1", "nimbus.io", None, "nimbus", "nimbus", "nimbus", True, False, False),
        ("A2", "twin.com", None, None, "twinone", "twin", True, True, False),
        ("A3", "twin.com", None, None, "twintwo", "twin", True, True, False),
        ("A4", None, None, None, "bare", "bare", True, False, True),
        ("c1", "nimbus.io", "nimbus.io", "nimbus", "nimbus", "nimbus", True, False, False),
        ("c2", "kite.co.uk", None, None, "thekite", "the", False, False, False),
        ("c3", None, None, None, "nothing", "nothing", True, False, True),
    ])


def test_pinned_outputs_report_only_differences(spark):
    expected = spark.createDataFrame([
        ("account", "A1", "nimbus.io", "nimbus", "nimbus"),
        ("company", "c3", None, None, "nothing"),
        ("company", "c2", "www.kite.co.uk", None, "thekite"),
    ], "entity_type string, entity_id string, domain_key string, linkedin_slug string, name_key string")
    assert [r.entity_id for r in pinned_keys(expected, match_keys(spark)).collect()] == ["c2"]


@pytest.mark.parametrize("wrong", [lambda c: F.lower(c), lambda c: F.regexp_extract(c, r"://(?:www\.)?([^/]+)", 1).substr(1, 12),
                                   lambda c: F.lit("none")])
def test_a_wrong_normaliser_is_caught_on_every_page(spark, monkeypatch, tmp_path, wrong):
    pages = [(1, "https://www.Shop.example.org:81/x"), (2, "http://a-very-long-host.example.com/b?c"), (3, "https://x.io")]
    spark.createDataFrame([(i, u, "") for i, u in pages], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    from workload.operator_queries import pinned_normalisers

    def agreeing():
        return {r.entity_id for r in pinned_normalisers(spark, str(tmp_path)).collect() if r.agrees}

    assert agreeing() == {"1", "2", "3", "p1", "p2", "p3"}
    monkeypatch.setattr("accountlens.functions.keys.domain_key", wrong)
    assert not agreeing() >= {"1", "2", "3"} and "p1" not in agreeing()
