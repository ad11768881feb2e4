"""Every registered query against its DuckDB statement, on the smallest supplied tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(r[i]) for i in order) for r in data)


def test_names_match():
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry._REGISTERED.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 50


# What depends on how many accounts share a key, on tables ten times as large.
LARGE = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="supplied tables are not here")
@pytest.mark.parametrize("name", ["company_resolution", "signal_companies", "extract_companies", "match_candidates",
                                  "account_keys", "review_queue"])
def test_shared_keys_at_a_larger_scale(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{LARGE}/{t}.parquet'")
    df = entry.queries()[name](spark, LARGE)
    result = con.execute(entry.oracle_sql()[name])
    assert table(df.columns, df.collect()) == table([d[0] for d in result.description], result.fetchall())


@pytest.mark.parametrize("name", entry._REGISTERED)
def test_query_equals_statement(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = duck.execute(entry.oracle_sql()[name])
    expected = table([d[0] for d in result.description], result.fetchall())
    assert table(df.columns, df.collect()) == expected
