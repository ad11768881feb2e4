from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import rows

from accountlens.operators import checks as C
from accountlens.operators.dedupe import keep_first, latest_per_key, sort_key
from accountlens.operators.joins import lookup, lookup_inner
from accountlens.operators.lists import listed, listed_in_order
from accountlens.operators.rank import global_rank
from accountlens.sources.storage import Scratch
from pyspark.sql import functions as F


def test_keep_first_puts_null_last_and_is_total(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 3), ("a", 5, 2), ("b", None, 9), (None, 1, 1), (None, 0, 2)],
                               "k string, o int, v int")
    assert rows(keep_first(df, ["k"], ["o"])) == [(None, 0, 2), ("a", 5, 2), ("b", None, 9)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "q")], "k string, t int, i string")
    assert rows(latest_per_key(df, ["k"], "t", "i")) == [("a", 2, "y"), ("b", None, "q")]


def test_sort_key_orders_null_last(spark):
    df = spark.createDataFrame([(None, "late"), (3, "first"), (4, "second")], "o int, v string")
    assert df.agg(F.min_by("v", sort_key("o"))).first()[0] == "first"


@pytest.fixture(scope="module")
def skewed(spark):
    # A third of the rows has one key, a third has none.
    facts = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
        .alias("k"))
    dim = spark.createDataFrame([("hot", "H", None)] + [(f"k{i}", f"v{i}", i) for i in range(0, 500)],
                                "k string, v string, w int")
    return facts, dim


def test_lookup_equals_left_join(skewed):
    facts, dim = skewed
    assert rows(lookup(facts, dim, ["k"])) == rows(facts.join(dim, "k", "left").select("id", "k", "v", "w"))
    assert rows(lookup_inner(facts, dim, ["k"])) == rows(facts.join(dim, "k").select("id", "k", "v", "w"))


def test_lookup_splits_a_hot_key_and_null(spark):
    """One key and null each hold a third of the rows: adaptive execution splits their partitions, and nothing changes."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    facts = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
        .alias("k"))
    dim = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v")).union(
        spark.sql("SELECT 'hot', -1L"))
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(facts, dim, ["k"])
        found = joined.groupBy((F.col("v") == -1).alias("hot"), F.col("v").isNull().alias("none")).count().collect()
        execution = joined._jdf.queryExecution()
        joined.write.format("noop").mode("overwrite").save()
        joined._jdf.queryExecution().executedPlan().execute().count()
        plan = execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(r["count"] for r in found) == [20_000] * 3
    assert "skew=true" in plan


def test_lookup_on_two_keys(spark):
    facts = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, None, 1), (4, "b", 2)], "i int, x string, y int")
    dim = spark.createDataFrame([("a", 1, "hit"), ("b", 2, "two")], "x string, y int, v string")
    assert rows(lookup(facts, dim, ["x", "y"]), "i", "v") == [(1, "hit"), (2, None), (3, None), (4, "two")]


def test_listed(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("a", None), ("b", None)], "k string, v string")
    assert rows(listed(df, ["k"], "v", "l")) == [("a", "x"), ("a", "y")]


def test_listed_in_order_keeps_repeats(spark):
    df = spark.createDataFrame([("a", "low", 1), ("a", "top", 3), ("a", "low", 2), ("a", None, 9)], "k string, v string, o int")
    assert rows(listed_in_order(df, ["k"], "v", ["o"])) == [("a", 1, "low"), ("a", 2, "low"), ("a", 3, "top")]


@pytest.mark.parametrize("ranges", [None, 1, 3, 7])
def test_global_rank_equals_plain_row_number(spark, ranges):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("a"),
                                 F.when(F.col("id") % 5 == 0, F.lit(-1.0)).otherwise(F.col("id") % 7 / 7.0).alias("g"))
    order = [F.col("a").desc(), F.col("g").desc(), F.col("id").asc()]
    ranked = global_rank(df, order, ["id", "a", "g"], "r", Scratch(spark), ranges).collect()
    expected = sorted(df.collect(), key=lambda r: (-r.a, -r.g, r.id))
    assert [r.id for r in sorted(ranked, key=lambda r: r.r)] == [r.id for r in expected]
    assert sorted(r.r for r in ranked) == list(range(1, 501))


def test_global_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "id string")
    assert global_rank(empty, [F.col("id").asc()], ["id"], "r", Scratch(spark)).count() == 0


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", 1.5), (2, None, None), (None, "a", -1.0)], "k int, v string, x double")
    assert rows(C.expression_is_true(df, "x > 0"), "x") == [(-1.0,)]            # null is not a failure
    assert rows(C.between(df, "x", 0, 1), "x") == [(-1.0,), (1.5,)]
    assert rows(C.not_null(df, "v"), "k") == [(2,)]
    assert rows(C.accepted_values(df, "v", ["a"]), "v") == [("b",)]
    assert rows(C.unique(df, "k")) == [(1, 2)]
    assert rows(C.unique_combination(df, ["k", "v"])) == []
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(C.relationships(df, "k", parent, "id"), "k") == [(2,)]
    assert rows(C.row_count_matches(df, parent)) == [(4, 1)]
    assert rows(C.row_count_matches(df, df)) == []
    assert rows(C.row_count_matches(df.limit(0), parent)) == [(0, 1)]


def test_differences_treat_null_as_equal(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z")], "k int, v string")
    assert rows(C.differences(a, b, ["k"], ["v"])) == [(2, "x", "z"), (3, "y", None)]


def test_scratch_folder_is_the_checkpoint_folder(spark, tmp_path):
    from accountlens.sources import storage
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    scratch = Scratch(spark)
    saved = scratch.save(spark.createDataFrame([(dt.date(2024, 1, 1),)], "d date"), "t")
    assert rows(saved) == [(dt.date(2024, 1, 1),)]
    assert os.path.isdir(scratch.folder.removeprefix("file:"))
    scratch.remove()
    assert not os.path.exists(scratch.folder.removeprefix("file:"))
