"""A table that is written after each of its moves: the same rows, and nothing of the way is left on disk."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_activity_and_signals import CFG, sources

from accountlens.operators.dedupe import keep_first
from accountlens.plans import activity as A
from accountlens.sources.rules import load_rules
from accountlens.sources.storage import Relay, Scratch


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(setting, "false")
    df = spark.range(5000).repartition(3).groupBy((F.col("id") % 70).alias("k")).agg(F.count("*").alias("n"))
    saved = Scratch(spark).save(df, "t")
    assert not shuffle_files(spark) - before
    assert spark.conf.get(setting, "false") == was
    assert saved.agg(F.sum("n")).first()[0] == 5000
    with pytest.raises(Exception, match="no_such"):
        Scratch(spark).write(df.withColumn("x", F.raise_error(F.lit("no_such"))), "t")
    assert spark.conf.get(setting, "false") == was


def step_folders(scratch):
    folder = scratch.folder.removeprefix("file:")
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


@pytest.mark.parametrize("slices", [1, 3])
def test_steps_in_slices(spark, slices):
    data = [(i % 7 if i % 11 else None, i) for i in range(200)]
    df = spark.createDataFrame(data, "k long, v long")
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(5)], "k long, d string")
    scratch = Scratch(spark)
    relay = Relay(scratch, "t", slices, 1)
    relay.begin(df)
    beside = relay.beside(dim)
    relay.step(["k"], lambda some: some.join(beside, "k", "left"))
    last = relay.step(["k"], lambda some: keep_first(some, ["k"], ["v"]))
    assert rows(last, "k", "v", "d") == rows(keep_first(df.join(dim, "k", "left"), ["k"], ["v"]), "k", "v", "d")
    assert len([f for f in step_folders(scratch) if f.startswith("t-step")]) == 1
    plan = df.join(beside, "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    relay.end()
    assert step_folders(scratch) == []


@pytest.mark.parametrize("slices", [1, 4])
def test_activity_by_steps(spark, slices):
    """Text beyond the labels, ids that look like other ids, and repeated events."""
    delivered = sources(spark)
    projects = spark.createDataFrame([("p1", "o1"), ("p_low", "o2"), ("o1", "o2")], "project_id string, org_id string")
    identity = spark.createDataFrame([("u1", "u1"), ("u2", "u2")], "user_id string, person_id string")
    people = spark.createDataFrame([("u1", "B", "resolved", 0.85)],
                                   "person_id string, account_id string, resolution_status string, account_confidence double")
    orgs = spark.createDataFrame([("o1", "A", "resolved", 0.95), ("o2", None, "odd status", None)],
                                 "org_id string, account_id string, resolution_status string, mapping_confidence double")

    def made(relay=None):
        events = A.classified_events(delivered, relay)
        return A.product_activity(events, projects, identity, people, orgs, load_rules(spark, "surface_signals"), CFG, relay)

    scratch = Scratch(spark)
    relay = Relay(scratch, "activity", slices, 1)
    assert rows(made(relay)) == rows(made())
    assert len([f for f in step_folders(scratch) if f.startswith("activity-step")]) == 1
    # What the classifiers say, whole.
    said = A.experiments(delivered["experiments"]).filter("object_id = 'e2'")
    columns = [c for c in said.columns if c != "direct_org_id"]
    assert rows(made(relay).filter("object_id = 'e2'"), *columns) == rows(said, *columns)


def test_packed_events_are_small(spark):
    """Names of tables and labels are numbers, and an object's id is there once."""
    df = A.packed(A.experiments(sources(spark)["experiments"]), "experiments")
    assert {t for c, t in df.dtypes if c in ("kind", "signal", "actor")} == {"tinyint"}
    assert {r.object for r in df.collect()} == {None}
    assert list(A.SIGNALS) == sorted(A.SIGNALS) and list(A.ACTORS) == sorted(A.ACTORS)
