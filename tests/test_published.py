"""Publishing as one switch: what readers see before, between and after the moves."""

from __future__ import annotations

import pytest
from conftest import rows

from accountlens.sources.storage import Published
from pyspark.sql import functions as F

NAMES = ["people", "orgs", "days"]


def add_all(p, rows_each):
    for name in NAMES[:2]:
        p.add(p.spark.range(rows_each), "unified", name)
    days = p.spark.range(rows_each).withColumn("day", F.expr("if(id = 0, null, date'2026-01-01' + cast(id as int))"))
    p.add(days, "cleansed", "days", ["day"])


def publish(spark, env, run, rows_each):
    p = Published(spark, env, run)
    add_all(p, rows_each)
    p.show()


def counts(session, env):
    return [session.table(f"{env}_{'cleansed' if n == 'days' else 'unified'}.{n}").count() for n in NAMES]


def test_a_reader_never_sees_two_runs(spark, monkeypatch):
    publish(spark, "one", "1", 3)
    reader = spark.newSession()
    assert counts(reader, "one") == [3, 3, 3]
    old, between, moves = reader.table("one_unified.people"), [], []
    view, move, add = Published._view, Published._move, Published.add

    def watched(f, note=None):
        def run(self, *args):
            between.append(counts(reader, "one"))
            moves.extend([args] if note else [])
            return f(self, *args)
        return run

    monkeypatch.setattr(Published, "add", watched(add))
    monkeypatch.setattr(Published, "_view", watched(view))
    monkeypatch.setattr(Published, "_move", watched(move, "move"))
    publish(spark, "one", "2", 5)
    # While tables are written and until the one move, readers see the run before as a whole.
    assert moves == [("2",)] and len(between) == 2 * len(NAMES) + 1 and set(map(tuple, between)) == {(3, 3, 3)}
    assert counts(reader, "one") == [5, 5, 5]
    # A query that has begun reads on; one query over two views reads one run.
    assert old.count() == 3
    both = reader.table("one_unified.people").join(reader.table("one_unified.orgs"), "id")
    assert both.count() == 5
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("run#") >= 2 and "Subquery" not in plan and "= 1)" not in plan


def test_a_failed_run_is_never_seen_and_goes(spark):
    publish(spark, "two", "1", 3)
    add_all(Published(spark, "two", "2"), 7)
    reader = spark.newSession()
    assert Published(spark, "two", "").current() == "1" and counts(reader, "two") == [3, 3, 3]
    publish(spark, "two", "3", 4)
    publish(spark, "two", "4", 2)
    assert counts(reader, "two") == [2, 2, 2]
    for table in ("unified.people__runs", "cleansed.days__runs"):
        assert {r[0].split("/")[0] for r in reader.sql(f"SHOW PARTITIONS two_{table}").collect()} == {"run=3", "run=4"}


def test_views_are_empty_before_the_first_move(spark, monkeypatch):
    monkeypatch.setattr(Published, "_drop_runs", lambda *_, **__: None)
    move, seen = Published._move, []

    def watched(self, run):
        if run:
            seen.append(counts(spark.newSession(), "three"))
        move(self, run)

    monkeypatch.setattr(Published, "_move", watched)
    publish(spark, "three", "1", 3)
    assert seen == [[0, 0, 0]] and counts(spark, "three") == [3, 3, 3]


def test_columns_may_join_but_not_change(spark):
    def one(run, df):
        p = Published(spark, "shape", run)
        p.add(df, "unified", "t")
        p.show()

    one("1", spark.range(2))
    one("2", spark.range(3).withColumn("more", F.lit("x")))
    assert rows(spark.table("shape_unified.t")) == [(0, "x"), (1, "x"), (2, "x")]
    for wrong in (spark.range(1), spark.range(1).selectExpr("cast(id as string) id", "'x' more"), spark.range(1).withColumn("run", F.lit(1))):
        with pytest.raises(ValueError):
            one("3", wrong)
    assert spark.table("shape_unified.t").count() == 3
