"""Daily sums that are kept against a scan of all rows, after late, corrected and deleted rows."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from conftest import rows

from accountlens.config import DEFAULTS
from accountlens.plans.trends import DailyVolume, org_trace_trend

CFG = replace(DEFAULTS, as_of_date="2026-03-31", trend_days=7)


def volume(spark, data):
    return spark.createDataFrame(data, "org_id string, day string, ingested_gb double").selectExpr(
        "org_id", "cast(day AS date) AS activity_date", "ingested_gb")


def some(n, seed):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", "c", None]), rng.choice([f"2026-03-{d:02}" for d in range(20, 32)] + [None]), rng.randrange(64) / 4)
            for _ in range(n)]


@pytest.fixture
def kept(spark, tmp_path):
    return DailyVolume(spark, str(tmp_path / "daily"))


def test_late_rows_cost_their_own_days(spark, kept):
    first, late = some(200, 1), [("a", "2026-03-25", 9.0), ("d", "2026-03-30", 2.0), ("a", None, 1.0)]
    kept.refresh(volume(spark, first))
    assert rows(kept.trend(CFG)) == rows(org_trace_trend(volume(spark, first), CFG))
    before = {f for f in kept.read().inputFiles()}
    everything = volume(spark, first + late)
    kept.refresh(everything, volume(spark, late))
    assert rows(kept.trend(CFG)) == rows(org_trace_trend(everything, CFG))
    after = {f for f in kept.read().inputFiles()}
    touched = {f.split("activity_date=")[1].split("/")[0] for f in before ^ after}
    assert touched == {"2026-03-25", "2026-03-30"}
    # Again: nothing changes.
    kept.refresh(everything, volume(spark, late))
    assert rows(kept.trend(CFG)) == rows(org_trace_trend(everything, CFG))


def test_a_day_without_rows_loses_its_sums(spark, kept):
    data = [("a", "2026-03-30", 1.0), ("a", "2026-03-31", 5.0)]
    kept.refresh(volume(spark, data))
    kept.refresh(volume(spark, data[:1]), volume(spark, data[1:]))
    assert rows(kept.read(), "org_id", "gb") == [("a", 1.0)]
    assert rows(kept.trend(CFG)) == rows(org_trace_trend(volume(spark, data[:1]), CFG))


def test_a_trend_opens_the_windows_days(spark, kept):
    kept.refresh(volume(spark, some(300, 2)))
    plan = kept.trend(CFG)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "2026-03-24" in filters and "activity_date" in filters


def test_nothing_delivered(spark, kept):
    kept.refresh(volume(spark, some(20, 3)))
    kept.refresh(volume(spark, some(20, 3)), volume(spark, []))
    assert kept.read().count() > 0
