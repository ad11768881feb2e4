from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

from accountlens.sources import rules
from accountlens.sources.freshness import FRESHNESS, check_freshness, check_source_freshness
from accountlens.plans.check_suite import no_record_lost
from accountlens.sources.staging import (
    DELIVERED, STAGED, clean, read_csv_source, read_table_source, rejects, stage, staging_balance,
)
from accountlens.sources.storage import layer_schema
from pyspark.sql import functions as F


def test_layer_names():
    assert layer_schema("raw") == "raw"
    assert layer_schema("raw", "DEV") == "DEV_raw"
    assert layer_schema(None, "DEV", "main") == "main"


def test_every_delivered_column_is_staged():
    for source, columns in DELIVERED.items():
        taken = {s.partition(":")[0].partition("=")[2] or s.partition(":")[0] for s in STAGED[source].split()}
        assert taken == set(columns.split())


def test_clean(spark):
    df = spark.createDataFrame([(" a ",), ("  ",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(clean(F.col("v"))).collect()] == ["a", None, None, None]


def test_rules(spark, tmp_path):
    assert rules.load_rules(spark, "surface_signals").count() == 9
    assert rows(rules.load_rules(spark, "external_match_rules"), "match_method", "precedence", "base_confidence",
                "can_resolve")[0] == ("company_name", 99, 0.0, False)
    path = tmp_path / "r.csv"
    path.write_text('mapping_source,confidence_score,precedence,rationale\ncontract,0.9,1,"says ""yes"""\n')
    assert rows(rules.load_rules(spark, "org_mapping_sources", str(path))) == [("contract", 0.9, 1, 'says "yes"')]


def test_landed_tables_stage_like_files(spark, tmp_path):
    df = spark.createDataFrame([(" o ", "2026-01-02", "1.5")], "org_id string, ds string, ingested_gb string")
    df.write.parquet(str(tmp_path / "t"))
    assert rows(stage(read_table_source(spark, path=str(tmp_path / "t")), "trace_volume")) == [
        ("o", dt.date(2026, 1, 2), 1.5)]


@pytest.mark.parametrize("hours,status", [(2, "pass"), (3, "pass"), (4, "warn"), (12, "warn"), (13, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2026, 1, 2)
    column, warn, error = FRESHNESS["product"]
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (now - dt.timedelta(days=9),)], f"{column} timestamp_ntz")
    assert check_freshness(df, column, warn, error, F.lit(now)).first().status == status


def test_freshness_by_group_is_one_pass(spark):
    now = dt.datetime(2026, 1, 2)
    df = spark.createDataFrame([("a", now), ("a", now - dt.timedelta(days=1)), ("b", now - dt.timedelta(hours=4))],
                               "g string, _loaded_at timestamp_ntz")
    found = check_source_freshness(df, "product", F.lit(now), by=["g"])
    assert rows(found, "g", "age_hours", "status") == [("a", 0.0, "pass"), ("b", 4.0, "warn")]
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_freshness_of_nothing(spark):
    df = spark.createDataFrame([], "t timestamp_ntz")
    assert check_freshness(df, "t", 1, 2).first().status == "error"


CSV = """org_id,ds,ingested_gb
o1,2026-01-01,1.5
o2,2026-01-02
o3,2026-01-03,2,extra
o4,not a date,x
"o,5",2026-01-05,
 o6 ,, 7
"""


def test_records_are_staged_or_rejected(spark, tmp_path):
    (tmp_path / "raw_trace_volume.csv").write_text(CSV)
    df = read_csv_source(spark, str(tmp_path / "raw_trace_volume.csv"), "trace_volume")
    staged = stage(df, "trace_volume")
    assert rows(staged) == [("o,5", dt.date(2026, 1, 5), None), ("o1", dt.date(2026, 1, 1), 1.5), ("o6", None, 7.0)]
    # However few columns are asked for, a line that does not fit is seen.
    assert staged.count() == 3 and rows(staged, "org_id") == [("o,5",), ("o1",), ("o6",)]
    assert rows(rejects(df, "trace_volume")) == [
        ("trace_volume", "ds: not a date; ingested_gb: not a double", '{"org_id":"o4","ds":"not a date","ingested_gb":"x"}'),
        ("trace_volume", "line does not fit the columns", "o2,2026-01-02"),
        ("trace_volume", "line does not fit the columns", "o3,2026-01-03,2,extra")]
    balance = staging_balance(df, "trace_volume")
    assert rows(balance) == [("trace_volume", 6, 3, 3)] and no_record_lost(balance).count() == 0
    assert no_record_lost(balance.withColumn("rows_rejected", F.lit(2))).count() == 1


def test_typed_cells_of_landed_tables_cannot_be_wrong(spark):
    df = spark.sql("SELECT 'o' AS org_id, DATE'2026-01-02' AS ds, 1.5D AS ingested_gb")
    assert rejects(df, "trace_volume").count() == 0
    plan = stage(df, "trace_volume")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and "cast" not in plan
    text_only = spark.sql("SELECT 'p' AS project_id, 'o' AS org_id, 'n' AS name")
    assert rejects(text_only, "projects").collect() == []


def test_one_bad_cell_does_not_stop_a_run(spark):
    df = spark.createDataFrame([("u", "a@b.c", "yesterday"), ("v", "", None), ("w", None, "2026-01-02 03:04:05")], "user_id string, email string, created_at string")
    assert rows(stage(df, "users"), "user_id", "email") == [("v", None), ("w", None)]
    assert rows(rejects(df, "users"), "reasons") == [("created_at: not a timestamp",)]


@pytest.mark.parametrize("source", [s for s in DELIVERED if ":" not in STAGED[s]])
def test_rows_of_files_without_typed_columns_are_counted(spark, tmp_path, source):
    """Nothing but the fit of a line decides on these records, and a count asks for no column."""
    columns = DELIVERED[source].split()
    lines = [columns, [f"{c}1" for c in columns], ["only_id"], [f"{c}2" for c in columns] + ["too", "many"], ["", *columns[1:]]]
    (tmp_path / "f.csv").write_text("".join(",".join(x) + "\n" for x in lines))
    df = read_csv_source(spark, str(tmp_path / "f.csv"), source)
    assert (stage(df, source).count(), rejects(df, source).count()) == (2, 2)
    assert rows(staging_balance(df, source)) == [(source, 4, 2, 2)]
    assert rows(stage(df, source)) == sorted([tuple(f"{c}1" for c in columns), (None, *columns[1:])],
                                             key=lambda t: [(v is not None, str(v)) for v in t])
    assert [r[0] for r in rows(rejects(df, source), "record")] == sorted(",".join(x) for x in (lines[2], lines[3]))
