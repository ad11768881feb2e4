"""Every registered operator over empty tables, and over rows that are null, repeated and beside columns of other names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from accountlens.llm.queries import QUERIES

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn int, role string, text string",
}
#: Names that operators use within.
CLASHING = ("k1", "k2", "body", "score", "fp", "root", "key", "row", "a", "b", "place", "rank", "weight", "kept", "bucket", "n_words", "weights")


def write(spark, folder, rows, clashing=()):
    for name, schema in SCHEMAS.items():
        df = spark.createDataFrame(rows.get(name, []), schema).withColumns({c: F.lit(1) for c in clashing})
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("tables") / "empty", {})


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    text = "Some words that stand in a text of this length, and a line of more than forty characters.\nanother line"
    rows = {
        "documents": [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (3, "", "de", "s", 0),
                      (None, text, "en", "s", 1), (4, "x" * 30_000, "en", "s", 1)],
        "labels": [(1, 1, 0), (1, 1, 0), (None, 0, None), (3, None, None)],
        "benchmark": [(1, text), (None, None), (2, "")],
        "pages": [(1, None, None), (None, "u", ""), (2, "u", "<p>one</p>"), (2, "u", "<p>one</p>")],
        "conversations": [(1, 0, "user", None), (1, 1, "assistant", ""), (None, None, None, None), (2, 0, "user", "hi"), (2, 1, "assistant", "yes")],
    }
    return write(spark, tmp_path_factory.mktemp("tables") / "odd", rows, CLASHING)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", QUERIES)
def test_odd_rows(spark, odd, name):
    found = QUERIES[name](spark, odd).collect()
    number = name.split("_")[0]
    if number in ("op1", "op3", "op4", "op5", "op6", "op7", "op8", "op11", "op12", "op13"):
        assert sorted((r.doc_id for r in found), key=str) == sorted([1, 1, 2, 3, None, 4], key=str)
    if number == "op10":
        assert sorted((r.page_id for r in found), key=str) == sorted([1, None, 2, 2], key=str)
