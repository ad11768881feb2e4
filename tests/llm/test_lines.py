"""Line dedup against a plain version, with ranges small enough that hot lines end in several of them."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from accountlens.llm import lines
from tests_llm_plain import documents  # noqa: F401

BLANK = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANK))
            if len(key) >= min_chars and i is not None:
                holders[key].add(i)
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        gone = []
        for line in parts:
            key = lower(line.strip(BLANK))
            held = holders.get(key, ())
            gone.append(len(key) >= min_chars and len(held) >= min_docs and max(held) != i)
        kept = "\n".join(p for p, g in zip(parts, gone, strict=True) if not g)
        out.append((i, len(parts), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def narrow(spark):
    """Many small ranges and small Arrow batches."""
    keys = {"spark.sql.shuffle.partitions": "7", "spark.sql.execution.arrow.maxRecordsPerBatch": "5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def table(n, seed):
    rng = random.Random(seed)
    some = ["hot line", " HOT line\t", "é" * 4, "É" * 4, "abc", "", "  ", "warm one", "cold", "x" * 50, "line\r", "Line"]
    weights = [30, 10, 2, 2, 5, 3, 2, 6, 1, 2, 3, 3]
    return [(i, "\n".join(rng.choices(some, weights, k=rng.randrange(9)))) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain(spark, documents, narrow, seed):  # noqa: F811
    rows = [*table(60, seed), (100, None), (101, ""), (None, "hot line\nwarm one"), (None, "hot line"), (7, "hot line\nabc"), (7, "hot line\nabc")]
    docs = documents([t for _, t in rows], [i for i, _ in rows])
    found = lines.line_report(docs, 4, 5).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows, 4, 5)


def test_one_line_everywhere_is_dealt_over_tasks(spark, documents, narrow):  # noqa: F811
    rows = [(i, "the same line of some length in every document\nown %d" % i) for i in range(300)]
    docs = documents([t for _, t in rows])
    spread = lines._line_rows(docs, 40)
    order = ["h1", "h2", F.desc_nulls_last("doc_id"), "k1", "k2", "place"]
    sizes = [r["count"] for r in spread.repartitionByRange(*order).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 150
    found = {r.doc_id: r.n_dropped for r in lines.line_report(docs).collect()}
    assert found == {i: int(i != 299) for i in range(300)}


def test_few_documents_keep_a_line(spark, documents):  # noqa: F811
    line = "a line of more than forty characters, held by too few documents"
    docs = documents([line] * 4 + ["other"])
    assert {r.n_dropped for r in lines.line_report(docs).collect()} == {0}
    docs = documents([line] * 5)
    assert sorted(r.n_dropped for r in lines.line_report(docs).collect()) == [0, 1, 1, 1, 1]


def test_texts_and_clashing_columns(spark, documents):  # noqa: F811
    line = "a line of more than forty characters, held by enough documents"
    docs = documents([f"{i}\n{line}\nend" for i in range(6)] + [None, ""])
    docs = docs.withColumns({c: F.lit(1) for c in ("h1", "k1", "place", "kind", "keep", "lines", "n_lines")})
    out = lines.remove_lines(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == {**{i: f"{i}\nend" for i in range(5)}, 5: f"5\n{line}\nend", 6: None, 7: ""}


def test_empty_table(spark, documents):  # noqa: F811
    docs = documents(["x"]).filter("doc_id < 0")
    assert lines.line_report(docs).collect() == []
    assert lines.remove_lines(docs).columns == docs.columns


def test_bitmaps():
    for places in ([0], [7], [8], [3, 9, 30], list(range(40))):
        keep = lines.unpack(lines.pack(places), 41)
        assert [i for i in range(41) if not keep[i]] == places
