"""The sample that the trees learn from holds one row for an id, however often the id is repeated."""

from __future__ import annotations

from pyspark.sql import functions as F

from accountlens.llm import quality_rules
from tests_llm_plain import documents  # noqa: F401


def test_a_repeated_id_counts_once(spark, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_rules, "grow_trees", lambda x, y: seen.append((x.tolist(), y.tolist())))
    texts = [f"text number {i} has some words " * (i + 1) for i in range(10)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    docs = documents(texts)
    again = docs.unionByName(docs.filter("doc_id = 3").withColumn("text", F.explode(F.array(F.col("text"), F.lit("other words"))))
                             .crossJoin(spark.range(50)).drop("id"))
    quality_rules.learn(docs, labels)
    quality_rules.learn(again, labels)
    assert [len(y) for _, y in seen] == [10, 10]
    assert seen[0][1].count(1.0) == seen[1][1].count(1.0) == 5
