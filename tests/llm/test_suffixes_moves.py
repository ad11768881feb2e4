"""Each row's text is moved once, and op4 returns what is left as a text."""

from __future__ import annotations

import hashlib
import os
import re

import pytest

from accountlens.llm import suffixes
from accountlens.llm.common import written
from tests_llm_plain import documents  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"
SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_texts_of_the_pipelines_rule_are_shuffled_once(spark, documents):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        df = suffixes.remove_repeats(written(documents(["a b c " * 200, "d e f " * 200, "a b c " * 200]), "moves"))
        plan = spark.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
            df._jdf.queryExecution(), "formatted")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]", plan, re.M)
    # The strings of open segments, which know their rule, are cut from the texts.
    assert sum(bool(re.search(r"\b(body|_*kept|text)#", x)) and "rule#" not in x for x in moved) == 1
    assert "ReusedExchange" in plan


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are not here")
def test_op4_returns_what_is_left(spark):
    rows, whole = suffixes.query(spark, SF_DIR).collect(), 0
    for r in rows:
        left = r.text.encode()
        assert len(left) <= r.n_bytes - r.n_removed
        if len(left) == r.n_bytes - r.n_removed:
            whole += 1
            assert hashlib.sha256(left).hexdigest() == r.kept_sha256
    assert len(rows) > 50 and whole > 0.9 * len(rows)
