"""From raw documents to token ids, in five stages. Each stage's result is written and read back before the next.

Defined cases: null and empty texts fail the quality rules; the other stages take them as their operators say. An
empty table passes through all stages. Columns of ``documents`` beyond the usual five pass through all but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accountlens.llm import pieces, quality_rules, simhash, suffixes, tiling
from accountlens.llm.common import read_table, ship, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go."""
    return quality_rules.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, similarity of 0.8 or more by five-word shingles, stays."""
    ship(spark)
    return simhash.keep_one(docs)


def exact_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more, or of 400 bytes with fewer words, that stand in several places are cut out everywhere."""
    ship(spark)
    return suffixes.remove_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return tiling.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, the end of each in bytes of the text, and the text as decoded from the ids."""
    ship(spark)
    found = pieces.encode_documents(docs, pieces.default_model(), ["doc_id", "lang", "source", "n_chars"])
    return found.withColumnRenamed("decoded", "text")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", exact_substrings),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

#: Fingerprints, repeated substrings, trees and byte pair merges have no SQL form; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
