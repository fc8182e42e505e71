"""A corpus pipeline: each stage takes all that the stage before it kept.

The stages, in order: documents without a known language go; of each group of near-duplicates one stays; substrings that repeat are cut
out; documents that hold benchmark text go; the rest is mixed to source weights, which says how many words of each are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import decontaminate as benchmarks
from sievework.llm import langid, mixing, simhash, substrings
from sievework.llm.common import release, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.trained(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cleaned(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return benchmarks.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("source_mix", source_mix),
]

#: No stage but the last could be said in SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder before the next stage reads it, and goes once that one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if last is not None:
            release(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
