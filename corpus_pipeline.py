"""The corpus pipeline: five stages over ``documents``, each written and read again.

``run(spark, sf_dir)`` applies STAGES in order.  Every stage takes the rows its
predecessor kept, all but the last return the columns of ``documents``; the last
adds each row's weight in the mixture and its copy's sampling probability.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketflow.llm import decontaminate, langid, mixing, secrets, simhash
from ticketflow.llm.common import read, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter or a clear language go."""
    return langid.stage(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return simhash.deduplicate(docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials are replaced in the texts; every document stays."""
    return secrets.redact(docs, each_text_once=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn, scarce ones more than once, at the rates that meet the mixture's marginals."""
    return mixing.sample(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: None: fingerprints, the network and the raking cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
