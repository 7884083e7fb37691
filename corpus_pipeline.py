"""A corpus pipeline over ``documents``: quality rules, line dedup, n-gram Jaccard
join, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents`` (and any further ones that ``docs`` has), with
``n_chars`` brought up to date where the text changed.

Nulls, empty tables, repeated rows and extra columns are handled as the
operators' docstrings say; in short: rows without words are rejected by the
first stage, a row with a null id is never a copy of another, and an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from thermograph.llm._groups import written
from thermograph.llm.op3_jaccard_join import one_of_each
from thermograph.llm.op4_quality_rules import clean
from thermograph.llm.op6_line_dedup import drop_lines
from thermograph.llm.op7_bpe import bpe_digests
from thermograph.llm.op10_decontaminate import decontaminate


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failing lines."""
    return clean(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that earlier documents have; none left: gone."""
    return drop_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of near duplicates."""
    return one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no item of ``benchmark``."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and their decoding, as digests."""
    return bpe_digests(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("decontaminate", benchmark_stage),
    ("bpe", token_stage),
]

# SQL has neither the template tree nor byte-pair merges; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
