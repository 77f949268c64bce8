"""The corpus pipeline: documents through five operators, each stage stored and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pluvio.llm.latent import drop_leaks
from pluvio.llm.packing import pack_documents
from pluvio.llm.perplexity import keep_good
from pluvio.llm.scratch import discard, materialise
from pluvio.llm.simhash import drop_near_duplicates
from pluvio.llm.substring import cut_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the perplexity bands reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays (3-word shingles, 3 bits)."""
    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under 13-word windows that a smaller doc_id holds too are cut from the texts."""
    return cut_repeats(docs, length=13)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or a paraphrase of one go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 2048 tokens."""
    return pack_documents(docs, capacity=2048, added_tokens=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Perplexity, SimHash and tokenisation are not expressible in SQL; the operators are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread as the next one's input, and goes when that is stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
