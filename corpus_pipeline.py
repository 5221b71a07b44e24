"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and returns a frame that
is written as Parquet and read again as the next one's docs. All but the last return the columns
of documents.

Defined cases, beyond those of the operators: stages judge rows, so rows that repeat an id are judged
one by one, but near-dedup leaves one of rows with equal id and text. A NULL text is rejected by the
classifier. An empty table passes through all stages. Extra columns of documents are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.llm import lines, neardup, ngram, packing, rules
from usageledger.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _rows(judged: DataFrame, docs: DataFrame) -> DataFrame:
    return judged.where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's threshold."""
    return _rows(ngram.judged(docs, table(spark, sf_dir, "labels")), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every learned rule."""
    return _rows(rules.judged(docs, table(spark, sf_dir, "labels")), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text."""
    out = lines.without_common_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the one with the smallest id."""
    return neardup.one_of_each(docs, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack),
]

# Language model, learned rules, MinHash and packing have no SQL form; tests hold every stage
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
