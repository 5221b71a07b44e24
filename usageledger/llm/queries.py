"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.llm import bpe, fim, html, lines, neardup, ngram, packing, periodic, repeats, rules, tokencount, topk, warc
from usageledger.llm.common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(f):
    REGISTRY[f.__name__] = f
    return f


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = [F.col(f"s.{n}").alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select(F.col("row.doc_id").alias("doc_id"), *counts, F.col("failed").alias("base_failed"), "kept", "rule")


@query
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op3_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op4_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = ngram.judged(docs, table(spark, sf_dir, "labels"), carry=["doc_id", "lang"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), F.col("row.lang").alias("lang"), "perplexity", "threshold", "kept")


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(table(spark, sf_dir, "documents").select("doc_id", "text"), prepare=periodic.planted)
    lines_of = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines_of), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))
