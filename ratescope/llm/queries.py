"""Registered queries of the corpus operators, and their results as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.llm import (
    centroid_clustering, decontaminate, hard_negatives, html_extract, language_model, line_dedup, mixing, near_dedup, quality_rules,
    substring_dedup, toxicity, url_filter, warc,
)
from ratescope.llm.common import documents, read_table, scratch_path
from ratescope.llm.expected import EXPECTED  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op3_quality_rules(spark, sf_dir):
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


@query
def op7_mixing(spark, sf_dir):
    decided = mixing.copies(documents(spark, sf_dir, "doc_id", "text", "source"))
    each = decided.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("_row"))
    return each.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op10_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(documents(spark, sf_dir), digest_only=True)


@query
def op2_decontamination(spark, sf_dir):
    return decontaminate.report(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op4_warc(spark, sf_dir):
    folder = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_html_extraction(spark, sf_dir):
    found = html_extract.extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_near_dedup(spark, sf_dir):
    return near_dedup.report(documents(spark, sf_dir))


@query
def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.report(documents(spark, sf_dir))


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.report(documents(spark, sf_dir), read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op9_language_model(spark, sf_dir):
    return language_model.report(documents(spark, sf_dir))


@query
def op11_centroid_clustering(spark, sf_dir):
    placed = centroid_clustering.cluster(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return placed.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op12_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    return url_filter.judge(read_table(spark, sf_dir, "pages", "page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


@query
def op13_hard_negatives(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
