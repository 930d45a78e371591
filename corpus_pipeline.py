"""The corpus pipeline: quality rules, line dedup, near-duplicate dedup, decontamination, mixing.

Each stage takes all that the stage before kept, written as Parquet and read again. The first four return the columns of
``documents``; the last returns them with ``copy``, one row for each time the mix takes a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from ratescope.llm.common import read_table, write_stage
from ratescope.sinks.scratch import ensure_shared_folder

#: Least similarity of near copies in the pipeline, in percent; the op8 query has its own.
SIMILAR = 80

#: The stages fit models, follow links and round at random; SQL can't say that. tests/llm holds the brute-force version.
ORACLE_SQL = None


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_shared_folder(spark)
    return quality_rules.keep_good(docs)


def drop_crowded_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_shared_folder(spark)
    return _measured(line_dedup.dedup_lines(docs, counts=False))


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_shared_folder(spark)
    return near_dedup.first_of_each(docs, SIMILAR)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_shared_folder(spark)
    return _measured(decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ensure_shared_folder(spark)
    mixed = mixing.mix(docs)
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_crowded_lines),
    ("near_dedup", keep_first_of_near_copies),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_shared_folder(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
