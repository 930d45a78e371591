"""What the corpus operators share: table access, word rules and slots of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.sinks.scratch import scratch_path, write_stage

__all__ = ["WORD_GAP", "documents", "few_rows", "read_table", "scratch_path", "shuffle_slots", "utf8", "words_of", "write_stage"]

#: Rows of ids or of short fixed-size records that may be broadcast, some 50 MB at most.
BROADCAST_ROWS = 1_000_000
#: What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def shuffle_slots(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: Column) -> Column:
    """Words of a text as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def few_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``limit`` rows; otherwise Spark shuffles it as it sees fit.

    Meant for written tables of narrow rows, which are cheap to count.
    """
    return F.broadcast(df) if df.count() <= limit else df


def utf8(text) -> bytes:
    """UTF-8 of a text; empty for null."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
