"""Intermediate tables in the cluster's shared folder.

A written table cuts lineage, survives lost executors, keeps column pruning and gives exact row counts
from its footers, so it is used wherever a result feeds several later steps.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_shared_folder(spark: SparkSession) -> None:
    """Name a temporary folder in a local session that names none; everywhere else the cluster must name it."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.conf.get("spark.master", "local").startswith("local"):
        spark.conf.set("spark.checkpoint.dir", _local_folder())


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ratescope-")


def scratch_root(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; executors and driver must all reach it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
    return shared.rstrip("/") + "/ratescope"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files behind. Spark else keeps them until the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_stage(df: DataFrame, label: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return the table read back.

    ``drop_shuffles`` is for large tables: what was shuffled to make them leaves the disk as soon as they are written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark) if drop_shuffles else contextlib.nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_portions(portions: Sequence[DataFrame], label: str) -> DataFrame:
    """Write portions of one table one after another, each without what it shuffled, and return the table read back."""
    spark = portions[0].sparkSession
    path = scratch_path(spark, label)
    for portion in portions:
        with shuffles_dropped(spark):
            portion.write.mode("append").parquet(path)
    return spark.read.schema(portions[0].schema).parquet(path)
