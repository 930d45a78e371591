"""Paged JSON datasets and seed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratescope import schemas
from ratescope.config import HOSPITAL_CROSSWALK, PAYER_CATEGORY_RULES, PROCEDURE_CODES
from ratescope.sinks.scratch import write_stage


def read_pages(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, base: str | None = None
) -> DataFrame:
    """Rows of JSON-array pages, every primitive as text, with the page each came from.

    ``paths`` may hold globs over partition folders; below ``base`` their names (run_date=...) become columns, by which
    whole runs are left out. Without a schema every page is parsed once, into a written table of maps; the columns are the
    names that occur in it, in order.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    source = F.col("_metadata.file_path").alias("_source_file")
    reader = spark.read if base is None else spark.read.option("basePath", base)
    if schema is not None:
        return reader.option("multiLine", True).option("primitivesAsString", True).schema(schema).json(paths).select("*", source)
    texts = reader.text(paths, wholetext=True)
    folders = [c for c in texts.columns if c != "value"]
    items = texts.select(*folders, F.explode(F.from_json("value", "array<map<string,string>>")).alias("_item"), source)
    items = write_stage(items, "pages")
    names = items.select(F.explode(F.map_keys("_item")).alias("name")).distinct().orderBy("name").collect()
    columns = [F.try_element_at("_item", F.lit(n["name"])).alias(n["name"]) for n in names if n["name"] not in folders]
    return items.select(*columns, *folders, "_source_file")


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed CSV with a header line and typed columns."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", "\"").csv(path)


def default_crosswalk(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HOSPITAL_CROSSWALK, schemas.CROSSWALK)


def default_procedure_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROCEDURE_CODES, schemas.PROCEDURE_CODES)


def default_payer_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r, None) for r in PAYER_CATEGORY_RULES], schemas.PAYER_RULES)
