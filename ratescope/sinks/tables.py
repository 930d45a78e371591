"""Table writes: full rebuild, append, lineage, idempotence and row-count reconciliation."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratescope.schemas import MANIFEST

SKIPPED = "skipped"


class ReconcileError(RuntimeError):
    """A table does not hold as many rows as its source."""


def with_lineage(rows: DataFrame, source_file: Column, run_id: str) -> DataFrame:
    """Rows with the file and the run they came from, and when they were written."""
    lineage = [source_file.alias("_source_file"), F.lit(run_id).alias("_run_id"), F.current_timestamp().alias("_ingested_at")]
    return rows.select(*[rows[c] for c in rows.columns if c != "_source_file"], *lineage)


def _put_in_place(spark: SparkSession, written: str, table: str) -> None:
    """Let a written table take the name of another one, which is set aside until that is done."""
    aside = f"{table}__old"
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {written} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {aside}")


def rebuild_table(df: DataFrame, table: str, expected: int | None = None) -> int:
    """Replace a table as a whole; its columns may change. Returns the rows written.

    The rows go to a table of another name, are counted while they are written, and take the name only once their number
    is the expected one: whatever fails before, the earlier table stays as it was.
    """
    spark, written = df.sparkSession, f"{table}__new"
    counted = Observation()
    spark.sql(f"DROP TABLE IF EXISTS {written}")
    try:
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.saveAsTable(written)
        got = counted.get["n"]
        if expected is not None and got != expected:
            raise ReconcileError(f"{table} has {got} rows where its source states {expected}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {written}")
        raise
    _put_in_place(spark, written, table)
    return got


def is_loaded(spark: SparkSession, table: str, run_id: str) -> bool:
    """Whether the table holds rows of this run. Looks at the table only, so it can be asked before a source is touched."""
    return spark.catalog.tableExists(table) and not spark.table(table).where(F.col("_run_id") == run_id).isEmpty()


def load_table(rows: DataFrame, table: str, run_id: str, *, expected: int) -> int:
    """Build ``table`` from ``rows`` and hold its row count against the source's, which must be counted independently."""
    return rebuild_table(with_lineage(rows, rows["_source_file"], run_id), table, expected)


def ensure_manifest(spark: SparkSession, table: str) -> None:
    """Create the load log, or give an older one the columns it lacks, at its end."""
    if spark.catalog.tableExists(table):
        held = spark.table(table).schema.names
        for field in MANIFEST:
            if field.name not in held:
                spark.sql(f"ALTER TABLE {table} ADD COLUMN {field.name} {field.dataType.simpleString()}")
    else:
        spark.createDataFrame([], MANIFEST).write.saveAsTable(table)


def append_events(events: DataFrame, table: str) -> None:
    """Append load events by name; columns not given become NULL."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in MANIFEST.fields if f.name not in events.columns}
    unknown = [c for c in events.columns if c not in MANIFEST.names]
    if unknown:
        raise AnalysisException(f"Not load-log columns: {unknown}")
    events.withColumns(missing).select(*MANIFEST.names).write.mode("append").saveAsTable(table)
