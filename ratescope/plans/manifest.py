"""Queries over the load log, for all dataset keys at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.config import REFRESH_AFTER_DAYS
from ratescope.operators.latest import latest_per_key
from ratescope.schemas import PRICE_FILE_SOURCE

DOWNLOAD_COLUMNS = ("landing_path", "file_bytes", "sha256", "etag", "last_modified", "event_ts")

# The reasons of a refresh decision, as the load log states them.
FORCED = "force_download is on"
FIRST = "no earlier successful download"
DISK = "earlier file is missing or its size changed on disk"
AGE = "earlier download is over {days} days old; refreshing"
NO_HEADERS = "could not read headers from the server"
ETAG_SAME = "ETag unchanged"
ETAG_NEW = "ETag changed"
MODIFIED_SAME = "Last-Modified unchanged"
MODIFIED_NEW = "Last-Modified changed"
NOT_SINCE = "not modified since the last download"
SINCE = "modified after the last download, or the size differs"
NO_SIGNAL = "server gave no reliable change signal"


def last_downloads(manifest: DataFrame) -> DataFrame:
    """Newest successful download per price file. A skipped run is not a download."""
    done = manifest.filter((F.col("source") == PRICE_FILE_SOURCE) & (F.col("status") == "succeeded"))
    return latest_per_key(done.select("dataset_key", *DOWNLOAD_COLUMNS), ["dataset_key"], ["event_ts"])


def landed_pages(manifest: DataFrame) -> DataFrame:
    return manifest.filter((F.col("status") == "succeeded") & F.col("page_number").isNotNull())


def latest_run_pages(manifest: DataFrame) -> DataFrame:
    """Page events of the newest run with pages, per dataset key."""
    pages = landed_pages(manifest)
    newest = pages.groupBy("dataset_key").agg(F.max(F.struct("event_ts", "run_id")).alias("_newest"))
    newest = newest.select("dataset_key", F.col("_newest.run_id").alias("run_id"))
    return pages.join(newest, ["dataset_key", "run_id"], "left_semi")


def expected_rows(pages: DataFrame) -> DataFrame:
    """Pages and logged rows per dataset and run."""
    return pages.groupBy("dataset_key", "run_id").agg(
        F.count("*").alias("n_pages"), F.sum(F.coalesce("row_count", F.lit(0))).alias("expected_rows")
    )


def run_summary(manifest: DataFrame, run_id: str | None = None) -> DataFrame:
    """Events, rows and bytes per dataset and status, for one run or for each run."""
    kept = manifest if run_id is None else manifest.filter(F.col("run_id") == run_id)
    keys = ["dataset_key", "source", "status"] if run_id is not None else ["run_id", "dataset_key", "source", "status"]
    return kept.groupBy(*keys).agg(
        F.count("*").alias("events"),
        F.sum(F.coalesce("row_count", F.lit(0))).alias("total_rows"),
        F.sum(F.coalesce("file_bytes", F.lit(0))).alias("total_bytes"),
    ).orderBy("dataset_key", "status", *[k for k in keys if k not in ("dataset_key", "status")])


def rows_and_pages(manifest: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows and pages per dataset among succeeded events."""
    kept = manifest.filter(F.col("status") == "succeeded")
    keys = ["dataset_key", "source", "status"]
    if run_id is None:
        keys = ["run_id", *keys]
    else:
        kept = kept.filter(F.col("run_id") == run_id)
    return kept.groupBy(*keys).agg(
        F.sum("row_count").alias("total_rows_ingested"), F.count("*").alias("total_pages")
    )


def event_history(manifest: DataFrame, dataset_key: str, n: int = 10) -> DataFrame:
    """The newest events of one key: a top-n, not a full sort."""
    columns = ["event_ts", "status", "note", "error_message", "etag", "last_modified"]
    one = manifest.filter(F.col("dataset_key") == dataset_key).select(*columns)
    return one.orderBy(F.col("event_ts").desc(), "status").limit(n)


def latest_run_events(manifest: DataFrame) -> DataFrame:
    """All events of the run that logged the newest event, in time order."""
    newest = manifest.agg(F.max(F.struct("event_ts", "run_id")).alias("_newest")).select(
        F.col("_newest.run_id").alias("run_id")
    )
    return manifest.join(newest, "run_id", "left_semi").orderBy("event_ts")


def _http_date(text: Column) -> Column:
    """Instant of an HTTP date; the weekday carries nothing and is dropped."""
    bare = F.trim(F.regexp_replace(text, "^[A-Za-z]+, *", ""))
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")),
    )


def refresh_decisions(
    downloads: DataFrame,
    observed: DataFrame,
    now: Column,
    max_age_days: int = REFRESH_AFTER_DAYS,
) -> DataFrame:
    """Whether to skip each file, and why.

    ``observed`` has one row per key: dataset_key, forced, disk_bytes (NULL when the file is gone),
    headers_read, etag, last_modified and content_length as the server states them now.
    """
    p = downloads.select(F.col("dataset_key"), *[F.col(c).alias(f"prev_{c}") for c in DOWNLOAD_COLUMNS])
    j = observed.join(p, "dataset_key", "left")
    filled = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    intact = (
        filled("prev_landing_path") & F.col("disk_bytes").isNotNull()
        & F.col("disk_bytes").eqNullSafe(F.col("prev_file_bytes"))
    )
    modified = _http_date(F.col("last_modified"))
    length = F.col("content_length")
    same_length = length.isNull() | (
        length.rlike("^[0-9]+$") & length.try_cast("bigint").eqNullSafe(F.col("prev_file_bytes"))
    )
    age = F.lit(max_age_days).cast("int")
    old = now > F.col("prev_event_ts") + F.make_dt_interval(age)
    both_etags = filled("etag") & filled("prev_etag")
    both_dates = filled("last_modified") & filled("prev_last_modified")
    dated = filled("last_modified") & F.col("prev_event_ts").isNotNull() & modified.isNotNull()

    def decided(skip: bool, reason: str) -> Column:
        return F.struct(F.lit(skip).alias("skip"), F.lit(reason).alias("reason"))

    decision = (
        F.when(F.coalesce("forced", F.lit(False)), decided(False, FORCED))
        .when(F.col("prev_event_ts").isNull(), decided(False, FIRST))
        .when(~intact, decided(False, DISK))
        .when(old, decided(False, AGE.format(days=max_age_days)))
        .when(~F.coalesce("headers_read", F.lit(False)), decided(False, NO_HEADERS))
        .when(both_etags & (F.col("etag") == F.col("prev_etag")), decided(True, ETAG_SAME))
        .when(both_etags, decided(False, ETAG_NEW))
        .when(
            both_dates & (F.col("last_modified") == F.col("prev_last_modified")),
            decided(True, MODIFIED_SAME),
        )
        .when(both_dates, decided(False, MODIFIED_NEW))
        .when(
            dated & (modified <= F.col("prev_event_ts")) & same_length,
            decided(True, NOT_SINCE),
        )
        .when(dated, decided(False, SINCE))
        .otherwise(decided(False, NO_SIGNAL))
    )
    return j.select("dataset_key", decision.alias("d")).select("dataset_key", "d.skip", "d.reason")
