"""Data-quality checks. Every check is one row: subject, check_name, status, n_bad, detail."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.functions import names_overlap
from ratescope.plans.diagnostics import duplicate_groups
from ratescope.plans.manifest import landed_pages
from ratescope.sinks.scratch import write_stage
from ratescope.sources.ranges import dealt, extent, list_files
from ratescope.sources.streams import open_stream

PASS, WARN, FAIL = "pass", "warn", "fail"
# What is said of a payload or file that is not what was expected.
EMPTY = "empty response body"
HTML = "received an HTML page instead of a data file"
NOT_JSON = "expected JSON but payload does not start with { or ["
NOT_ZIP = "expected a zip archive but the file signature is missing"
NO_ZIP_SIGNATURE = "missing zip file signature"
NO_CSV_COLUMN = "no 'standard_charge' column in the first 64 KB"
NO_JSON_KEY = "no price transparency keys in the first 64 KB"
# Fixed value: how much of a file's start is looked at, in bytes.
HEAD_BYTES = 65_536
# How much of a file is held at a time while it is hashed, in bytes.
_HASH_BLOCK = 4 * 1024 * 1024


class QualityError(RuntimeError):
    """At least one check failed."""


# ------------------------------------------------------------------ checks that return the bad rows
def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once. NULLs are not compared."""
    return duplicate_groups(df.filter(F.col(column).isNotNull()), [column])


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the list, with their count. NULL passes."""
    return df.filter(~F.col(column).isin(list(accepted))).groupBy(column).agg(F.count("*").alias("n_rows"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row. Values are counted before the join, so no key is hot in it."""
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    keys = parent.select(F.col(parent_column).alias("_key")).distinct()
    return values.join(keys, values[column] == keys["_key"], "left_anti")


def repeated_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column combinations that occur more than once. NULLs are equal."""
    return duplicate_groups(df, columns)


def negative_rates(rates: DataFrame) -> DataFrame:
    return rates.filter(F.col("negotiated_dollar") < 0)


def _spread_is_wrong() -> Column:
    low, mid, high = F.col("min_rate"), F.col("median_rate"), F.col("max_rate")
    return (F.col("n_dollar_rates") > 0) & ((low > mid) | (mid > high) | (low > high))


def inconsistent_spread(variation: DataFrame) -> DataFrame:
    return variation.filter(_spread_is_wrong())


# ------------------------------------------------------------------------- declared checks of a table
@dataclass(frozen=True)
class Check:
    """What a table is held against. ``bad`` tells bad rows, or with ``keys`` bad groups of equal keys of ``_n`` rows.

    With ``parent`` (values, column) a group is bad too if the column's value is not among the parent's.
    """

    name: str
    bad: Column | None
    keys: tuple[str, ...] = ()
    parent: tuple[DataFrame, str] | None = None
    severity: str = FAIL


def not_null(*columns: str) -> list[Check]:
    return [Check(f"not_null {c}", F.col(c).isNull()) for c in columns]


def unique(*columns: str) -> list[Check]:
    """No value occurs twice. NULLs are not compared."""
    return [Check(f"unique {c}", F.col(c).isNotNull() & (F.col("_n") > 1), (c,)) for c in columns]


def accepted(column: str, values: Sequence) -> Check:
    """Counts the values outside the list. NULL passes."""
    return Check(f"accepted_values {column}", ~F.col(column).isin(list(values)), (column,))


def unique_together(columns: Sequence[str], severity: str = FAIL) -> Check:
    """No combination occurs twice. NULLs are equal."""
    return Check("unique_combination", F.col("_n") > 1, tuple(columns), severity=severity)


def related(column: str, parent: DataFrame, parent_column: str, severity: str = FAIL) -> Check:
    """Counts the values without a parent row. NULL passes."""
    return Check(f"relationships {column}", None, (column,), (parent, parent_column), severity)


def no_negative(column: str, name: str) -> Check:
    return Check(name, F.col(column) < 0)


def ordered_spread() -> Check:
    return Check("min_not_above_max", _spread_is_wrong())


def _verdicts(counted: DataFrame, subject: str, checks: Sequence[Check], places: Sequence[int]) -> DataFrame:
    """Result rows from one row whose column ``_<place>`` counts what is bad."""
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"_{i}").cast("bigint").alias("n_bad"))
        for c, i in zip(checks, places)
    ])
    flat = counted.select(F.inline(rows))
    return flat.select(
        F.lit(subject).alias("subject"), "check_name",
        F.when(F.col("n_bad") == 0, F.lit(PASS)).otherwise(F.col("severity")).alias("status"),
        "n_bad", F.concat(F.col("n_bad").cast("string"), F.lit(" bad row(s)")).alias("detail"),
    )


def table_checks(df: DataFrame, subject: str, *checks: Check | Sequence[Check]) -> DataFrame:
    """Result rows of all checks of a table, which is scanned twice at most.

    Checks of rows become one aggregate. Checks of keys share one grouping by all their key sets; equal keys are combined
    before the shuffle, so no key is hot. Where keys are looked up in a parent, the grouped keys are written and joined.
    """
    every = [c for given in checks for c in ([given] if isinstance(given, Check) else given)]
    by_row = [(i, c) for i, c in enumerate(every) if not c.keys]
    by_key = [(i, c) for i, c in enumerate(every) if c.keys]
    found = []
    if by_row:
        counted = df.agg(*[F.count_if(c.bad).alias(f"_{i}") for i, c in by_row])
        found.append(_verdicts(counted, subject, [c for _, c in by_row], [i for i, _ in by_row]))
    if by_key:
        columns = list(dict.fromkeys(k for _, c in by_key for k in c.keys))
        sets = list(dict.fromkeys(frozenset(c.keys) for _, c in by_key))
        # A bit of the grouping id is set for each column that a key set lacks, the first column's being the highest.
        ids = {s: sum(1 << (len(columns) - 1 - at) for at, c in enumerate(columns) if c not in s) for s in sets}
        of_set = lambda check: F.col("_set") == ids[frozenset(check.keys)]
        grouped = df.groupingSets([[F.col(c) for c in columns if c in s] for s in sets], *[F.col(c) for c in columns]).agg(
            F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")
        )
        if any(c.parent for _, c in by_key):
            grouped = write_stage(grouped, "checked-keys")
        own = [(i, c) for i, c in by_key if not c.parent]
        if own:
            counted = grouped.agg(*[F.count_if(of_set(c) & c.bad).alias(f"_{i}") for i, c in own])
            found.append(_verdicts(counted, subject, [c for _, c in own], [i for i, _ in own]))
        for i, c in by_key:
            if c.parent:
                (column,) = c.keys
                values = grouped.where(of_set(c) & F.col(column).isNotNull())
                bad = orphans(values, column, *c.parent)
                found.append(_verdicts(bad.agg(F.count(F.lit(1)).alias(f"_{i}")), subject, [c], [i]))
    return report(found)


def report(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def raise_on_failure(results: DataFrame) -> None:
    """Raise with the failed checks; results hold one row per check."""
    failed = results.filter(F.col("status") == FAIL).select("subject", "check_name", "detail").collect()
    if failed:
        raise QualityError("; ".join(f"{r['subject']}: {r['check_name']} ({r['detail']})" for r in failed))


def model_checks(
    rates: DataFrame, variation: DataFrame, hospitals: DataFrame, crosswalk: DataFrame, headers: DataFrame,
    cms: DataFrame, outcomes: DataFrame, across: DataFrame, vs_readmission: DataFrame,
    procedure_codes: DataFrame, general: DataFrame | None = None, json_items: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Every declared check of the bronze, silver and gold tables."""
    grain = [
        "source_key", "code_type", "code", "item_codes", "modifiers", "setting", "billing_class", "payer_name",
        "plan_name", "item_description", "rate_type", "methodology",
    ]
    tables = [
        (rates, "silver_negotiated_rates", [
            not_null("hospital_ccn", "code", "file_last_updated_on"), related("hospital_ccn", crosswalk, "hospital_ccn"),
            accepted("rate_type", ["dollar", "percentage", "algorithm", "none"]), unique_together(grain, WARN),
            no_negative("negotiated_dollar", "no_negative_dollar_rates"),
        ]),
        (headers, "stg_price_file_headers", [not_null("source_key", "last_updated_on"), unique("source_key")]),
        (cms, "stg_cms_hospitals", [not_null("hospital_ccn")]),
        (outcomes, "stg_cms_outcomes", [not_null("hospital_ccn"), unique("hospital_ccn")]),
        (crosswalk, "hospital_crosswalk", [
            not_null("source_key", "hospital_ccn"), unique("source_key", "hospital_ccn"), related("hospital_ccn", cms, "hospital_ccn", WARN),
        ]),
        (procedure_codes, "procedure_codes", [not_null("code")]),
        (hospitals, "dim_hospital", [
            not_null("hospital_ccn", "source_key"), unique("hospital_ccn", "source_key"), accepted("in_cms_general_info", [True, False]),
        ]),
        (variation, "gold_price_variation", [
            not_null("hospital_ccn", "n_dollar_rates"), related("hospital_ccn", hospitals, "hospital_ccn"), ordered_spread(),
        ]),
        (across, "gold_price_variation_across_hospitals", [not_null("n_hospitals")]),
        (vs_readmission, "gold_price_vs_readmission", [not_null("hospital_ccn"), related("hospital_ccn", hospitals, "hospital_ccn")]),
    ]
    if general is not None:
        tables.append((general, "hospital_general_information", [not_null("facility_id"), unique("facility_id")]))
    tables += [(items, key, [not_null("raw_json")]) for key, items in (json_items or {}).items()]
    return report([table_checks(df, subject, *checks) for df, subject, checks in tables])


# ------------------------------------------------------------------------- landed pages and files
def _checks(df: DataFrame, subject: str, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Unpivot (name, status, n_bad) columns into result rows; a NULL status means the check has no basis."""
    rows = F.array(*[
        F.struct(F.lit(n).alias("check_name"), s.alias("status"), b.cast("bigint").alias("n_bad"))
        for n, s, b in checks
    ])
    flat = df.select(F.col(subject).alias("subject"), F.inline(rows)).filter(F.col("status").isNotNull())
    return flat.withColumn("detail", F.concat(F.col("n_bad").cast("string"), F.lit(" bad")))


def _status(bad: Column, severity: str = FAIL) -> Column:
    return F.when(bad > 0, F.lit(severity)).otherwise(F.lit(PASS))


def page_checks(
    manifest: DataFrame,
    run_id: str,
    listing: DataFrame,
    page_rows: DataFrame,
    requirements: DataFrame,
) -> DataFrame:
    """Reconcile one run's page events with the landed files, for all datasets at once.

    ``listing``: path of each landed file. ``page_rows``: path, n_rows, n_corrupt and columns (the field
    names) read from each page. ``requirements``: dataset_key, min_rows and required_columns.
    """
    events = manifest.filter(F.col("run_id") == run_id)
    pages = landed_pages(events).select("dataset_key", "page_number", "row_count", F.col("landing_path").alias("path"))
    files = listing.select("path", F.lit(True).alias("_present"))
    on_disk = pages.join(files, "path", "left").join(page_rows, "path", "left")
    folder = F.regexp_replace("path", "/[^/]*$", "")
    folders = pages.groupBy(folder.alias("_folder")).agg(F.min("dataset_key").alias("dataset_key"))
    stale = (
        listing.select("path", folder.alias("_folder"))
        .join(folders, "_folder")
        .join(pages.select("path"), "path", "left_anti")
        .groupBy("dataset_key")
        .agg(F.count("*").alias("n_stale"))
    )
    per_key = events.groupBy("dataset_key").agg(
        F.count_if(F.col("status") == "started").alias("n_started"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
    per_page = on_disk.groupBy("dataset_key").agg(
        F.count("*").alias("n_pages"),
        (F.max("page_number") - F.min("page_number") + 1).alias("page_span"),
        F.countDistinct("page_number").alias("n_numbers"),
        F.count_if(F.col("_present").isNull()).alias("n_missing"),
        F.coalesce(F.sum("n_corrupt"), F.lit(0)).alias("n_corrupt"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows_on_disk"),
        F.sum(F.coalesce("row_count", F.lit(0))).alias("rows_logged"),
        # The first page that has rows says which columns there are.
        F.min_by("columns", F.when(F.col("n_rows") > 0, F.col("page_number"))).alias("columns"),
    )
    j = per_key.join(per_page, "dataset_key", "left").join(stale, "dataset_key", "left").join(
        requirements, "dataset_key", "left"
    )
    has_pages = F.col("n_pages").isNotNull()
    all_there = has_pages & (F.col("n_missing") == 0)
    parsed = all_there & (F.col("n_corrupt") == 0)
    gaps = F.greatest(
        F.abs(F.col("page_span") - F.col("n_pages")), F.col("n_pages") - F.col("n_numbers")
    )
    off = F.abs(F.col("rows_on_disk") - F.col("rows_logged"))
    short = F.greatest(F.coalesce("min_rows", F.lit(0)) - F.col("rows_on_disk"), F.lit(0))
    wanted = F.transform("required_columns", lambda c: F.lower(c))
    absent = F.size(F.array_except(wanted, F.transform("columns", lambda c: F.lower(c))))
    needs_columns = parsed & (F.size("required_columns") > 0)
    return _checks(j, "dataset_key", [
        ("started_logged", _status(F.when(F.col("n_started") > 0, 0).otherwise(1)),
         F.when(F.col("n_started") > 0, 0).otherwise(1)),
        ("no_failed_events", _status(F.col("n_failed")), F.col("n_failed")),
        ("pages_landed", _status(F.when(has_pages, 0).otherwise(1)), F.when(has_pages, 0).otherwise(1)),
        ("pages_contiguous", F.when(has_pages, _status(gaps)), gaps),
        ("files_exist", F.when(has_pages, _status(F.col("n_missing"))), F.col("n_missing")),
        ("no_stale_files", F.when(has_pages, _status(F.coalesce("n_stale", F.lit(0)), WARN)),
         F.coalesce("n_stale", F.lit(0))),
        ("pages_parse", F.when(all_there, _status(F.col("n_corrupt"))), F.col("n_corrupt")),
        ("rows_reconcile", F.when(parsed, _status(off)), off),
        ("min_rows", F.when(parsed, _status(short)), short),
        ("required_columns", F.when(needs_columns, _status(absent)), absent),
    ])


def page_contents(spark, paths: Sequence[str]) -> DataFrame:
    """path, n_rows, n_corrupt and columns of JSON pages. Pages are small by design, one value each."""
    texts = spark.read.text(list(paths), wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    rows = texts.select(
        "path",
        F.when(
            F.regexp_replace("value", "^\\s+", "").startswith("["),
            F.from_json("value", "array<map<string,string>>"),
        ).alias("rows"),
    )
    return rows.select(
        "path",
        F.coalesce(F.size("rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.when(F.col("rows").isNull(), 1).otherwise(0).cast("bigint").alias("n_corrupt"),
        F.map_keys(F.try_element_at("rows", F.lit(1))).alias("columns"),
    )


def head_problem(file_format: Column, head: Column) -> Column:
    """Why the first bytes of a payload are not the expected file type, else NULL."""
    text = F.decode(head, "ISO-8859-1")
    bare = F.lower(F.regexp_replace(text, "^(ï»¿)?\\s*", ""))
    return (
        F.when(F.length(head) == 0, F.lit(EMPTY))
        .when(
            file_format.isin("csv", "json") & (bare.startswith("<!doctype") | bare.startswith("<html")),
            F.lit(HTML),
        )
        .when(
            (file_format == "json") & ~(bare.startswith("{") | bare.startswith("[")),
            F.lit(NOT_JSON),
        )
        .when((file_format == "zip") & ~text.startswith("PK"), F.lit(NOT_ZIP))
    )


def format_problem(file_format: Column, head: Column) -> Column:
    """Why the start of a landed file does not look like a price file, else NULL."""
    text = F.lower(F.decode(head, "ISO-8859-1"))
    keys = F.contains(text, F.lit("standard_charge_information")) | F.contains(text, F.lit("hospital_name"))
    return (
        F.when((file_format == "zip") & ~text.startswith("pk"), F.lit(NO_ZIP_SIGNATURE))
        .when(
            (file_format == "csv") & ~F.contains(text, F.lit("standard_charge")),
            F.lit(NO_CSV_COLUMN),
        )
        .when((file_format == "json") & ~keys, F.lit(NO_JSON_KEY))
    )


def name_in_head(file_format: Column, head: Column) -> Column:
    """hospital_name as the file states it: a JSON field, or the cell under the CSV's metadata name."""
    text = F.regexp_replace(F.decode(head, "UTF-8"), "^\ufeff", "")
    in_json = F.nullif(F.regexp_extract(text, '"hospital_name"\\s*:\\s*"([^"]+)"', 1), F.lit(""))
    lines = F.split(text, "\r\n|\n|\r", 3)
    cells = lambda line: F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    clean = lambda c: F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))
    names = F.transform(cells(F.try_element_at(lines, F.lit(1))), lambda c: F.lower(F.trim(clean(c))))
    values = F.transform(cells(F.try_element_at(lines, F.lit(2))), clean)
    at = F.array_position(names, "hospital_name")
    in_csv = F.when(at > 0, F.try_element_at(values, at.cast("int")))
    return F.when(file_format == "json", in_json).when(file_format == "csv", in_csv)


def file_checks(manifest: DataFrame, run_id: str, files: DataFrame, specs: DataFrame) -> DataFrame:
    """Reconcile one run's price-file events with the landed files.

    ``files``: path, length, head and sha256, see :func:`file_facts`.
    ``specs``: dataset_key, hospital_name, file_format and min_bytes.
    """
    events = manifest.filter(F.col("run_id") == run_id).join(specs.select("dataset_key"), "dataset_key", "left_semi")
    per_key = events.groupBy("dataset_key").agg(
        F.count_if(F.col("status") == "started").alias("n_started"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
        F.count_if(F.col("status").isin("succeeded", "skipped")).alias("n_done"),
        F.max(F.when(
            F.col("status").isin("succeeded", "skipped"),
            F.struct("event_ts", "landing_path", "file_bytes", F.col("sha256").alias("logged_sha256"), "status"),
        )).alias("done"),
    )
    on_disk = files.withColumnRenamed("path", "_path").withColumn("_present", F.lit(True))
    j = per_key.join(specs, "dataset_key").join(on_disk, F.col("done.landing_path") == F.col("_path"), "left")
    one = F.col("n_done") == 1
    there = one & F.coalesce("_present", F.lit(False))
    flag = lambda c: F.when(c, 0).otherwise(1)
    same_size = F.col("length").eqNullSafe(F.col("done.file_bytes"))
    big_enough = F.col("length") >= F.col("min_bytes")
    same_sum = F.col("sha256").eqNullSafe(F.col("done.logged_sha256"))
    readable = format_problem(F.col("file_format"), F.col("head")).isNull()
    stated = name_in_head(F.col("file_format"), F.col("head"))
    named = F.coalesce(names_overlap(F.col("hospital_name"), stated), F.lit(False))
    checks = [
        ("started_logged", F.col("n_started") > 0, FAIL, F.lit(True)),
        ("no_failed_events", F.col("n_failed") == 0, FAIL, F.lit(True)),
        ("one_succeeded_row", one, FAIL, ~one),
        ("download_or_skip", F.lit(True), FAIL, one & (F.col("done.status") == "skipped")),
        ("file_exists", there, FAIL, one),
        ("size_matches_manifest", same_size, FAIL, there),
        ("min_bytes", big_enough, FAIL, there),
        ("checksum_matches", same_sum, FAIL, there),
        ("format_looks_right", readable, WARN, there),
        ("hospital_name_in_file", named, WARN, there),
    ]
    return _checks(j, "dataset_key", [
        (name, F.when(applies, _status(flag(good), severity)), flag(good)) for name, good, severity, applies in checks
    ])


def file_facts(spark, paths: Sequence[str]) -> DataFrame:
    """path, length, first bytes and SHA-256 of files of any size, read block by block, small files several a task."""
    listed = list_files(spark, paths).select("path", "length")
    n_tasks, _ = extent(listed.select(F.lit(0).alias("number"), F.col("length").alias("size")))
    return dealt(listed, n_tasks).mapInPandas(_facts, "path string, length bigint, head binary, sha256 string")


def _facts(batches):
    for batch in batches:
        heads, sums = [], []
        for path in batch["path"]:
            with open_stream(path) as stream:
                head = stream.read(HEAD_BYTES)
                running = hashlib.sha256(head)
                while block := stream.read(_HASH_BLOCK):
                    running.update(block)
            heads.append(head)
            sums.append(running.hexdigest())
        yield batch.assign(head=heads, sha256=sums)
