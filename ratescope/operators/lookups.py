"""Joins to lookup tables, with a checked size and another way beyond it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ratescope.config import PipelineConfig
from ratescope.functions import in_code_types

_MAX_SUBSTRING_TESTS = 16


def small_rows(df: DataFrame, limit: int) -> list[Row] | None:
    """The rows of a lookup table if it holds at most ``limit`` of them, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """Hint a broadcast after counting at most ``limit`` + 1 rows; a larger table stays a plain join side.

    Catalyst knows the size of files but not of rows made by the driver, so without the count a
    lookup of ten rows would be sort-merge joined and the large side shuffled on a skewed key.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on ``keys`` where NULL equals NULL; plans as an equi-join."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def label_procedures(coded: DataFrame, procedure_codes: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Add procedure_label by exact code and case-insensitive type; apply type filter and scope.

    The type filter runs before the join, and in featured scope the join is inner, so unlabelled
    codes leave before any reshape.
    """
    labels = procedure_codes.select(
        F.col("code").alias("_label_code"), F.upper("code_type").alias("_label_type"), "procedure_label"
    )
    if cfg.procedure_scope == "featured":
        labels, how = labels.filter(F.col("procedure_label").isNotNull()), "inner"
    else:
        how = "left"
    labels = broadcast_if_small(labels, cfg.max_broadcast_rows)
    kept = coded.filter(in_code_types(F.col("code_type"), cfg.silver_code_types))
    on = (kept["code"] == labels["_label_code"]) & (F.upper(kept["code_type"]) == labels["_label_type"])
    return kept.join(labels, on, how).drop("_label_code", "_label_type")


def _inner_runs(pieces: Column, width: int) -> Column:
    """Runs of ``width`` pieces of a text cut at its quotes, put together again; the ends stand in no quotes."""
    n = F.greatest(F.size(pieces) - 1 - width, F.lit(0))
    return F.transform(F.slice(F.sequence(F.lit(2), n + 2), 1, n), lambda at: F.array_join(F.slice(pieces, at, width), '"'))


def mentioning_codes(items: DataFrame, text: str, procedure_codes: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Keep items whose text holds any procedure code in double quotes, before the text is parsed.

    A few codes become substring tests. For more codes the text is cut at its quotes once, and its inner
    pieces are compared with the list. For lists too long to inline the pieces of each distinct text are
    joined with the codes, and the texts that hold one with the items, both by equality.
    """
    codes = procedure_codes.select("code").filter(F.col("code").isNotNull()).distinct()
    rows = small_rows(codes, cfg.max_inline_rows)
    if rows is None:
        # A code with a quote in it is not one piece, so it is looked for as the run of pieces it is cut into.
        codes = codes.withColumn("_width", F.size(F.split("code", '"', -1)))
        widths = [r[0] for r in codes.select("_width").distinct().collect()]
        cut = items.select(F.md5(items[text]).alias("_text"), F.split(items[text], '"', -1).alias("_p"))
        runs = F.array_distinct(F.concat(*[_inner_runs(F.col("_p"), w) for w in sorted(widths)]))
        held = cut.select("_text", F.explode(runs).alias("_code"))
        found = held.join(codes, held["_code"] == codes["code"], "left_semi").select("_text").distinct()
        return items.join(found, F.md5(items[text]) == found["_text"], "left_semi")
    if not rows:
        return items.filter(F.lit(False))
    wanted = sorted(r["code"] for r in rows)
    if len(wanted) > _MAX_SUBSTRING_TESTS and not any('"' in w for w in wanted):
        pieces = F.split(text, '"', -1)
        inner = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0)))
        return items.filter(F.arrays_overlap(inner, F.array(*[F.lit(w) for w in wanted])))
    tests = [F.instr(items[text], f'"{w}"') > 0 for w in wanted]
    return items.filter(reduce(lambda a, b: a | b, tests))


def with_any_code(df: DataFrame, codes: str, procedure_codes: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Keep rows whose code array holds a labelled code: a cheap pre-filter before a wide reshape.

    A list too long to inline is left to the label join, which removes the same rows later.
    """
    labelled = procedure_codes.filter(F.col("procedure_label").isNotNull()).select("code").distinct()
    rows = small_rows(labelled, cfg.max_inline_rows)
    if rows is None:
        return df
    wanted = [r["code"] for r in rows if r["code"] is not None]
    return df.filter(F.exists(codes, lambda c: c["code"].isin(wanted)))
