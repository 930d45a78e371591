"""Generators and reshapes for the three price-file layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.functions import code_label, joined_labels, quoted, text_or_null

# Column-name parts of the published wide layout.
WIDE_PREFIX = "standard_charge|"
WIDE_SUFFIXES = {
    "|negotiated_dollar": "dollar_raw",
    "|negotiated_percentage": "percentage_raw",
    "|negotiated_algorithm": "algorithm_raw",
    "|methodology": "methodology_raw",
}
RATE_FIELDS = ("dollar_raw", "percentage_raw", "algorithm_raw")
WIDE_OUTPUT = ("payer_name", "plan_name", *WIDE_SUFFIXES.values())


def code_slots(slots: Sequence[int]) -> Column:
    """array<struct<code,type>> of the numbered code columns whose code is not blank."""
    return F.array_compact(F.array(*[
        F.when(_filled(i), F.struct(quoted(f"code|{i}").alias("code"), quoted(f"code|{i}|type").alias("type")))
        for i in slots
    ]))


def slot_item_codes(slots: Sequence[int]) -> Column:
    """item_codes of the numbered code columns."""
    return joined_labels(F.array(*[
        F.when(_filled(i), code_label(quoted(f"code|{i}|type"), quoted(f"code|{i}"))) for i in slots
    ]))


def _filled(slot: int) -> Column:
    return text_or_null(quoted(f"code|{slot}")).isNotNull()


def explode_codes(df: DataFrame, codes: str) -> DataFrame:
    """One row per entry of an array<struct<code,type>> column, as code and upper-cased code_type."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != codes]
    exploded = df.select(*rest, F.inline(codes).alias("code", "code_type"))
    return exploded.withColumn("code_type", F.upper("code_type"))


def explode_code_slots(df: DataFrame, slots: Sequence[int]) -> DataFrame:
    """One row per non-blank code slot, with code, code_type and item_codes, from a single scan."""
    used = {n for i in slots for n in (f"code|{i}", f"code|{i}|type")}
    rest = [quoted(c) for c in df.columns if c not in used]
    coded = df.select(*rest, slot_item_codes(slots).alias("item_codes"), code_slots(slots).alias("_codes"))
    return explode_codes(coded, "_codes")


def wide_groups(columns: Sequence[str]) -> dict[tuple[str, str], dict[str, str]]:
    """(payer, plan) -> {output field -> column name}, read from the column names alone.

    The text between prefix and suffix must hold a pipe: payer before the first, plan after it.
    """
    groups: dict[tuple[str, str], dict[str, str]] = {}
    for name in columns:
        suffix = next((s for s in WIDE_SUFFIXES if name.endswith(s)), None)
        if suffix is None or not name.startswith(WIDE_PREFIX):
            continue
        payer, pipe, plan = name[len(WIDE_PREFIX) : len(name) - len(suffix)].partition("|")
        if pipe:
            groups.setdefault((payer, plan), {})[WIDE_SUFFIXES[suffix]] = name
    return groups


def unpivot_payers(
    df: DataFrame, groups: dict[tuple[str, str], dict[str, str]] | None = None, rated_only: bool = False
) -> DataFrame:
    """One row per payer and plan column group. No group gives one all-NULL row per input row.

    ``rated_only`` leaves out groups without a dollar, percentage or algorithm text before rows are
    made, as most of the hundreds of groups of a row are blank.
    """
    groups = wide_groups(df.columns) if groups is None else groups
    used = {c for g in groups.values() for c in g.values()}
    keep = [quoted(c) for c in df.columns if c not in used]
    if not groups:
        return df.select(*keep, *[F.lit(None).cast("string").alias(c) for c in WIDE_OUTPUT])
    entries = []
    for (payer, plan), named in sorted(groups.items()):
        raw = [
            (quoted(named[f]) if f in named else F.lit(None).cast("string")).alias(f)
            for f in WIDE_SUFFIXES.values()
        ]
        entry = F.struct(F.lit(payer).alias("payer_name"), F.lit(plan).alias("plan_name"), *raw)
        if rated_only:
            rates = [text_or_null(quoted(named[f])) for f in RATE_FIELDS if f in named]
            # None or one in an array, as flattening is compiled and leaving out NULLs is not.
            entry = F.when(F.coalesce(*rates, F.lit(None)).isNotNull(), F.array(entry)).otherwise(F.array())
        entries.append(entry)
    # A column of its own first: what stands inside a generator is interpreted for each row. It is flattened there, as
    # Catalyst would filter a bare column by its size, and derive constraints from that for every subset of the columns.
    made = F.array(*(entries if rated_only else [F.array(e) for e in entries]))
    return df.select(*keep, made.alias("_entries")).select(*keep, F.inline(F.flatten("_entries")))


def pivot_headers(headers: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per source_key with one column per header name (trimmed, case-insensitive)."""
    name = F.lower(F.trim("header_name"))
    return headers.groupBy("source_key").agg(
        *[F.max(F.when(name == n, F.trim("header_value"))).alias(n) for n in names]
    )
