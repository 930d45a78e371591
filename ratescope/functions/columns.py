"""Column expressions: cleaning, safe casts, classifiers and name handling. All JVM built-ins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.config import GENERIC_NAME_WORDS


def quoted(name: str) -> Column:
    """A column whose name may hold dots, pipes, slashes or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_null(c: Column) -> Column:
    """Trimmed text, with blank as NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def number_or_null(c: Column) -> Column:
    """Text to double; blank and non-numeric text become NULL."""
    return text_or_null(c).try_cast("double")


def optional_column(df: DataFrame, name: str, data_type: str = "string") -> Column:
    """The column whatever its case, or a typed NULL when the DataFrame lacks it."""
    by_lower = {c.lower(): c for c in reversed(df.columns)}
    found = by_lower.get(name.lower())
    return quoted(found) if found is not None else F.lit(None).cast(data_type)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero."""
    return a / F.nullif(b, F.lit(0.0))


def in_code_types(code_type: Column, allowed: Sequence[str] | None) -> Column:
    """Allow-list test on the upper-cased code type; None allows everything."""
    if allowed is None:
        return F.lit(True)
    return F.upper(code_type).isin([t.upper() for t in allowed])


def code_family(code_type: Column) -> Column:
    """CPT and HCPCS carry the same codes, so they compare as one family."""
    upper = F.upper(code_type)
    return F.when(upper.isin("CPT", "HCPCS"), F.lit("CPT/HCPCS")).otherwise(upper)


def rate_type(dollar: Column, percentage: Column, algorithm: Column) -> Column:
    """Which kind of rate a line holds; the first one present wins."""
    return (
        F.when(dollar.isNotNull(), F.lit("dollar"))
        .when(percentage.isNotNull(), F.lit("percentage"))
        .when(algorithm.isNotNull(), F.lit("algorithm"))
        .otherwise(F.lit("none"))
    )


def is_placeholder(dollar: Column, min_plausible: float) -> Column:
    return dollar.isNotNull() & (dollar < F.lit(float(min_plausible)))


def usable_dollar(kind: Column, placeholder: Column, dollar: Column) -> Column:
    """The dollar amount that may enter statistics."""
    return F.when((kind == "dollar") & ~placeholder, dollar)


def billing_class(in_file: Column, assumed: Column) -> Column:
    return F.coalesce(text_or_null(F.lower(in_file)), text_or_null(F.lower(assumed)))


def billing_class_is_assumed(in_file: Column, assumed: Column) -> Column:
    return text_or_null(in_file).isNull() & text_or_null(assumed).isNotNull()


def match_text(*names: Column) -> Column:
    """Lower-case words of the given names, one space between runs of letters and digits."""
    joined = F.lower(F.concat_ws(" ", *names))
    return F.trim(F.regexp_replace(joined, "[^a-z0-9]+", " "))


def code_label(kind: Column, code: Column) -> Column:
    """TYPE:code, NULL when either is NULL."""
    return F.concat(F.upper(kind), F.lit(":"), code)


def joined_labels(labels: Column) -> Column:
    """Sorted, distinct entries of an array of code labels, joined by pipes; NULLs are left out."""
    return F.concat_ws("|", F.sort_array(F.array_distinct(labels)))


def joined_codes(codes: Column) -> Column:
    """item_codes of an array<struct<code,type>>."""
    return joined_labels(F.transform(codes, lambda c: code_label(c["type"], c["code"])))


def parse_file_date(raw: Column) -> Column:
    """Date from ISO text, then M/d/yyyy, then any text Spark can cast; NULL otherwise."""
    return F.coalesce(
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd")).cast("date"),
        F.try_to_timestamp(raw, F.lit("M/d/yyyy")).cast("date"),
        raw.try_cast("timestamp").cast("date"),
    )


def name_tokens(name: Column) -> Column:
    """Distinct words of four letters or more, without generic hospital words."""
    words = F.regexp_extract_all(F.lower(name), F.lit("[a-z]{4,}"), F.lit(0))
    return F.array_except(words, F.array(*[F.lit(w) for w in GENERIC_NAME_WORDS]))


def names_overlap(a: Column, b: Column) -> Column:
    return F.arrays_overlap(name_tokens(a), name_tokens(b))


def any_fragment(name: Column, fragments: Iterable[str]) -> Column:
    """Case-insensitive match of any regex fragment."""
    return F.lower(name).rlike("|".join(f.lower() for f in fragments))


def run_id_from_path(path: Column) -> Column:
    found = F.regexp_extract(path, "run_id=([^/]+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("unknown"))
