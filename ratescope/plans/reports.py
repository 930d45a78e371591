"""Serving queries of the dashboard and the hospital finder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescope.config import FINDER_FRAGMENTS, FINDER_STATE
from ratescope.functions import any_fragment, optional_column

FEATURED_CODES = ("27130", "27447")
KNEE_CODE = "27447"


def commercial_prices(
    by_category: DataFrame,
    codes: Sequence[str] = FEATURED_CODES,
    minimum_plans: int = 3,
    category: str = "commercial",
    billing_class: str = "facility",
    setting: str = "outpatient",
) -> DataFrame:
    """Prices by hospital within one category, billing class and setting."""
    kept = by_category.filter(
        (F.col("payer_category") == category)
        & (F.col("billing_class") == billing_class)
        & (F.col("setting") == setting)
        & F.col("code").isin(list(codes))
        & (F.col("n_payer_plans") >= minimum_plans)
    )
    return kept.select(
        "hospital_name", "procedure_label", "median_rate", "p25_rate", "p75_rate", "min_rate", "max_rate",
        "n_payer_plans", "file_last_updated_on",
    ).orderBy("procedure_label", "median_rate")


def price_by_category(
    by_category: DataFrame, code: str = KNEE_CODE, billing_class: str = "facility", setting: str = "outpatient"
) -> DataFrame:
    """One service's price by hospital and payer category."""
    kept = by_category.filter(
        (F.col("code") == code)
        & (F.col("billing_class") == billing_class)
        & (F.col("setting") == setting)
        & F.col("median_rate").isNotNull()
    )
    return kept.select("hospital_name", "payer_category", "median_rate", "n_payer_plans").orderBy(
        "hospital_name", "payer_category"
    )


def find_hospitals(
    general: DataFrame, fragments: Sequence[str] = FINDER_FRAGMENTS, state: str = FINDER_STATE
) -> DataFrame:
    """Distinct facilities of a state whose name holds any fragment, with the columns that exist."""
    present = {c.lower() for c in general.columns}
    missing = {"facility_id", "facility_name", "state"} - present
    if missing:
        raise ValueError(f"Missing columns: {sorted(missing)}")
    wanted = ("facility_id", "facility_name", "citytown", "countyparish", "hospital_type", "hospital_ownership")
    name = optional_column(general, "facility_name")
    kept = general.filter(any_fragment(name, fragments) & (optional_column(general, "state") == state))
    columns = [optional_column(general, c).alias(c) for c in wanted if c in present]
    return kept.select(*columns).distinct().orderBy("facility_name")
