"""Run settings and the fixed lookup values of the hip and knee price study."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PipelineConfig:
    """Thresholds and scopes, passed to every builder that needs them."""

    min_payer_plans_for_comparison: int = 5
    min_payer_plans_per_category: int = 3
    # "featured" keeps only labelled procedures, "all" keeps every procedure.
    procedure_scope: str = "featured"
    # None keeps every code type.
    silver_code_types: tuple[str, ...] | None = ("CPT", "HCPCS", "MS-DRG")
    comparable_code_types: tuple[str, ...] | None = ("CPT", "HCPCS", "MS-DRG")
    min_plausible_rate: float = 1
    # A group with more rows than this is never handed to one aggregation buffer.
    hot_group_rows: int = 2_000_000
    # Rule and code lists up to this many rows are compiled into expressions, longer ones are joined.
    max_inline_rows: int = 1_000
    # Lookup tables are counted, and broadcast by hint only up to this many (short) rows.
    max_broadcast_rows: int = 100_000


@dataclass(frozen=True)
class PageSetSpec:
    """A dataset that lands as numbered JSON pages."""

    key: str
    min_rows: int = 100
    required_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class PriceFileSpec:
    """A price file: its key, the hospital it belongs to and its layout."""

    key: str
    hospital_name: str
    ccn: str
    file_format: str  # csv | json | zip
    layout: str  # tall | wide | json
    code_slots: tuple[int, ...] = ()
    has_billing_class: bool = False
    min_bytes: int = 10_000


# ---------------------------------------------------------------------------------------------
# The published study's datasets, hospitals, procedures and payer rules. They are
# data, must be equal for equal results, and can be replaced by seed CSVs (sources.pages.read_seed).
# ---------------------------------------------------------------------------------------------
PAGE_SETS = (
    PageSetSpec("hospital_general_information"),
    PageSetSpec("unplanned_hospital_visits"),
    PageSetSpec("complications_and_deaths"),
    PageSetSpec("hrrp_readmissions_reduction"),
)

PRICE_FILES = (
    PriceFileSpec("vumc_mrf", "Vanderbilt University Medical Center", "440039", "csv", "tall", (1, 2, 3, 4), True),
    PriceFileSpec("sthss_mrf", "Saint Thomas Hospital for Specialty Surgery", "440218", "json", "json"),
    PriceFileSpec("struth_mrf", "Ascension Saint Thomas Rutherford", "440053", "csv", "tall", (1, 2)),
    PriceFileSpec("wmc_mrf", "Williamson Medical Center", "440029", "csv", "wide", (1, 2, 3, 4), True),
)

# source_key, hospital_ccn, hospital_name, assumed_billing_class
HOSPITAL_CROSSWALK = (
    ("vumc_mrf", "440039", "Vanderbilt University Medical Center", None),
    ("sthss_mrf", "440218", "Saint Thomas Hospital for Specialty Surgery", None),
    ("struth_mrf", "440053", "Ascension Saint Thomas Rutherford", "facility"),
    ("wmc_mrf", "440029", "Williamson Medical Center", None),
)

# code_type, code, procedure_label, description
PROCEDURE_CODES = (
    ("CPT", "27130", "HIP", "Total hip arthroplasty"),
    ("CPT", "27447", "KNEE", "Total knee arthroplasty"),
    ("HCPCS", "27130", "HIP", "Total hip arthroplasty"),
    ("HCPCS", "27447", "KNEE", "Total knee arthroplasty"),
    ("MS-DRG", "469", "HIP_KNEE_DRG", "Major joint replacement or reattachment of lower extremity with MCC"),
    ("MS-DRG", "470", "HIP_KNEE_DRG", "Major joint replacement or reattachment of lower extremity without MCC"),
)

# priority, category, pattern
PAYER_CATEGORY_RULES = (
    (1, "other_government", "va ccn|va pccc|optum va|triwest|tricare|military|covid uninsured"),
    (2, "exchange", "exchange|ambetter|oscar|marketplace"),
    (2, "exchange", "network e( |$)"),
    (3, "medicare_advantage", "medicare|advantage|snp|aarp|windsor health"),
    (3, "medicare_advantage", "amerivantage"),
    (
        4,
        "medicaid",
        "tenncare|medicaid|community plan|community state|coverkids|better health|passport|community care|mcaid",
    ),
    (4, "medicaid", "bluecare|bluegrass family health"),
)

DEFAULT_PAYER_CATEGORY = "commercial"
GAP_CATEGORIES = ("commercial", "exchange", "medicare_advantage", "medicaid")

# Name fragments and state used by the hospital finder when none are given.
FINDER_FRAGMENTS = ("vanderbilt university medical", "saint thomas", "williamson medical", "specialty surgery")
FINDER_STATE = "TN"

# Words that say nothing about which hospital a name belongs to.
GENERIC_NAME_WORDS = ("hospital", "medical", "center", "health", "healthcare", "system", "regional")

REFRESH_AFTER_DAYS = 30
# --------------------------------------------------------------------------- end of fixed values
