from ratescope.functions.columns import (
    any_fragment,
    billing_class,
    billing_class_is_assumed,
    code_family,
    code_label,
    in_code_types,
    is_placeholder,
    joined_codes,
    joined_labels,
    match_text,
    name_tokens,
    names_overlap,
    number_or_null,
    optional_column,
    parse_file_date,
    quoted,
    rate_type,
    run_id_from_path,
    safe_ratio,
    text_or_null,
    usable_dollar,
)

__all__ = [
    "any_fragment", "billing_class", "billing_class_is_assumed", "code_family", "code_label", "in_code_types", "is_placeholder",
    "joined_codes", "joined_labels", "match_text", "name_tokens", "names_overlap", "number_or_null", "optional_column",
    "parse_file_date", "quoted", "rate_type", "run_id_from_path", "safe_ratio", "text_or_null", "usable_dollar",
]
