from statline.functions.dates import age_at, is_ambiguous_date, is_checked_date, normalize_date
from statline.functions.numbers import exact_mean, per_unit, ratio, round2, whole_number
from statline.functions.text import composite_key, json_rows, normalize_label, normalize_position

__all__ = [
    "age_at", "composite_key", "exact_mean", "is_ambiguous_date", "is_checked_date", "json_rows", "normalize_date",
    "normalize_label", "normalize_position", "per_unit", "ratio", "round2", "whole_number",
]
