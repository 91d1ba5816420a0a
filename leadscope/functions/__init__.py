"""Column expressions shared by the jobs (no Python UDFs)."""

from leadscope.functions.dates import component_violation, date_argument, is_date_text, parse_date_text
from leadscope.functions.numeric import exact_total, finite_number, to_long, tolerant_double, with_entries
from leadscope.functions.text import (
    branch_contains,
    branch_edit_distance,
    branch_half_prefix,
    clean_text,
    is_empty_term,
    is_none_term,
    java_trim,
    name_match,
    non_name_of,
    non_name_search,
    normalised_match,
    normalised_name,
    normalised_term,
    study_keyword,
    study_name,
)

__all__ = [
    "branch_contains", "branch_edit_distance", "branch_half_prefix", "clean_text", "component_violation",
    "date_argument", "exact_total", "finite_number", "is_date_text", "is_empty_term", "is_none_term",
    "java_trim", "name_match", "non_name_of", "non_name_search", "normalised_match", "normalised_name",
    "normalised_term", "parse_date_text", "study_keyword", "study_name", "to_long",
    "tolerant_double", "with_entries",
]
