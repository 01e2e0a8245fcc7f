"""Column-level functions: cleaning, calendar, BLANK arithmetic, display."""

from strata.functions.blank import blank_add, blank_div, blank_sub, distinct_with_blank, nonblank
from strata.functions.calendar import calendar_columns, date_key
from strata.functions.clean import (
    CleanSpec,
    blank_to_null,
    cast_rejects,
    clean,
    group_values,
    trimmed,
    typed,
    value_map,
)
from strata.functions.display import format_measure, format_percent

__all__ = [
    "CleanSpec",
    "blank_add",
    "blank_div",
    "blank_sub",
    "blank_to_null",
    "calendar_columns",
    "cast_rejects",
    "clean",
    "date_key",
    "distinct_with_blank",
    "format_measure",
    "format_percent",
    "group_values",
    "nonblank",
    "trimmed",
    "typed",
    "value_map",
]
