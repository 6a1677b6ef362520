"""Column-level functions: cleaning rules, calendar parts, KPI formatting."""

from kpi_lake.functions.calendar import (
    add_calendar,
    calendar_columns,
    date_text,
    parse_and_add_calendar,
    parse_date,
)
from kpi_lake.functions.clean import (
    Rule,
    anonymize,
    clamp_open_range,
    decimal_gate,
    fill_null,
    floor_below,
    label,
    map_lookup,
    normalize,
    project,
    recode,
    rename,
    repair,
    require_not_null,
    to_int_trunc,
)
from kpi_lake.functions.formatting import format_kpi

__all__ = [
    "Rule",
    "add_calendar",
    "anonymize",
    "calendar_columns",
    "clamp_open_range",
    "date_text",
    "decimal_gate",
    "fill_null",
    "floor_below",
    "format_kpi",
    "label",
    "map_lookup",
    "normalize",
    "parse_and_add_calendar",
    "parse_date",
    "project",
    "recode",
    "rename",
    "repair",
    "require_not_null",
    "to_int_trunc",
]
