"""Display formatting of KPI values (the model's format strings and the visuals' display units)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Display units offered by the visuals and their suffixes.
DISPLAY_UNITS = {1: "", 1000: "K", 1000000: "M"}


# Optional decimals of the ``currency`` format, and the type that holds them.
MAX_DECIMALS = 15
EXACT = "decimal(38,15)"
# Twelve places before a display unit divides, so that the quotient's 15 are exact.
WITH_UNIT = "decimal(33,12)"


def _number_text(value: Column, decimals: int) -> Column:
    """Grouped digits of |value|, rounded half away from zero to ``decimals`` places."""
    rounded = F.round(F.abs(value).cast(EXACT), decimals)
    return F.format_number(rounded, decimals)


def format_kpi(value: Column | str, pattern: str = "integer", unit: int = 1) -> Column:
    """Text of a KPI value.

    pattern: ``integer`` ("0"), ``currency0`` ("$#,0;($#,0)"), ``currency2`` ("$#,0.00;($#,0.00)"),
    ``currency`` ("$#,0.###...": up to 15 decimals, only as needed), ``date`` ("m/d/yyyy").
    ``unit`` divides the value and appends K / M. Null stays null (blank).
    """
    col = F.col(value) if isinstance(value, str) else value
    if pattern == "date":
        return F.date_format(col, "M/d/yyyy")
    if unit not in DISPLAY_UNITS:
        raise ValueError(f"unit must be one of {sorted(DISPLAY_UNITS)}")
    # A value beyond the decimal's 21 (23 without a unit) digits before the point shows as it is.
    exact = col.try_cast(WITH_UNIT if unit != 1 else EXACT)
    scaled = exact if unit == 1 else (exact * F.lit(Decimal(1) / unit)).cast(EXACT)
    beyond = F.when(exact.isNull(), col.cast("string"))
    suffix = F.lit(DISPLAY_UNITS[unit])
    if pattern == "integer":
        body = F.concat(_number_text(scaled, 0), suffix)
        body = F.regexp_replace(body, ",", "")
        return F.when(exact.isNull(), beyond).when(F.round(scaled, 0) < 0, F.concat(F.lit("-"), body)).otherwise(body)
    if pattern in ("currency0", "currency2", "currency"):
        decimals = {"currency0": 0, "currency2": 2, "currency": MAX_DECIMALS}[pattern]
        digits = _number_text(scaled, decimals)
        if pattern == "currency":
            digits = F.regexp_replace(digits, r"\.?0+$", "")
        body = F.concat(F.lit("$"), digits, suffix)
        return (
            F.when(exact.isNull(), beyond)
            .when(F.round(scaled, decimals) < 0, F.concat(F.lit("("), body, F.lit(")")))
            .otherwise(body)
        )
    raise ValueError(f"unknown pattern {pattern!r}")


__all__ = ["DISPLAY_UNITS", "format_kpi"]
