"""Row-local cleaning rules as Column / DataFrame functions.

All rules are built-in expressions, so they stay inside whole-stage code generation and need no
shuffle. Casts of text use ``try_cast`` / ``try_to_date`` because the session runs with ANSI mode on:
a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def column_type(df: DataFrame, name: str) -> DataType:
    return df.schema[name].dataType


# --- filters -----------------------------------------------------------------------------------


def require_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows that have a null in any of ``cols`` (pushed to the parquet scan as IsNotNull)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


# --- recoding ----------------------------------------------------------------------------------


def recode(df: DataFrame, mapping: Mapping[str, str], cols: str | Sequence[str]) -> DataFrame:
    """Exact, case-sensitive value replacement in one or more string columns.

    Values not in the map (and nulls) are left as they are.
    """
    subset = [cols] if isinstance(cols, str) else list(cols)
    return df.replace(dict(mapping), subset=subset)


@dataclass(frozen=True)
class Rule:
    """One branch of a normalisation chain.

    kind: ``eq`` exact match, ``in`` membership, ``ieq`` case-insensitive match, ``null`` is null.
    """

    kind: str
    match: object
    to: object


def normalize(c: ColumnOrName, rules: Iterable[Rule]) -> Column:
    """First matching rule wins; unmatched values pass through unchanged."""
    col = _col(c)
    expr = None
    for rule in rules:
        if rule.kind == "eq":
            cond = col == F.lit(rule.match)
        elif rule.kind == "in":
            cond = col.isin(list(rule.match))  # type: ignore[arg-type]
        elif rule.kind == "ieq":
            cond = F.lower(col) == F.lit(str(rule.match).lower())
        elif rule.kind == "null":
            cond = col.isNull()
        else:
            raise ValueError(f"unknown rule kind {rule.kind!r}")
        expr = F.when(cond, F.lit(rule.to)) if expr is None else expr.when(cond, F.lit(rule.to))
    return col if expr is None else expr.otherwise(col)


def repair(c: ColumnOrName, fixes: Mapping[object, object]) -> Column:
    """Replace known wrong values (exact match) by their corrections."""
    return normalize(c, [Rule("eq", k, v) for k, v in fixes.items()])


def label(c: ColumnOrName, labels: Mapping[str, str], default: str) -> Column:
    """Code -> label; every other value, null included, gets ``default``."""
    col = _col(c)
    expr = None
    for code, text in labels.items():
        cond = col == F.lit(code)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def map_lookup(c: ColumnOrName, mapping: Mapping[str, int], value_type: str = "bigint") -> Column:
    """Literal map lookup; unknown keys and null give null.

    The map is a foldable literal, evaluated per row without a join.
    """
    if not mapping:
        return F.lit(None).cast(value_type)
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v).cast(value_type)]
    return F.create_map(*pairs)[_col(c)]


# --- null and range rules ------------------------------------------------------------------------


def _literal_like(value: object, dtype: DataType) -> Column:
    """A literal of the column's own type, so a default never widens or narrows the column."""
    if isinstance(dtype, StringType):
        return F.lit(str(value))
    return F.lit(value).cast(dtype)


def fill_null(df: DataFrame, defaults: Mapping[str, object], nan_as_null: bool = False) -> DataFrame:
    """Null -> default per column; the default is cast to the column's type.

    A text column keeps its text type (a numeric default becomes its string form). A null test
    does not see NaN; with ``nan_as_null`` a NaN in a float column is treated as missing too.
    """

    def value_of(name: str) -> Column:
        dtype = column_type(df, name)
        if nan_as_null and isinstance(dtype, (FloatType, DoubleType)):
            return F.nanvl(F.col(name), F.lit(None).cast(dtype))
        return F.col(name)

    return df.withColumns(
        {name: F.coalesce(value_of(name), _literal_like(value, column_type(df, name))) for name, value in defaults.items()}
    )


# Fixed value: text that reads as a number when compared with one: optional blanks and sign, digits, an
# optional fraction. Exponents, thousands separators and other text are not numbers.
NUMERIC_TEXT = r"^\s*[+-]?\d+(\.\d*)?\s*$"


def numeric_text(c: ColumnOrName, dtype: str = "decimal(38,10)") -> Column:
    """Text that reads as a plain number as an exact decimal; other text -> null."""
    col = _col(c)
    return F.when(col.rlike(NUMERIC_TEXT), F.trim(col).try_cast(dtype))


def numeric_view(df: DataFrame, name: str) -> Column:
    """The column as a number for comparisons.

    Text counts as a number only when it looks like a plain (integer or decimal) literal, as in
    the legacy text-to-number comparison the cleaning rules were written against; the value is
    then compared exactly (decimal), which agrees with truncating to an integer for integer
    thresholds. Other text compares as null, i.e. never below a threshold.
    """
    dtype = column_type(df, name)
    if isinstance(dtype, NumericType):
        return F.col(name)
    return numeric_text(name)


def floor_below(df: DataFrame, name: str, threshold: float, value: object = 0) -> DataFrame:
    """Values below ``threshold`` and nulls become ``value``; others are kept as they are.

    Text input is compared through its numeric view; non-numbers are kept unchanged (and are
    rejected later by the decimal gate).
    """
    dtype = column_type(df, name)
    lit_value = _literal_like(value, dtype)
    return df.withColumn(
        name,
        F.when(numeric_view(df, name) < F.lit(threshold), lit_value)
        .when(F.col(name).isNull(), lit_value)
        .otherwise(F.col(name)),
    )


def clamp_open_range(
    c: ColumnOrName, low: float, high: float, to: object, null_to: object | None = None
) -> Column:
    """``low < c < high`` -> ``to``; null -> ``null_to`` when given; bounds themselves are kept."""
    col = _col(c)
    expr = F.when(col.isNull(), F.lit(null_to)) if null_to is not None else None
    cond = (col < F.lit(high)) & (col > F.lit(low))
    expr = F.when(cond, F.lit(to)) if expr is None else expr.when(cond, F.lit(to))
    return expr.otherwise(col)


# --- safe casts --------------------------------------------------------------------------------


def to_int_trunc(c: ColumnOrName, dtype: str = "bigint") -> Column:
    """Truncate toward zero (7.6 -> 7, -7.6 -> -7), text numbers too; other text -> null.

    A plain cast of text to an integer type refuses a fraction, so numeric text goes through an
    exact decimal.
    """
    text = _col(c).cast("string")
    exact = F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("decimal(38,10)")).try_cast(dtype)
    # A cast that fails is caught row by row, which is slow: text is only cast if it reads as an integer.
    direct = F.when((F.typeof(_col(c)) != "string") | text.rlike(INTEGER_TEXT), _col(c).try_cast(dtype))
    return F.coalesce(direct, exact)


# What a cast to an integer takes: digits, within blanks and control characters.
INTEGER_TEXT = r"^[\x00-\x20\x7F]*[+-]?\d+[\x00-\x20\x7F]*$"


# Fixed value: plain decimal text.
DECIMAL_TEXT = r"^-?\d+(\.\d+)?$"


def decimal_gate(df: DataFrame, name: str, precision: int = 10, scale: int = 2) -> Column:
    """Plain decimal text (``-?digits[.digits]``) -> decimal(p, s); anything else -> null.

    Overflow gives null too. Numeric input skips the text gate and is cast directly, so a large
    double is never lost to its exponent notation.
    """
    target = DecimalType(precision, scale)
    col = F.col(name)
    if isinstance(column_type(df, name), NumericType):
        return col.try_cast(target)
    return F.when(col.rlike(DECIMAL_TEXT), col.try_cast(target))


# --- column sets -------------------------------------------------------------------------------


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns in one projection; names that are absent are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def project(df: DataFrame, cols: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Select ``cols`` (in order), renaming on the way."""
    renames = renames or {}
    return df.select(*[F.col(c).alias(renames.get(c, c)) for c in cols])


class ConfidentialColumnError(ValueError):
    pass


def anonymize(df: DataFrame, keep: Sequence[str], confidential: Iterable[str] = ()) -> DataFrame:
    """Keep only the allow-listed columns; refuse if a confidential column is on the list."""
    leaked = set(keep) & set(confidential)
    if leaked:
        raise ConfidentialColumnError(f"confidential columns on the keep list: {sorted(leaked)}")
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(*keep)


__all__ = [
    "Rule",
    "anonymize",
    "clamp_open_range",
    "decimal_gate",
    "fill_null",
    "floor_below",
    "label",
    "map_lookup",
    "normalize",
    "numeric_text",
    "numeric_view",
    "project",
    "recode",
    "rename",
    "repair",
    "require_not_null",
    "to_int_trunc",
]
