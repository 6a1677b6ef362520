"""Property tests (Hypothesis): display formats and the text-as-number rule vs plain Python."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kpi_lake.functions import clean
from kpi_lake.functions.formatting import format_kpi
from kpi_lake.plans import pipelines as P

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_format(v: Decimal | None, pattern: str) -> str | None:
    if v is None:
        return None
    places = {"integer": 0, "currency0": 0, "currency": 6}[pattern]
    r = abs(v).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)
    if pattern == "integer":
        body = str(r.quantize(Decimal(1)))
        return "-" + body if v < 0 else body
    digits = f"{r:,.{places}f}"
    if pattern == "currency":
        digits = re.sub(r"\.?0+$", "", digits) if "." in digits else digits
    body = "$" + digits
    neg = v.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP) < 0
    return f"({body})" if neg else body


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.decimals(min_value=-10**9, max_value=10**9, places=2)), min_size=1, max_size=40))
def test_formats_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v decimal(12,2)")
    out = df.select(
        "i",
        *[format_kpi("v", p).alias(p) for p in ("integer", "currency0", "currency")],
    ).orderBy("i").collect()
    for row, v in zip(out, values):
        for p in ("integer", "currency0", "currency"):
            assert row[p] == py_format(v, p), (v, p, row[p])


NUMBER = re.compile(r"^\s*[+-]?\d+(\.\d*)?\s*$")


@SETTINGS
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.decimals(min_value=-10**6, max_value=10**6, places=3).map(str),
            st.sampled_from(["2e4", "1,000", "abc", " 24999.5 ", "+25000", "25000.", ".5", "", "-0"]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_income_floor_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, income string")
    out = clean.floor_below(df, "income", P.INCOME_FLOOR, 0).orderBy("i").collect()
    for row, v in zip(out, values):
        if v is None:
            want = "0"
        elif NUMBER.match(v) and Decimal(v.strip()) < P.INCOME_FLOOR:
            want = "0"
        else:
            want = v
        assert row["income"] == want, (v, row["income"])
