"""Text fractions, groups without fan-out, sink and stream safety, bounded broadcasts, slicers."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpi_lake.functions import clean
from kpi_lake.functions.formatting import format_kpi
from kpi_lake.operators import context as C
from kpi_lake.operators import star
from kpi_lake.operators.measures import evaluate, evaluate_by
from kpi_lake.operators.model import Relationship, StarModel
from kpi_lake.plans import dashboard as D
from kpi_lake.plans.pipelines import gold_participants
from kpi_lake.plans.semantic import CATALOG, TOTAL_INTERNATIONAL_SALES
from kpi_lake.sources.layers import Lake, SchemaConflictError, copy_table, read_table, write_table
from kpi_lake.streaming import refresh_silver_incrementally
from kpi_lake.streaming.incremental import StreamStateError, stream_checkpoint

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def one(df):
    return df.collect()[0][0]


def test_text_fractions_are_truncated_not_lost(spark):
    df = spark.createDataFrame([("7.6",), ("-7.6",), (" 8 ",), ("x",), ("1e3",), (None,)], "t string")
    assert [r[0] for r in df.select(clean.to_int_trunc("t")).collect()] == [7, -7, 8, None, None, None]
    numbers = spark.createDataFrame([(7.6,), (-7.6,), (None,)], "t double")
    assert [r[0] for r in numbers.select(clean.to_int_trunc("t")).collect()] == [7, -7, None]


def test_decimal_text_sales_are_summed(spark):
    df = spark.createDataFrame([("12.50",), ("3",), ("n/a",), (None,)], "international_sale string")
    assert one(df.agg(TOTAL_INTERNATIONAL_SALES.aggregate())) == Decimal("15.5")


def test_participants_pass_through_whole(spark, scratch_dir):
    df = spark.createDataFrame([("a", "m", "note")], "activity_id string, msme_key string, remark string")
    assert gold_participants(df).columns == df.columns
    assert gold_participants(df, ["remark"]).columns == ["activity_id", "msme_key"]
    lake = Lake(root=scratch_dir)
    write_table(df, lake, "silver", "participant_updated")
    copy_table(spark, lake, "silver", "participant_updated", lake, "gold")
    assert read_table(spark, lake, "gold", "participant_updated").columns == df.columns


def test_targets_keep_fractions(spark):
    df = spark.createDataFrame([(Decimal("10.55"),)], "total_sales decimal(18,2)")
    assert one(df.select(CATALOG["sales_target"].formula(F.col("total_sales")))) == Decimal("11.0775")


@pytest.mark.parametrize(
    ("value", "pattern", "text"),
    [(1.0000000123, "currency", "$1.0000000123"), (-0.4, "integer", "0"), (-0.6, "integer", "-1"), (-0.4, "currency0", "$0"), (1500.0, "currency", "$1,500")],
)
def test_formats_keep_optional_decimals_and_show_no_negative_zero(spark, value, pattern, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert one(df.select(format_kpi("v", pattern))) == text


def _jobs_model(spark, **rel):
    jobs = spark.createDataFrame([("j1", 10), ("j2", 5), ("j3", 2)], "job_key string, jobs long")
    hiring = spark.createDataFrame([("j1", "F"), ("j1", "F"), ("j1", "M"), ("j2", "M"), (None, "F")], "job_key string, sex string")
    return StarModel({"job": jobs, "hiring": hiring}, [Relationship("job", "job_key", "hiring", "job_key", **rel)])


def test_groups_over_repeated_keys_equal_their_filtered_totals(spark):
    from kpi_lake.operators.measures import Measure

    total = Measure("jobs_total", "job", "sum", column="jobs", result_type="bigint")
    model = _jobs_model(spark, one_unique=False)
    groups = {r.sex: r.jobs_total for r in evaluate_by(model, C.EMPTY, "hiring", ["sex"], [total]).collect()}
    assert groups == {"F": 10, "M": 15, None: 2}
    for sex in ("F", "M"):
        ctx = C.EMPTY.where("hiring", C.equals("sex", sex), "sex")
        assert one(evaluate(model, ctx, [total])) == groups[sex]


def test_group_table_that_does_not_reach_the_measure_shows_totals(spark):
    from kpi_lake.operators.measures import Measure

    model = _jobs_model(spark, one_unique=False)
    people = Measure("people", "hiring", "count_rows", result_type="bigint")
    got = {r.job_key: r.people for r in evaluate_by(model, C.EMPTY, "job", ["job_key"], [people]).collect()}
    assert got == {"j1": 5, "j2": 5, "j3": 5}


def test_timestamp_calendar_is_refused(spark):
    from kpi_lake.operators.measures import Measure

    cal = spark.createDataFrame([(dt.datetime(2024, 1, 1), 2024)], "d timestamp, y int")
    fact = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1)], "d timestamp, v long")
    model = StarModel({"fact": fact, "cal": cal}, [Relationship("fact", "d", "cal", "d")], calendar_tables=["cal"])
    with pytest.raises(TypeError, match="must be a date"):
        evaluate(model, C.EMPTY.where("cal", C.equals("y", 2024), "y"), [Measure("v", "fact", "sum", column="v")])


def test_hash_key_keeps_nulls_and_borders_apart(spark):
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", ""), ("ab", "c"), ("a", "bc"), (None, None), ("-", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert star.surrogate_key(df, ["x", "y"]).select("sk").distinct().count() == len(rows)


def test_merge_refuses_type_conflicts_and_keep_refuses_dropped_columns(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    write_table(spark.createDataFrame([(1, 2)], "a int, b int"), lake, "gold", "t")
    with pytest.raises(SchemaConflictError):
        write_table(spark.createDataFrame([("x",)], "a string"), lake, "gold", "t", schema_mode="merge")
    with pytest.raises(SchemaConflictError):
        write_table(spark.createDataFrame([(1,)], "z int"), lake, "gold", "t")
    assert read_table(spark, lake, "gold", "t").columns == ["a", "b"]
    write_table(spark.createDataFrame([(3,)], "a int"), lake, "gold", "t", schema_mode="merge")
    assert [tuple(r) for r in read_table(spark, lake, "gold", "t").select("a", "b").collect()] == [(3, None)]


def test_unreadable_old_table_stops_a_write(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    os.makedirs(lake.path("gold", "t"))
    with open(os.path.join(lake.path("gold", "t"), "part-0.parquet"), "wb") as f:
        f.write(b"no parquet at all")
    with pytest.raises(Exception, match=r"(?i)parquet|footer"):
        write_table(spark.createDataFrame([(1,)], "a int"), lake, "gold", "t")
    empty = lake.path("gold", "empty")
    os.makedirs(empty)
    write_table(spark.createDataFrame([(1,)], "a int"), lake, "gold", "empty")
    assert read_table(spark, lake, "gold", "empty").count() == 1


def test_crash_between_the_renames_is_put_right(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    df = spark.createDataFrame([(1,)], "a int")
    path = write_table(df, lake, "gold", "t")
    os.rename(path, f"{path}.__replaced-0123456789ab")
    assert read_table(spark, lake, "gold", "t").count() == 1
    os.rename(path, f"{path}.__replaced-0123456789ab")
    with pytest.raises(SchemaConflictError):
        write_table(spark.createDataFrame([("x",)], "a string"), lake, "gold", "t")


SALES = "sales_key string, msme_key string, sales_reporting_date string, domestic_sale long, international_sale string"


def test_stream_refuses_a_refreshed_bronze_table(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    df = spark.createDataFrame([("s1", "m1", "1/5/2024", 10, None), ("s2", "m2", "bad", None, "3")], SALES)
    ckpt = f"{scratch_dir}/ckpt"
    write_table(df, lake, "bronze", "success_sales")
    refresh_silver_incrementally(spark, lake, "sales_updated", checkpoint=ckpt)
    write_table(df, lake, "bronze", "success_sales")
    with pytest.raises(StreamStateError):
        refresh_silver_incrementally(spark, lake, "sales_updated", checkpoint=ckpt)
    assert read_table(spark, lake, "silver", "sales_updated").count() == 2


def test_stream_refuses_a_silver_table_rewritten_by_a_batch(spark, scratch_dir):
    lake = Lake(root=scratch_dir)
    df = spark.createDataFrame([("s1", "m1", "1/5/2024", 10, None)], SALES)
    ckpt = f"{scratch_dir}/ckpt"
    write_table(df, lake, "bronze", "success_sales")
    refresh_silver_incrementally(spark, lake, "sales_updated", checkpoint=ckpt)
    write_table(read_table(spark, lake, "silver", "sales_updated"), lake, "silver", "sales_updated")
    with pytest.raises(StreamStateError):
        refresh_silver_incrementally(spark, lake, "sales_updated", checkpoint=ckpt)


def test_default_stream_checkpoint_is_the_same_in_every_process(spark):
    code = "import hashlib; print(hashlib.sha256(b'/shared/lake').hexdigest()[:20])"
    names = {subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env={**os.environ, "PYTHONHASHSEED": s}).stdout.strip() for s in "12"}
    assert len(names) == 1
    assert stream_checkpoint(spark, Lake(root="/shared/lake/"), "t").endswith(f"/streams/{names.pop()}/t")


def test_cluster_without_a_checkpoint_folder_is_an_error():
    from kpi_lake.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_performance_page_without_dates_does_not_filter():
    assert D.performance_context().same_as(C.EMPTY)
    saved = D.performance_context(D.REPORT_SALES_RANGE, D.REPORT_JOBS_UNTIL)
    assert saved.key_bounds("date_sales", "date_sales_id")[0] == dt.date(2022, 3, 30)


def test_a_refreshed_source_folder_is_read_anew(spark, scratch_dir):
    from kpi_lake.sources.standins import source_table

    spark.range(3).write.parquet(f"{scratch_dir}/nation.parquet")
    assert source_table(spark, scratch_dir, "nation").count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{scratch_dir}/nation.parquet")
    assert source_table(spark, scratch_dir, "nation").count() == 5


def test_moved_and_whole_month_sets_come_from_one_calendar_scan(spark):
    from kpi_lake.operators.measures import Measure, one_row
    from kpi_lake.operators.timeintel import month_to_date, shift_months

    days = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(120)]
    cal = spark.createDataFrame([(d, d.month) for d in days], "d date, m int")
    fact = spark.createDataFrame([(d, 1 << (i % 20)) for i, d in enumerate(days)], "d date, v long")
    model = StarModel({"fact": fact, "cal": cal}, [Relationship("fact", "d", "cal", "d")], calendar_tables=["cal"])
    total = Measure("total", "fact", "sum", column="v")
    measures = [total, month_to_date(total, "cal", "d", "mtd"), shift_months(total, "cal", "d", "prev", -1)]
    for ctx in (C.EMPTY, C.EMPTY.where("cal", C.equals("m", 3), "m"), C.EMPTY.where_range("cal", "d", "2024-02-10", "2024-03-31", "p")):
        got = evaluate(model, ctx, measures).first()
        want = one_row(*[m.rows(model, ctx).agg(m.aggregate()) for m in measures]).first()
        assert tuple(got) == tuple(want)
