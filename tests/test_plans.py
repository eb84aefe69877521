"""Physical plans: what must hold for the queries to scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemart.operators import keyed, skew
from tidemart.plans import reports

FOLDER = "/root/testdata/sf0.001"
# The streaming queries and the training-data operators have tests of their own.
BATCH = sorted(n for n in entry.queries() if not re.match(r"stream_|op\d+_|pipeline$", n))
# Names of plan nodes that run Python workers.
PYTHON = re.compile(r"\b(MapIn\w+|FlatMap\w*In\w+|\w*EvalPython\w*|AggregateIn\w+|WindowIn\w+|TransformWithState\w*|PythonMap\w*)")
USES_PYTHON = {"keyword_udtf"}


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert bool(PYTHON.search(plan)) == (name in USES_PYTHON)


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    plan = keyed.first_by_key(df, ["l_orderkey"], ["l_partkey"])._jdf.queryExecution().executedPlan().toString()
    final, shuffle, partial = (plan.index(x) for x in ("Final", "Exchange hashpartitioning", "Partial"))
    assert final < shuffle < partial


def test_report_day_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("2024-03-01 00:00:00", "N", 1, 1.0, "x")],
                          "stt string, province_name string, order_count bigint, order_amount double, other string").write.parquet(path)
    plan = plan_of(reports.gmv(spark.read.parquet(path), 20240301))
    assert "GreaterThanOrEqual(stt,2024-03-01 00:00:00)" in plan and "LessThan(stt,2024-03-02 00:00:00)" in plan
    assert "ReadSchema: struct<stt:string,order_amount:double>" in plan


def test_wide_orders_read_only_needed_columns(spark):
    plan = plan_of(entry.queries()["province_window"](spark, FOLDER))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("l_orderkey" in s for s in scans)
    assert all("o_totalprice" not in s and "c_name" not in s and "l_tax" not in s for s in scans)


def test_only_bounded_sides_get_a_broadcast_hint(spark):
    plan = skew.skewed_join(spark.range(100).withColumn("v", F.col("id")), spark.range(10), ["id"])
    hinted = plan._jdf.queryExecution().analyzed().toString()
    assert hinted.count("strategy=broadcast") == 2 and hinted.count("GlobalLimit 1000") == 2


def test_the_wide_order_table_shuffles_no_column_made_of_others(spark):
    plan = entry.queries()["order_wide"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    joins = [n for n, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line]
    made = [n for n, line in enumerate(plan.splitlines()) if "AS split_original_total_amount" in line]
    assert made and max(made) < max(joins)
