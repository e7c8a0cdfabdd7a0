"""Guards on the physical plans (the scale properties README/PLANS.md claim)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.plan_summary import final_only, summarize

SERIES = ["forecast_cases", "forecast_eval_target", "predictions_w2", "eval_by_model", "next_day_join",
          "forecast_pooled"]
ALL_FAST = [k for k in E.oracle_sql()]
# the one engine query with a step in Arrow batches: thousands of small linear systems solved in numpy
ARROW = {"forecast_fourier": 1}


def _final_plan(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


@pytest.mark.parametrize("key", SERIES)
def test_series_queries_sort_once(spark, key):
    s = summarize(_final_plan(spark, key))
    assert s["sorts"] == 1, s
    assert s["sort-merge joins"] == 0, s


@pytest.mark.parametrize("key", ALL_FAST)
def test_no_cross_join_no_python(spark, key):
    s = summarize(_final_plan(spark, key))
    assert s["nested-loop/cartesian"] == 0, s
    assert s["python UDF nodes"] == 0, s
    if not key.startswith("op"):  # the corpus operators choose their style
        assert s["arrow nodes"] == ARROW.get(key, 0), s


def test_kde_scans_input_once(spark):
    plan = final_only(_final_plan(spark, "kde_events"))
    assert "events.parquet" not in plan  # read once, when the distinct values were stored


def test_hot_customer_is_split_by_aqe(spark, tmp_dir):
    """A customer holding a third of all orders: the orders ⋈ customer sort-merge join is
    split by AQE's skew handling, and every order still counts."""
    import datetime as dt

    from pyspark.sql import functions as F

    from trendlake.sources.tables import daily_counts
    n = 30000
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 997 + 2).cast("long").alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        (F.lit(dt.datetime(1995, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 50))
        .alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"))
    customers = spark.range(1, 1000).select(F.col("id").alias("c_custkey"), F.lit("c").alias("c_name"),
                                            (F.col("id") % 5).cast("int").alias("c_nationkey"),
                                            F.lit(10.0).alias("c_acctbal"), F.lit("S").alias("c_mktsegment"))
    nation = spark.range(5).select(F.col("id").cast("int").alias("n_nationkey"),
                                   F.concat(F.lit("N"), F.col("id")).alias("n_name"),
                                   F.lit(0).alias("n_regionkey"))
    for name, df in (("orders", orders.repartition(8)), ("customer", customers), ("nation", nation)):
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        d = daily_counts(spark, tmp_dir)
        qe = d._jdf.queryExecution()
        total = qe.toRdd().count()
        plan = qe.executedPlan().toString()
        assert "skew=true" in plan
        assert d.agg(F.sum("new_cases")).first()[0] == n and total > 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_statistics_join_back_is_salted_beyond_the_broadcast_threshold(spark):
    """With the statistics too large to broadcast, no join or shuffle of raw rows is on the bare group key."""
    import re
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for q in ("kde_events", "box_events", "violin_events"):
            plan = _final_plan(spark, q)
            for line in plan.splitlines():
                if "SortMergeJoin [" in line and "event_type" in line:
                    assert "_salt" in line, line
                if re.search(r"Exchange hashpartitioning\((coalesce\()?event_type", line) and "partial" not in line:
                    assert "_salt" in line or "_x" in line or "grid" in line or "n#" in line, line
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_violin_keeps_null_groups_apart(spark):
    from trendlake.operators.explore import violin
    rows = [("a", None, float(i)) for i in range(10)] + [(None, "a", float(100 + i)) for i in range(10)]
    got = violin(spark.createDataFrame(rows, "g string, h string, v double"), "v", ["g", "h"]).collect()
    assert {(r.g, r.h) for r in got} == {("a", None), (None, "a")}
    assert max(r.x for r in got if r.g) < 50 < min(r.x for r in got if r.h)


def test_reserved_output_names_are_refused(spark):
    import pytest
    from trendlake.operators.explore import box_stats, kde
    df = spark.createDataFrame([(1, 2.0)], "x int, v double").withColumnRenamed("x", "grid")
    with pytest.raises(ValueError):
        kde(df, "v", "grid")
    with pytest.raises(ValueError):
        box_stats(df.withColumnRenamed("grid", "n"), "v", ["n"])


def test_integer_auto_bins_are_no_narrower_than_one(spark):
    import numpy as np
    from trendlake.operators.explore import histogram
    got = histogram(spark.range(1000).selectExpr("id % 3 as v"), "v").orderBy("bin").collect()
    want, _ = np.histogram(np.arange(1000) % 3, bins="auto")
    assert [r["count"] for r in got] == want.tolist()
