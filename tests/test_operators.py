"""Generic operators: keep-first dedup, global row numbers, expectations."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimwright.operators.dedup import keep_first, latest_first
from claimwright.operators.expectations import (
    expect_all_or_drop,
    expectation_metrics,
    observe_and_drop,
)
from claimwright.operators.ranking import global_row_number

rows_strategy = st.lists(
    st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(-3, 3)), st.integers(0, 1000)),
    min_size=0, max_size=60)


@settings(max_examples=15, deadline=None)
@given(rows=rows_strategy)
def test_keep_first_unique_keys_and_newest(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v int")
    out = keep_first(df, ["k"], latest_first("ts", ("v",))).collect()
    keys = [r.k for r in out]
    assert len(keys) == len(set(keys)) == len({r[0] for r in rows})
    for r in out:
        group = [x for x in rows if x[0] == r.k]
        non_null = [x for x in group if x[1] is not None]
        if non_null:
            best_ts = max(x[1] for x in non_null)
            assert r.ts == best_ts
            assert r.v == min(x[2] for x in non_null if x[1] == best_ts)
        else:
            assert r.ts is None and r.v == min(x[2] for x in group)


def test_keep_first_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = keep_first(df, ["k"], [F.col("ts").desc()])._jdf.queryExecution().executedPlan().toString()
    # a partial WindowGroupLimit runs on the map side, below the exchange
    assert plan.count("WindowGroupLimit") >= 2


@settings(max_examples=10, deadline=None)
@given(values=st.lists(st.tuples(st.integers(0, 5), st.text(alphabet="abc", max_size=2)), max_size=80),
       parts=st.integers(1, 5))
def test_global_row_number_equals_plain_window(spark, values, parts):
    df = spark.createDataFrame([(i, v, s) for i, (v, s) in enumerate(values)], "id int, v int, s string")
    order = [F.col("v").desc_nulls_last(), F.col("s").asc_nulls_first(), F.col("id").asc()]
    got = {r.id: r.rn for r in global_row_number(df, order, "rn", num_partitions=parts).collect()}
    want = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want
    assert sorted(got.values()) == list(range(1, len(values) + 1))


RULES = {"positive": "x > 0", "named": "name IS NOT NULL"}


def test_expectations_drop_null_as_violation(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, "c"), (2, None)], "x int, name string")
    assert [r.x for r in expect_all_or_drop(df, RULES).collect()] == [1]
    m = {r.rule: r for r in expectation_metrics(df, RULES, "t").collect()}
    assert m["positive"].failed_records == 2 and m["named"].failed_records == 1
    assert m["positive"].total_records == 4 and m["positive"].passed_records == 1


def test_observed_counters_filled_by_the_write(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, "c"), (2, None)], "x int, name string")
    kept, obs = observe_and_drop(df, RULES, "obs_test")
    assert kept.count() == 1
    got = obs.get
    assert got["total_records"] == 4 and got["failed__positive"] == 2 and got["failed__named"] == 1
