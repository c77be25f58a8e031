"""Bucketed and ordered storage: results, plans, hot keys, nulls, empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright import queries as Q
from claimwright.operators.materialize import materialize
from claimwright.operators.ordered import store_ordered
from claimwright.plans import bucketed, gold

from conftest import SF_SMALL
from test_plans import static_plans


def small_claims(spark, n):
    """A third of the claims belong to one member, a sixth to no member."""
    return spark.range(n).select(
        F.concat(F.lit("c"), F.col("id")).alias("claim_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 6 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("m"), F.col("id") % 300)).alias("member_id"),
        F.concat(F.lit("p"), F.col("id") % 50).alias("provider_id"),
        (F.col("id") % 1000 + 1).cast("decimal(10,2)").alias("claim_amount"),
        F.lit("2000-01-02").cast("date").alias("claim_date"),
        F.lit("2000-01-01").cast("date").alias("service_date"), F.lit(1).alias("days_to_claim"))


def dimensions(spark, claims):
    members = spark.createDataFrame([(m, 30, True, "F", "R", "P", True) for m in ("HOT", "m1", "m2", "unknown")],
                                    "MemberID string, age long, is_active_member boolean, Gender string, Region string, "
                                    "PlanType string, has_complete_profile boolean")
    providers = spark.createDataFrame([("p1", "n", True, "s", "a", None)],
                                      "provider_id string, provider_name string, is_active boolean, specialty string, "
                                      "address string, last_verified date")
    return gold.store_dimensions(claims, members, providers)


def test_bucketed_join_exchanges_no_claim_on_the_member(spark):
    claims = materialize(Q._claims_processed(spark, SF_SMALL), "bucket-claims")
    members = materialize(Q._members_processed(spark, SF_SMALL), "bucket-members")
    providers = materialize(Q._providers_processed(spark, SF_SMALL), "bucket-providers")
    dims = gold.store_dimensions(claims, members, providers)
    buckets = bucketed.store_bucketed(claims, dims, buckets=8)
    with static_plans(spark):
        enriched = buckets.enriched()
        plan = enriched._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2
        assert plan.count("Exchange hashpartitioning(member_id") == 0
        assert plan.count("Exchange hashpartitioning(provider_id") == 2  # the other join, as before
        assert enriched.columns == gold.claims_enriched(claims, dims).columns
        expected = gold.claims_enriched(claims, dims)
        assert enriched.exceptAll(expected).count() == 0 and expected.exceptAll(enriched).count() == 0
    buckets.drop()


@pytest.mark.parametrize("n", [6000, 5, 0])
def test_hot_and_null_members_are_spread_over_buckets(spark, n):
    claims = materialize(small_claims(spark, n), "bucket-hot")
    dims = dimensions(spark, claims)
    buckets = bucketed.store_bucketed(claims, dims, buckets=12)
    enriched, expected = buckets.enriched(), gold.claims_enriched(claims, dims)
    assert enriched.count() == n
    assert enriched.exceptAll(expected).count() == 0 and expected.exceptAll(enriched).count() == 0
    if n == 6000:
        salts = {r[0]: r[1] for r in buckets.claims.groupBy("member_id").agg(F.count_distinct("__salt")).collect()}
        assert salts["HOT"] == 4 and salts[None] == 2
        assert all(s == 1 for m, s in salts.items() if m not in ("HOT", None))
        largest = buckets.claims.groupBy("member_id", "__salt").count().agg(F.max("count")).first()[0]
        assert largest < 1.25 * n / 12
        extra = buckets.dims.member.count() - dims.member.count()
        assert 0 < extra < 2 * 12
    buckets.drop()


ROWS = [(None, "b", 1), (None, None, 2), ("2000-01", "b", 3), ("2000-01", "a", 4), ("2000-02", None, 5),
        ("2000-03", "z", 6), ("2000-03", "z", 6), ("2000-04", "q", 7)]


def ordered(spark, parts=4):
    df = spark.createDataFrame(ROWS, "month string, name string, v int")
    return store_ordered(df, ("month", "name"), "small", parts)


def test_positions_follow_the_order_with_nulls_and_ties(spark):
    got = [(r.month, r.name, r.v) for r in ordered(spark).positions().orderBy("position").collect()]
    assert got == sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or ""))
    assert sorted(r.position for r in ordered(spark).positions().collect()) == list(range(1, len(ROWS) + 1))


@pytest.mark.parametrize("first,last,want", [
    ("2000-01", "2000-01", [4, 3]), ("2000-02", "2000-03", [5, 6, 6]), (None, "2000-01", [4, 3]), ("2000-04", None, [7]),
    ("2001", "2002", []), (None, None, [2, 1, 4, 3, 5, 6, 6, 7])])
def test_range_reads_come_in_order(spark, first, last, want):
    for parts in (1, 3, 8):
        rows = ordered(spark, parts).between(first, last)
        assert [r.v for r in rows.collect()] == want
        assert [f.dataType for f in rows.schema] == [T.StringType(), T.StringType(), T.IntegerType()]


def test_one_month_reads_few_files_and_sorts_nothing(spark):
    months = spark.range(24000).select(F.format_string("%04d-%02d", (2000 + F.col("id") % 24 / 12).cast("int"),
                                                       (F.col("id") % 12 + 1).cast("int")).alias("month"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("name"))
    table = store_ordered(months, ("month", "name"), "months", 24)
    one = table.between("2001-05", "2001-05")
    assert len(one.inputFiles()) <= 3 < len(table.rows().inputFiles())
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    got = [r.name for r in one.collect()]
    assert got == sorted(got) and len(got) == months.filter("month = '2001-05'").count() > 0
    assert "Sort" not in table.positions()._jdf.queryExecution().optimizedPlan().toString()


def test_empty_table(spark):
    table = store_ordered(spark.createDataFrame([], "month string, v int"), ("month",), "none")
    assert table.between().collect() == table.between("a", "b").collect() == table.positions().collect() == []
