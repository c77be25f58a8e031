"""Mergeable distinct counts: several blocks, hot and null keys, nulls, empty tables, plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimwright import queries as Q
from claimwright.operators import distinct
from claimwright.operators.materialize import materialize
from claimwright.plans import gold
from claimwright.plans.distinct_rollups import store_distinct_rollups

from conftest import SF_SMALL

FINE = ["day", "shop"]


def visits(spark, n):
    """A third of the rows are one visitor's, a ninth have none; days and shops are null at times."""
    return materialize(spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 9 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("v"), F.col("id") % 41_000)).alias("who"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 7).alias("day"),
        F.when(F.col("id") % 5 != 0, F.lit("s")).alias("shop")), "distinct-visits")


@pytest.mark.parametrize("n", [90_000, 4, 0])
def test_counts_of_every_grain_equal_count_distinct(spark, n):
    rows = visits(spark, n)
    nobody = rows.limit(1).select(F.lit(None).cast("string").alias("who"), F.lit(99).cast("bigint").alias("day"), F.lit("x").alias("shop"))
    rows = rows.unionByName(nobody)
    numbers = distinct.number_values(rows, "who", "number")
    assert [r[0] for r in numbers.select("number").orderBy("number").collect()] == list(range(1, numbers.count() + 1))
    numbered = distinct.with_number(rows, "who", numbers, "number")
    assert numbered.count() == rows.count()
    fine = materialize(distinct.cells(numbered, FINE, "number"), "distinct-fine")
    if n > 2 * distinct.BITS:
        assert fine.agg(F.max("block")).first()[0] == 2
    bits = distinct.bitmaps(fine, FINE)
    for keys in (FINE, ["day"], ["shop"], []):
        expected = {tuple(r) for r in rows.groupBy(*keys).agg(F.count_distinct("who")).collect()}
        by_bits = distinct.cardinality(distinct.merged(bits, keys), keys, "c")
        assert {tuple(r) for r in by_bits.collect()} == expected
        if keys:
            assert {tuple(r) for r in distinct.counted(fine, keys, "c").collect()} == expected


def test_bitmaps_merge_without_rows_of_values(spark):
    fine = distinct.cells(distinct.with_number(visits(spark, 100), "who", distinct.number_values(visits(spark, 100), "who", "n"), "n"), FINE, "n")
    bits = materialize(distinct.bitmaps(fine, FINE), "distinct-bits")
    plan = distinct.cardinality(distinct.merged(bits, ["day"]), ["day"], "c")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "positions" not in plan and "Join" not in plan


def test_rollups_equal_the_published_counts(spark):
    analytics = materialize(Q._analytics(spark, SF_SMALL), "distinct-analytics")
    rollups = store_distinct_rollups(analytics)

    def same(got, expected):
        got, expected = ({tuple(r) for r in df.collect()} for df in (got, expected))
        assert got == expected and got

    same(rollups.members_by_month_and_provider(),
         gold.monthly_claims_summary(analytics, sort=False).select("claim_month", "provider_name", "risk_category", "unique_members"))
    same(rollups.members_by_provider(), gold.provider_metrics(analytics).select("provider_id", "unique_members_served"))
    same(rollups.providers_by_member(), gold.member_risk_profile(analytics).select("member_id", "unique_providers"))
