"""Plan-shape guards for the scale properties the README promises."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from claimwright import queries as Q
from claimwright.operators.materialize import materialize
from claimwright.plans import bucketed, gold, silver
from claimwright.sources import testdata as TD

from conftest import SF_SMALL


@contextlib.contextmanager
def static_plans(spark):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_enrichment_exchanges_claims_once_per_key(spark):
    claims = materialize(Q._claims_processed(spark, SF_SMALL), "plan-claims")
    members = materialize(Q._members_processed(spark, SF_SMALL), "plan-members")
    providers = materialize(Q._providers_processed(spark, SF_SMALL), "plan-providers")
    with static_plans(spark):
        dims = gold.store_dimensions(claims, members, providers)
        plan = gold.claims_enriched(claims, dims)._jdf.queryExecution().executedPlan().toString()
    # the per-key dimensions are stored first; what is left is one join per
    # key, each reading two exchanges: claim rows + dimension on member_id,
    # then on provider_id
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("Exchange hashpartitioning(member_id") == 2
    assert plan.count("Exchange hashpartitioning(provider_id") == 2
    assert "SortAggregate" not in plan


def test_hot_member_and_provider_are_split_by_aqe(spark):
    conf = {"spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 120000  # a third of the claims belong to one member, a third to one provider
        claims = spark.range(n).select(
            F.concat(F.lit("c"), F.col("id")).alias("claim_id"),
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("m"), F.col("id") % 3000)).alias("member_id"),
            F.when(F.col("id") % 3 == 1, F.lit("PHOT")).otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("provider_id"),
            (F.col("id") % 1000 + 1).cast("decimal(10,2)").alias("claim_amount"),
            F.lit("2000-01-02").cast("date").alias("claim_date"),
            F.lit("2000-01-01").cast("date").alias("service_date"),
            F.lit(1).alias("days_to_claim")).repartition(8)
        members = spark.range(3000).select(
            F.concat(F.lit("m"), F.col("id")).alias("MemberID"), F.lit(30).cast("long").alias("age"),
            F.lit(True).alias("is_active_member"), F.lit("F").alias("Gender"), F.lit("R").alias("Region"),
            F.lit("P").alias("PlanType"), F.lit(True).alias("has_complete_profile"))
        providers = spark.range(500).select(
            F.concat(F.lit("p"), F.col("id")).alias("provider_id"), F.lit("n").alias("provider_name"),
            F.lit(True).alias("is_active"), F.lit("s").alias("specialty"), F.lit("a").alias("address"),
            F.lit("2000-01-01").cast("date").alias("last_verified"))
        df = gold.claims_enriched(claims, gold.store_dimensions(claims, members, providers))
        qe = df._jdf.queryExecution()
        assert qe.toRdd().count() == n
        final = qe.executedPlan().toString()
        assert final.count("SortMergeJoin(skew=true)") == 2
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_rollups_use_hash_aggregation(spark):
    analytics = materialize(Q._analytics(spark, SF_SMALL), "plan-analytics")
    for df in (gold.member_risk_profile(analytics), gold.provider_metrics(analytics),
               gold.monthly_claims_summary(analytics, sort=False)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def _below_exchange(df):
    """Physical plan text under the first exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and plan.count("WindowGroupLimit") >= 2
    return plan.split("Exchange", 1)[1]


def test_columns_are_derived_after_deduplication(spark):
    below = _below_exchange(Q.q_claims_dedup(spark, SF_SMALL))
    assert not any(c in below for c in ("icd10_codes_array", "is_high_value_claim", "is_valid_claim", "days_to_claim"))
    below = _below_exchange(Q.q_members_dedup(spark, SF_SMALL))
    assert not any(c in below for c in ("masked_email", "is_active_member", "has_complete_profile"))
    below = _below_exchange(Q.q_diagnosis_processed(spark, SF_SMALL))
    assert not any(c in below for c in ("code_standardized", "description_clean"))


def test_key_rule_is_applied_below_the_exchange(spark):
    # claim_id IS NOT NULL reaches both feeds' scans as a filter on their source columns
    below = _below_exchange(Q._claims_processed(spark, SF_SMALL))
    filters = [line for line in below.splitlines() if "Filter" in line]
    assert any("l_partkey" in f and "isnotnull(concat(" in f for f in filters)
    assert any("event_id" in f and "isnotnull(" in f for f in filters)


def test_no_exchange_has_a_fixed_number_of_partitions(spark):
    for source in Q.RAW_SOURCES:
        plan = TD.raw(spark, SF_SMALL, source)._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION" not in plan


def test_every_line_has_an_order(spark):
    # the providers are derived from lineitem without the join to orders
    lines, orders = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("lineitem", "orders"))
    assert lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left_anti").count() == 0


def test_member_attributes_are_constant_per_member(spark):
    # the member profile groups by them beside the key
    analytics = Q._analytics(spark, SF_SMALL)
    attrs = [src for src, _ in gold.MEMBER_PROFILE_ATTRIBUTES]
    assert analytics.select("member_id", *attrs).distinct().count() == analytics.select("member_id").distinct().count()


def test_ranks_are_bigint_and_narrow(spark):
    ranked = gold.provider_performance(Q._analytics(spark, SF_SMALL))
    types = dict(ranked.dtypes)
    assert {types[r] for r in ("value_rank", "fraud_risk_rank", "volume_rank")} == {"bigint"}


def test_monthly_summary_is_sorted(spark):
    rows = gold.monthly_claims_summary(Q._analytics(spark, SF_SMALL)).select("claim_month", "provider_name", "risk_category").collect()
    key = [tuple("" if v is None else v for v in r) for r in rows]  # ascending, NULL first
    assert len(rows) > 100 and key == sorted(key)


def test_ties_of_the_newest_row_are_settled(spark):
    from claimwright.plans import silver

    batch = TD.bronze(spark, SF_SMALL, "claims_batch").selectExpr("*").withColumn(
        "ingestion_timestamp", F.lit("2001-01-01").cast("timestamp")).withColumn("ClaimID", F.expr("ProviderID"))
    claims = silver.union_claims(batch)
    one, other = (silver.dedup_claims(df).select("claim_id", "member_id", "claim_amount", "claim_date").collect()
                  for df in (claims, claims.repartition(7, "claim_amount")))
    assert sorted(one, key=repr) == sorted(other, key=repr) and len(one) < claims.count()


def test_joins_carry_no_derived_column_and_give_the_same_rows(spark):
    claims = spark.createDataFrame(
        [("c1", "m1", "p1", 6000, 3, "A;B", None), ("c2", "m2", "p1", 60000, -1, None, "9"), ("c3", "m1", "p2", 5, None, "A", "9;8;")],
        "claim_id string, member_id string, provider_id string, amount int, days int, icd10_codes string, cpt_codes string").select(
        "claim_id", "member_id", "provider_id", F.col("amount").cast("decimal(10,2)").alias("claim_amount"),
        F.expr("date_add(DATE'2000-01-01', days)").alias("claim_date"), F.lit("2000-01-01").cast("date").alias("service_date"),
        "icd10_codes", "cpt_codes")
    members = spark.createDataFrame([("m1", 30, True, "F", "R", "P", True)],
                                    "MemberID string, age long, is_active_member boolean, Gender string, Region string, "
                                    "PlanType string, has_complete_profile boolean")
    providers = spark.createDataFrame([("p1", "n", True, "s", "a", None)],
                                      "provider_id string, provider_name string, is_active boolean, specialty string, "
                                      "address string, last_verified date")
    flagged = materialize(silver.add_claim_flags(claims).drop("processed_timestamp"), "derive-flagged")
    claims = materialize(claims, "derive-claims")
    dims = gold.store_dimensions(flagged, members, providers)
    expected = gold.claims_enriched(flagged, dims)
    with static_plans(spark):
        for got in (gold.claims_enriched(claims, dims, derive=silver.add_claim_flags),
                    bucketed.store_bucketed(claims, dims, 4).enriched(derive=silver.add_claim_flags)):
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "icd10_codes_array" in plan and "icd10_codes_array" not in plan.split("Exchange", 1)[1]
            got = got.drop("processed_timestamp")
            assert got.columns == expected.columns
            assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_queries_join_canonical_claims(spark):
    for query in (Q.q_claims_enriched, Q.q_claims_enriched_bucketed, Q.q_member_risk_profile):
        with static_plans(spark):
            plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "Scan parquet" in line]
        assert scans and not any("icd10_codes_array" in line or "is_high_value_claim" in line for line in scans)


def test_months_are_grouped_by_one_date(spark):
    rows = spark.createDataFrame([("2000-01-31", "LOW"), ("2000-01-01", "LOW"), ("2001-12-01", "LOW"), (None, "HIGH"), (None, "HIGH")],
                                 "day string, risk_category string").select(
        F.col("day").cast("date").alias("service_date"), "risk_category", F.lit("p").alias("provider_name"),
        F.lit(1).cast("decimal(10,2)").alias("claim_amount"), F.lit("c").alias("claim_id"), F.lit(1.0).alias("fraud_risk_score"),
        F.lit("m").alias("member_id"), F.lit("URGENT").alias("investigation_priority"), F.lit(True).alias("is_high_value_claim"))
    summary = gold.monthly_claims_summary(materialize(rows, "month-rows"), sort=False)
    got = summary.select("claim_month", "claim_year", "claim_quarter", "claim_count", "unique_members").collect()
    assert {tuple(r) for r in got} == {("2000-01", 2000, "2000-Q1", 2, 1), ("2001-12", 2001, "2001-Q4", 1, 1), (None, None, None, 2, 1)}
    assert summary.columns[:5] == ["claim_month", "claim_year", "claim_quarter", "provider_name", "risk_category"]
    below = summary._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)[1]
    assert "date_format" not in below and "quarter" not in below
