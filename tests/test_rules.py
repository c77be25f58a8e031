"""Edge cases on in-memory rows (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimwright.functions.rules import mask_email, split_codes
from claimwright.functions.scoring import add_fraud_score, claim_efficiency_score, reputation_score
from claimwright.plans import gold, quality, silver

D = dt.date


def test_mask_email(spark):
    df = spark.createDataFrame(
        [("alice@x.com",), ("abc@x.com",), ("ab@x.com",), (None,)], "email string")
    got = df.select(mask_email("email").alias("m"), mask_email("email", strict=True).alias("s")).collect()
    assert [r.m for r in got] == ["ali***@x.com", "abc***@x.com", "ab@x.com", None]
    assert [r.s for r in got] == ["ali***@x.com", "abc***@x.com", "ab***@x.com", None]


def test_split_codes_keeps_empty_items_and_nulls_become_empty(spark):
    df = spark.createDataFrame([("A;B;",), (None,), ("",)], "c string")
    got = df.select(split_codes("c").alias("a")).collect()
    assert [r.a for r in got] == [["A", "B", ""], [], [""]]


def _batch_claims(spark, rows):
    """rows: (claim_id, amount, claim_date, service_date, codes, ingested_at)."""
    full = [("C" if cid is None else cid, "M00001", "P1", Decimal(amt) if amt is not None else None,
             cd, sd, "A", codes, "99213", "Outpatient", "Portal", None, ts)
            for cid, amt, cd, sd, codes, ts in rows]
    df = spark.createDataFrame(full, (
        "ClaimID string, MemberID string, ProviderID string, Amount decimal(10,2), ClaimDate date, "
        "ServiceDate date, Status string, ICD10Codes string, CPTCodes string, ClaimType string, "
        "SubmissionChannel string, Notes string, ingestion_timestamp timestamp"))
    return df.withColumns({"OriginalIngestTimestamp": F.col("ingestion_timestamp"),
                           "source_file": F.lit("mem"), "IngestTimestamp": F.lit(None).cast("string")})


def test_flags_trailing_separator_and_null_codes(spark):
    t = dt.datetime(2000, 1, 1)
    b = _batch_claims(spark, [("c1", "10", D(2000, 1, 2), D(2000, 1, 1), "A;B;", t),
                              ("c2", "10", D(2000, 1, 2), D(2000, 1, 1), None, t)])
    got = {r.claim_id: r for r in silver.add_claim_flags(silver.union_claims(b)).collect()}
    assert got["c1"].has_multiple_diagnoses and len(got["c1"].icd10_codes_array) == 3
    assert got["c2"].icd10_codes_array == [] and got["c2"].is_valid_claim is False


def test_validity_day_bands(spark):
    t = dt.datetime(2000, 1, 1)
    s = D(1999, 1, 1)
    rows = [(f"d{n}", "10", s + dt.timedelta(days=n), s, "A1", t) for n in (365, 366, -1)]
    got = {r.claim_id: r.is_valid_claim
           for r in silver.add_claim_flags(silver.union_claims(_batch_claims(spark, rows))).collect()}
    assert got == {"d365": True, "d366": False, "d-1": False}


def test_newest_invalid_row_removes_claim_and_null_amount_dropped(spark):
    rows = [("c", "10", D(2000, 1, 2), D(2000, 1, 1), "A1", dt.datetime(2000, 1, 1)),
            ("c", "-1", D(2000, 1, 2), D(2000, 1, 1), "A1", dt.datetime(2000, 1, 2)),
            ("n", None, D(2000, 1, 2), D(2000, 1, 1), "A1", dt.datetime(2000, 1, 1)),
            ("ok", "5", D(2000, 1, 2), D(2000, 1, 1), "A1", dt.datetime(2000, 1, 1))]
    out = silver.claims_processed(_batch_claims(spark, rows), None, "2000-06-01")
    assert sorted(r.claim_id for r in out.collect()) == ["ok"]


def test_optional_feed_missing_or_empty_gives_batch_rows(spark):
    rows = [("a", "10", D(2000, 1, 2), D(2000, 1, 1), "A1", dt.datetime(2000, 1, 1))]
    b = _batch_claims(spark, rows)
    empty_stream = spark.createDataFrame([], (
        "ClaimID string, MemberID string, ProviderID string, ClaimDate date, Amount decimal(10,2), "
        "Status string, ICD10Codes string, CPTCodes string, EventTimestamp timestamp, "
        "ingestion_timestamp timestamp, source_file string"))
    one = silver.claims_processed(b, None, "2000-06-01").select("claim_id").collect()
    two = silver.claims_processed(b, empty_stream, "2000-06-01").select("claim_id").collect()
    assert one == two == [("a",)]


def _scores(spark, rows):
    """rows: (amount, avg, claim_date, service_date, reputation, frequency)."""
    df = spark.createDataFrame(
        [(Decimal(a), Decimal(v) if v is not None else None, cd, sd, r, f) for a, v, cd, sd, r, f in rows],
        "claim_amount decimal(10,2), avg_claim_amount decimal(14,6), claim_date date, service_date date, "
        "provider_reputation_score double, member_claim_frequency long")
    return add_fraud_score(df).collect()


def test_timing_bands(spark):
    s = D(2000, 1, 1)
    rows = [("1", "1", s + dt.timedelta(days=n), s, 0.9, 1) for n in (90, 91, 365, 366, -1)]
    assert [r.timing_score for r in _scores(spark, rows)] == [0, 10, 10, 20, 25]


def test_amount_bands(spark):
    s = D(2000, 1, 1)
    rows = [(a, "100", s, s, 0.9, 1) for a in ("200", "201", "300", "301")]
    assert [r.amount_score for r in _scores(spark, rows)] == [0, 15, 15, 30]


def test_provider_and_volume_bands(spark):
    s = D(2000, 1, 1)
    rows = [("1", "1", s, s, rep, 1) for rep in (0.3, 0.5, 0.7, 0.9)]
    assert [r.provider_score for r in _scores(spark, rows)] == [25, 15, 0, 0]
    rows = [("1", "1", s, s, 0.9, f) for f in (5, 6, 10, 11)]
    assert [r.volume_score for r in _scores(spark, rows)] == [0, 10, 10, 20]


def test_total_category_and_priority(spark):
    s = D(2000, 1, 1)
    late = s + dt.timedelta(days=-1)
    rows = [("10000.00", "1000", late, s, 0.3, 11), ("10000.01", "1000", late, s, 0.3, 11)]
    got = _scores(spark, rows)
    assert [r.fraud_risk_score for r in got] == [100.0, 100.0]
    assert [r.risk_category for r in got] == ["HIGH", "HIGH"]
    assert [r.investigation_priority for r in got] == ["HIGH", "URGENT"]
    for r in got:
        assert r.amount_score + r.timing_score + r.provider_score + r.volume_score == r.fraud_risk_score


def test_reputation_and_efficiency_bands(spark):
    df = spark.createDataFrame([(n,) for n in (10, 11, 50, 51, 100, 101)], "n long")
    got = [r[0] for r in df.select(reputation_score(F.col("n"))).collect()]
    assert got == [0.3, 0.5, 0.5, 0.7, 0.7, 0.9]
    df = spark.createDataFrame([(d,) for d in (1.0, 1.5, 7.0, 30.0, 30.5, None)], "d double")
    assert [r[0] for r in df.select(claim_efficiency_score(F.col("d"))).collect()] == [100, 80, 80, 60, 40, 40]


def _providers(spark, rows):
    return spark.createDataFrame(rows, (
        "ProviderID string, Name string, Specialties array<string>, "
        "Locations array<struct<Address:string,City:string,State:string>>, IsActive boolean, TIN string, "
        "LastVerified date, ingestion_timestamp timestamp, source_file string"))


def test_explode_product_counts_and_active_rows(spark):
    locs3 = [("a1", "c", " tx"), ("a2", "c", "ca"), ("a3", None, "ny")]
    t = dt.datetime(2000, 1, 1)
    p = _providers(spark, [
        ("P1", "one", ["x", "y"], locs3, True, "1", D(2000, 1, 1), t, "f"),
        ("P2", "two", None, locs3, False, "2", D(2000, 1, 1), t, "f"),
    ])
    norm = silver.providers_processed(p)
    assert norm.filter("provider_id = 'P1'").count() == 6
    assert norm.filter("provider_id = 'P2'").count() == 3
    summary = {r.provider_id: r for r in gold.provider_summary(norm).collect()}
    assert (summary["P1"].specialty_count, summary["P1"].location_count) == (6, 6)
    assert (summary["P2"].specialty_count, summary["P2"].location_count) == (0, 3)
    assert norm.filter("state_standardized = 'TX'").count() == 3  # 2 specialties x 1 + 1
    # quality summary counts exploded rows, in the column named high_value_claims
    claims = spark.createDataFrame([(True, False)], "is_valid_claim boolean, is_high_value_claim boolean")
    members = spark.createDataFrame([(True, True)], "has_complete_profile boolean, is_active_member boolean")
    dq = {r.table_name: r for r in quality.data_quality_summary(claims, members, norm).collect()}
    assert dq["providers"].high_value_claims == 6
    assert dq["providers"].total_records == 9


def test_provider_newest_row_with_null_name_removes_provider(spark):
    t = dt.datetime(2000, 1, 1)
    p = _providers(spark, [
        ("P1", "old", ["x"], [], True, "1", D(1999, 1, 1), t, "f"),
        ("P1", None, ["x"], [], True, "1", D(2000, 1, 1), t, "f"),
    ])
    assert silver.providers_processed(p).count() == 0


def test_diagnosis_codes_dedup_on_raw_code(spark):
    df = spark.createDataFrame([("a01", " d1"), ("A01 ", "d2"), ("A01 ", None), (None, "x")],
                               "Code string, Description string")
    df = df.withColumns({"ingestion_timestamp": F.current_timestamp(), "source_file": F.lit("f")})
    got = silver.diagnosis_processed(df).collect()
    assert sorted(r.code_standardized for r in got) == ["A01", "A01"]
    assert sorted(r.description_clean for r in got) == ["d1", "d2"]


def _analytics_rows(spark, rows):
    """rows: (member_id, fraud_risk_score, claim_amount, risk_category)."""
    df = spark.createDataFrame(
        [(m, f"c{i}", "P1", s, Decimal(a), cat, False, ["A"], ["B"], 0, D(2000, 1, 1), 40, "F", "R", "PT", True)
         for i, (m, s, a, cat) in enumerate(rows)],
        "member_id string, claim_id string, provider_id string, fraud_risk_score double, "
        "claim_amount decimal(10,2), risk_category string, is_high_value_claim boolean, "
        "icd10_codes_array array<string>, cpt_codes_array array<string>, days_to_claim int, "
        "service_date date, age long, Gender string, Region string, PlanType string, is_active_member boolean")
    return {r.member_id: r for r in gold.member_risk_profile(df).collect()}


def test_member_tiers_and_case_management(spark):
    rows = ([("hr", 70.0, "1", "HIGH")] + [("mr", 40.0, "1", "MEDIUM")]
            + [("hu", 39.9, "1", "LOW")] * 21 + [("lr", 39.9, "1", "LOW")] * 20
            + [("cm0", 0.0, "50000", "LOW"), ("cm1", 0.0, "50000.01", "LOW")])
    got = _analytics_rows(spark, rows)
    assert got["hr"].member_risk_tier == "HIGH_RISK"
    assert got["mr"].member_risk_tier == "MEDIUM_RISK"
    assert got["hu"].member_risk_tier == "HIGH_UTILIZATION"
    assert got["lr"].member_risk_tier == "LOW_RISK"
    assert got["cm0"].needs_case_management is False
    assert got["cm1"].needs_case_management is True
    assert got["hr"].needs_case_management is True  # high-risk claim
    assert got["hu"].needs_case_management is True  # more than 15 claims


def test_overall_provider_score_maximum(spark):
    df = spark.createDataFrame(
        [("P1", "n", f"c{i}", "m", Decimal("10"), 0.0, "LOW", 0, 0.9, 0, 0, D(2000, 1, 1)) for i in range(101)],
        "provider_id string, provider_name string, claim_id string, member_id string, claim_amount decimal(10,2), "
        "fraud_risk_score double, risk_category string, days_to_claim int, provider_reputation_score double, "
        "specialty_count long, location_count long, service_date date")
    (r,) = gold.provider_performance(df).collect()
    assert (r.efficiency_score, r.high_risk_percentage, r.overall_provider_score) == (100, 0.0, 6036.0)
    assert (r.value_rank, r.fraud_risk_rank, r.volume_rank) == (1, 1, 1)


def test_unknown_member_and_provider_kept(spark):
    claims = spark.createDataFrame(
        [("c1", "M9", "P9", Decimal("10"), D(2000, 1, 2), D(2000, 1, 1), 1)],
        "claim_id string, member_id string, provider_id string, claim_amount decimal(10,2), "
        "claim_date date, service_date date, days_to_claim int")
    members = spark.createDataFrame([], "MemberID string, age long, is_active_member boolean, Gender string, "
                                        "Region string, PlanType string, has_complete_profile boolean")
    providers = spark.createDataFrame([], "provider_id string, provider_name string, is_active boolean, "
                                          "specialty string, address string, last_verified date")
    (r,) = gold.claims_analytics(claims, gold.store_dimensions(claims, members, providers)).collect()
    assert r.claim_id == "c1" and r.age is None and r.provider_name is None
    assert r.total_claims == 1 and r.member_claim_frequency == 1


@pytest.mark.parametrize("n", [0])
def test_conditional_count_over_no_rows_is_null(spark, n):
    df = spark.createDataFrame([], "is_valid_claim boolean, is_high_value_claim boolean")
    members = spark.createDataFrame([], "has_complete_profile boolean, is_active_member boolean")
    providers = spark.createDataFrame([], "has_complete_address boolean, is_active boolean")
    rows = quality.data_quality_summary(df, members, providers).collect()
    assert all(r.total_records == n and r.valid_records is None for r in rows)
