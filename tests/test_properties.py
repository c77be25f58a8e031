
from __future__ import annotations

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from claimwright import queries as Q
from claimwright.functions.scoring import add_fraud_score
from claimwright.operators.expectations import expectation_metrics
from claimwright.plans import silver

from conftest import SF_SMALL

score_rows = st.lists(st.tuples(
    st.decimals(min_value=Decimal("0.01"), max_value=Decimal("99999.99"), places=2),
    st.one_of(st.none(), st.decimals(min_value=Decimal("0.01"), max_value=Decimal("99999.99"), places=2)),
    st.integers(-30, 800),
    st.sampled_from([0.3, 0.5, 0.7, 0.9]),
    st.integers(0, 40)), min_size=1, max_size=30)


@settings(max_examples=10, deadline=None)
@given(rows=score_rows)
def test_score_parts_sum_to_total(spark, rows):
    base = dt.date(2000, 1, 1)
    df = spark.createDataFrame(
        [(a, v, base + dt.timedelta(days=d), base, r, f) for a, v, d, r, f in rows],
        "claim_amount decimal(10,2), avg_claim_amount decimal(10,2), claim_date date, service_date date, "
        "provider_reputation_score double, member_claim_frequency long")
    for r in add_fraud_score(df).collect():
        parts = r.amount_score + r.timing_score + r.provider_score + r.volume_score
        assert r.fraud_risk_score == parts and 0 <= parts <= 100
        assert r.risk_category == ("HIGH" if parts >= 70 else "MEDIUM" if parts >= 40 else "LOW")
        expected = ("URGENT" if parts >= 70 and r.claim_amount > 10000 else r.risk_category)
        assert r.investigation_priority == expected


def test_published_rows_satisfy_every_rule(spark):
    checks = [
        (Q._claims_processed(spark, SF_SMALL), silver.claims_rules(Q.AS_OF), "claims_processed"),
        (Q._members_processed(spark, SF_SMALL), silver.MEMBER_RULES, "members_processed"),
        (Q._providers_processed(spark, SF_SMALL), silver.PROVIDER_RULES, "providers_processed"),
    ]
    for df, rules, name in checks:
        for r in expectation_metrics(df, rules, name).collect():
            assert r.failed_records == 0, (name, r.rule)


def test_dedup_keys_unique_in_published_tables(spark):
    for df, key in ((Q._claims_processed(spark, SF_SMALL), "claim_id"),
                    (Q._members_processed(spark, SF_SMALL), "MemberID")):
        assert df.count() == df.select(key).distinct().count()
