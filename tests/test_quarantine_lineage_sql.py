"""Quarantine of dropped rows, file-level audit and SQL functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimwright.functions import rules as R
from claimwright.functions import sql_functions
from claimwright.functions.scoring import add_fraud_score, claim_efficiency_score, reputation_score
from claimwright.operators.expectations import VIOLATIONS, all_rules_hold, quarantined, stored_metrics, write_with_quarantine
from claimwright.operators.publish import VersionedStore
from claimwright.plans import lineage, medallion, silver
from claimwright.session import scratch_path
from claimwright.sources import testdata as TD
from claimwright.sources.files import read_bronze, write_raw

from conftest import SF_SMALL

RULES = {"positive": "x > 0", "small": "x < 10", "named": "name IS NOT NULL"}


def _rows(spark):
    return spark.createDataFrame([(1, "a"), (5, None), (-1, None), (50, "b"), (None, "c"), (7, "d"), (7, "d")], "x int, name string")


def test_kept_and_dropped_rows_are_all_rows(spark):
    path = scratch_path(spark, "t-quarantine")
    kept, obs = write_with_quarantine(_rows(spark), RULES, "t", path)
    good = spark.read.parquet(kept)
    assert good.columns == ["x", "name"] and sorted(tuple(r) for r in good.collect()) == [(1, "a"), (7, "d"), (7, "d")]
    bad = {(r.x, r.name): r.failed_rules for r in quarantined(spark, path, RULES).collect()}
    assert bad == {(5, None): ["named"], (-1, None): ["positive", "named"], (50, "b"): ["small"], (None, "c"): ["positive", "small"]}
    told = {r.rule: (r.failed_records, r.total_records, r.passed_records) for r in stored_metrics(spark, path, RULES, "t").collect()}
    assert told == {"positive": (2, 7, 3), "small": (2, 7, 3), "named": (2, 7, 3)}
    assert obs.get["passed_records"] == 3 and obs.get["failed__named"] == 2


def test_reading_one_side_prunes_the_other(spark):
    path = scratch_path(spark, "t-prune")
    write_with_quarantine(_rows(spark), RULES, "t2", path)
    plan = quarantined(spark, path, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"NOT ({VIOLATIONS}" in plan


@pytest.mark.parametrize("keep", ["x > 1000", "x IS NULL AND x IS NOT NULL"])
def test_quarantine_when_all_rows_break_a_rule_or_there_are_none(spark, keep):
    for df in (_rows(spark), _rows(spark).limit(0)):
        path = scratch_path(spark, "t-none-kept")
        kept, _ = write_with_quarantine(df, {"never": keep}, "t3", path)
        assert spark.read.parquet(kept).count() == 0
        assert stored_metrics(spark, path, {"never": keep}, "t").first()["total_records"] == df.count()


def test_run_publishes_quarantine_and_history(spark):
    root = scratch_path(spark, "t-history")
    bronze = {s: TD.bronze(spark, SF_SMALL, s) for s in ("claims_batch", "claims_stream", "members", "providers", "diagnosis_reference")}
    for _ in range(2):
        result = medallion.materialize(spark, bronze, root, as_of=TD.AS_OF, register_views=False)
    for name in ("claims_processed", "members_processed"):
        m = result.metrics[name]
        out = medallion.quarantined(spark, root, name, TD.AS_OF)
        assert out.count() == m["total_records"] - m["passed_records"] > 0
        assert out.filter(F.size("failed_rules") == 0).isEmpty()
        assert out.filter(all_rules_hold(medallion.expectations(TD.AS_OF)[name])).isEmpty()
        published = medallion.published(spark, root, f"silver/{name}")
        assert published.count() == m["passed_records"] and VIOLATIONS not in published.columns
    history = VersionedStore(spark, root).table(medallion.HISTORY)
    runs = {r.run: r.n for r in history.filter("dataset = 'claims_processed' AND counter = 'total_records'")
            .groupBy("run").agg(F.max("records").alias("n")).collect()}
    assert sorted(runs) == [1, 2] and len(set(runs.values())) == 1


# --- files -------------------------------------------------------------------------

def test_file_audit_finds_missing_doubled_and_unknown_files(spark):
    raw = write_raw(TD.raw(spark, SF_SMALL, "members"), "members", scratch_path(spark, "t raw+files"), num_files=4)
    files = lineage.manifest(spark, "members", raw).cache()
    bronze = read_bronze(spark, "members", raw).cache()
    assert files.count() == 4 and files.filter("size > 0 AND rows > 0").count() == 4
    assert files.agg(F.sum("rows")).first()[0] == bronze.count()
    assert {r.status for r in lineage.reconcile(files, bronze).collect()} == {"ok"}

    named = sorted(r[0] for r in bronze.select("source_file").distinct().collect())
    some = (bronze.filter(F.col("source_file") != named[0])  # a whole file is missing
            .unionByName(bronze.filter(F.col("source_file") == named[1]))  # one came twice
            .unionByName(bronze.limit(1).withColumn("source_file", F.lit("file:/gone/part-9.csv"))))
    found = {r.file: r.status for r in lineage.reconcile(files, some).collect()}
    assert sorted(found.values()) == ["doubled", "missing", "ok", "ok", "unknown"] and found["/gone/part-9.csv"] == "unknown"
    one = bronze.filter(F.col("source_file") == named[2])
    part = bronze.filter(F.col("source_file") != named[2]).unionByName(one.limit(one.count() - 1))  # a row is missing
    assert sorted(r.status for r in lineage.reconcile(files, part).collect()) == ["missing", "ok", "ok", "ok"]


# --- SQL ---------------------------------------------------------------------------

def test_sql_functions_equal_the_dataframe_ones(spark):
    names = sql_functions.register(spark)
    assert len(names) == len(sql_functions.definitions())
    rows = spark.sql("""
        SELECT CAST(a AS DECIMAL(10,2)) AS claim_amount, CAST(v AS DECIMAL(14,6)) AS avg_claim_amount, CAST(n AS BIGINT) AS total_claims,
               CAST(m AS BIGINT) AS member_claim_frequency, DATE'2000-03-01' AS claim_date, date_sub(DATE'2000-03-01', d) AS service_date,
               CAST(d AS DOUBLE) AS avg_processing_days, e AS email, c AS codes
        FROM VALUES (10, 10, 1, 1, 0, 'abcdef@x.org', 'A;B;'), (31, 10, 11, 6, 91, 'ab@x', ''), (20001, 100, 51, 11, 366, NULL, NULL),
                    (NULL, NULL, NULL, NULL, NULL, '', ';'), (20000, 0, 101, 5, -1, 'no address', 'A'), (20.01, 10, 10, 10, 7, 'a@b@c', 'A;;B')
             AS t(a, v, n, m, d, e, c)""").withColumn("provider_reputation_score", reputation_score(F.col("total_claims")))
    want = add_fraud_score(rows).select(
        "amount_deviation", "amount_score", "timing_score", "provider_score", "volume_score", "fraud_risk_score", "risk_category",
        "investigation_priority", "provider_reputation_score", claim_efficiency_score(F.col("avg_processing_days")).alias("efficiency"),
        R.mask_email("email").alias("mail"), R.split_codes("codes").alias("split"), R.age_years("service_date", F.lit("2020-02-29").cast("date")).alias("age"))
    rows.createOrReplaceTempView("t_scored")
    got = spark.sql("""
        WITH p AS (SELECT *, cw_amount_deviation(claim_amount, avg_claim_amount) AS d, datediff(claim_date, service_date) AS days,
                          cw_reputation_score(total_claims) AS r FROM t_scored),
        s AS (SELECT *, cw_fraud_risk_score(d, days, r, member_claim_frequency) AS f FROM p)
        SELECT d, cw_amount_score(d), cw_timing_score(days), cw_provider_score(r), cw_volume_score(member_claim_frequency), f,
               cw_risk_category(f), cw_investigation_priority(f, claim_amount), r, cw_claim_efficiency_score(avg_processing_days),
               cw_mask_email(email), cw_split_codes(codes), cw_age_years(service_date, DATE'2020-02-29') FROM s""")

    def plain(r):
        return tuple(float(x) if isinstance(x, (int, float)) or hasattr(x, "as_tuple") else x for x in r)

    assert sorted(map(plain, want.collect()), key=repr) == sorted(map(plain, got.collect()), key=repr)
    assert "PythonUDF" not in got._jdf.queryExecution().executedPlan().toString()
