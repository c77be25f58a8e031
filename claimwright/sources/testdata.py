"""Role binding: derive the five raw claim sources from the driver's tables.

The test data is a TPC-H-like star schema, not claims.  These functions map
it onto the source roles deterministically (see FIXTURES.md section 2), so
that an independent SQL engine can rebuild exactly the same rows.  Every
role is a Spark plan over the whole input tables; nothing is sampled.

:func:`bronze` returns a role as its bronze table (dates parsed, lineage
column set to the table it came from).  :func:`raw` returns the same rows
as the source files would carry them (dates and timestamps as text), for
staging CSV / JSON files that the file readers then ingest.

The modulo expressions below shape the data (NULL keys, duplicates, older
copies, claims whose provider is unknown); they never cap or sample rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.sources.schemas import DATE_FORMAT, TIMESTAMP_FORMAT

# Fixed value: the date every clock-dependent rule is evaluated at in tests.
AS_OF = "2000-06-01"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- fixed values: role-binding expressions (FIXTURES.md section 2) ----------
# the provider a claim line belongs to; one claim in ten names an unknown one
_KNOWN_PROVIDER = ("CASE l_suppkey % 3 WHEN 0 THEN 'P' || l_suppkey "
                   "WHEN 1 THEN 'P' || l_suppkey || '-' || l_linenumber "
                   "ELSE 'P' || l_suppkey || '-x' || (l_partkey % 40) END")
_CLAIMS_BATCH = {
    "ClaimID": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_orderkey || '-' || l_linenumber END",
    "MemberID": "CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE 'M' || lpad(CAST(o_custkey AS STRING), 6, '0') END",
    "ProviderID": f"CASE WHEN l_partkey % 10 = 7 THEN 'U' || l_suppkey ELSE {_KNOWN_PROVIDER} END",
    "ClaimDate": ("CAST(l_shipdate AS DATE) + CAST(CASE "
                  "WHEN l_suppkey % 5 = 4 AND l_partkey % 5 = 0 THEN 400 "
                  "WHEN l_suppkey % 5 = 4 AND l_partkey % 5 = 1 THEN -5 "
                  "WHEN l_suppkey % 5 = 4 AND l_partkey % 5 = 2 THEN 120 "
                  "WHEN l_suppkey % 5 = 4 THEN 20 WHEN l_suppkey % 5 = 3 THEN 12 "
                  "WHEN l_suppkey % 5 = 2 THEN 5 WHEN l_suppkey % 5 = 1 THEN 2 "
                  "ELSE 0 END + l_linenumber % 3 - 1 AS INT)"),
    "ServiceDate": "CAST(l_shipdate AS DATE)",
    "Amount": ("CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2)) "
               "* CAST(l_quantity AS DECIMAL(4,0)) * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(10,2))"),
    "Status": "o_orderstatus",
    "ICD10Codes": ("CASE WHEN l_partkey % 13 = 0 THEN NULL "
                   "WHEN l_partkey % 4 = 0 THEN 'A' || (l_partkey % 90) "
                   "WHEN l_partkey % 4 = 1 THEN 'A' || (l_partkey % 90) || ';B2' "
                   "WHEN l_partkey % 4 = 2 THEN 'A' || (l_partkey % 90) || ';' "
                   "ELSE 'A1;B2;C3' END"),
    "CPTCodes": "CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN '99213' ELSE '99213;80050' END",
    "ClaimType": "CASE WHEN l_returnflag = 'R' THEN 'Inpatient' ELSE 'Outpatient' END",
    "SubmissionChannel": "CASE WHEN l_linestatus = 'F' THEN 'Portal' ELSE 'Paper' END",
    "Notes": "CAST(NULL AS STRING)",
    "IngestTimestamp": "date_format(CAST(l_shipdate AS TIMESTAMP), 'yyyy-MM-dd HH:mm:ss')",
    "ingestion_timestamp": "CAST(l_shipdate AS TIMESTAMP) + make_interval(0, 0, 0, 0, 0, 0, l_partkey)",
}

_CLAIMS_STREAM = {
    "ClaimID": "CASE WHEN event_id % 50 = 0 THEN event_id || '-1' ELSE 'E' || event_id END",
    "MemberID": "'M' || lpad(CAST(user_id AS STRING), 6, '0')",
    "ProviderID": "'P' || ((user_id % 10) * 3)",
    "ClaimDate": "date_sub(CAST(ts AS DATE), 8766)",
    "Amount": "CAST(CAST(value AS DECIMAL(10,2)) * 20 AS DECIMAL(10,2))",
    "Status": "event_type",
    "ICD10Codes": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'A1;E' || (event_id % 20) END",
    "CPTCodes": "'99213'",
    "EventTimestamp": "CAST(ts AS TIMESTAMP)",
    "ingestion_timestamp": "TIMESTAMP '2002-01-01 00:00:00'",
}

_MEMBERS = {
    "MemberID": ("CASE WHEN c_custkey % 211 = 3 THEN 'M' || (c_custkey % 10) "
                 "ELSE 'M' || lpad(CAST(c_custkey AS STRING), 6, '0') END"),
    "Name": "c_name",
    "DOB": "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE date_add(DATE '1935-01-01', CAST(c_custkey * 37 % 23000 AS INT)) END",
    "Gender": "CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END",
    "Region": "r_name",
    "PlanType": "c_mktsegment",
    "EffectiveDate": "date_add(DATE '1998-01-01', CAST(c_custkey % 700 AS INT))",
    "Email": ("CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'ab@mail.test' "
              "ELSE lower(c_name) || '@mail.test' END"),
    "IsActive": "CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 0.0D ELSE 1.0D END",
    "LastUpdated": "date_add(DATE '2000-01-01', CAST(c_custkey % 200 - 300 * v AS INT))",
}
# members keep the older copy (v = 1) only where this holds:
_MEMBERS_DUPLICATE = "c_custkey % 5 = 0"

_PROVIDERS = {
    "ProviderID": "ProviderID",
    "Name": "CASE WHEN s_suppkey % 37 = 5 THEN NULL ELSE s_name END",
    "Specialties": ("CASE s_suppkey % 4 WHEN 0 THEN CAST(NULL AS ARRAY<STRING>) "
                    "WHEN 1 THEN array('Cardiology') "
                    "WHEN 2 THEN array(' Cardiology ', 'Oncology') "
                    "ELSE array('Radiology', 'Oncology', 'ENT') END"),
    "Locations": ("CASE (s_suppkey DIV 3) % 3 "
                  "WHEN 0 THEN CAST(array() AS ARRAY<STRUCT<Address: STRING, City: STRING, State: STRING>>) "
                  "WHEN 1 THEN array(named_struct('Address', '1 Main', 'City', n_name, 'State', ' tx')) "
                  "ELSE array(named_struct('Address', '1 Main', 'City', n_name, 'State', ' tx'), "
                  "named_struct('Address', '2 Side', 'City', CAST(NULL AS STRING), 'State', 'Ca ')) END"),
    "IsActive": "s_acctbal > 0 AND v = 0",
    "TIN": "lpad(CAST(s_suppkey AS STRING), 9, '0')",
    "LastVerified": "date_add(DATE '1999-01-01', CAST(s_suppkey % 365 - 400 * v AS INT))",
}
# providers: the older copy
_PROVIDERS_DUPLICATE = "s_suppkey % 4 = 1"

_DIAGNOSIS = {
    "Code": ("CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN upper(p_brand) "
             "WHEN p_partkey % 3 = 1 THEN ' ' || lower(p_brand) ELSE p_brand END"),
    "Description": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE ' ' || p_name END",
}
# --- end of fixed values -----------------------------------------------------


def _project(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in exprs.items()])


def _two_copies(df: DataFrame, keep_second: str) -> DataFrame:
    """Each row as v = 0, plus an older copy v = 1 where ``keep_second``.

    A two-row inline array exploded per row: no join, no shuffle.
    """
    return (df.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
              .filter(F.expr(f"v = 0 OR ({keep_second})")))


def _lineitem_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")


def claims_batch_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_lineitem_orders(spark, sf_dir), _CLAIMS_BATCH)


def claims_stream_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_table(spark, sf_dir, "events"), _CLAIMS_STREAM)


def members_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    r = _table(spark, sf_dir, "region")
    base = (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
             .join(r, n.n_regionkey == r.r_regionkey, "inner"))
    return _project(_two_copies(base, _MEMBERS_DUPLICATE), _MEMBERS)


def providers_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every line has an order (tests/test_rules.py checks the key), so lineitem alone will do.
    lines = _table(spark, sf_dir, "lineitem")
    ids = lines.select(F.expr(_KNOWN_PROVIDER).alias("ProviderID"), "l_suppkey").distinct()
    s = _table(spark, sf_dir, "supplier")
    n = _table(spark, sf_dir, "nation")
    base = (ids.join(s, ids.l_suppkey == s.s_suppkey, "inner")
               .join(n, s.s_nationkey == n.n_nationkey, "inner"))
    return _project(_two_copies(base, _PROVIDERS_DUPLICATE), _PROVIDERS)


def diagnosis_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_table(spark, sf_dir, "part"), _DIAGNOSIS)


_TYPED = {
    "claims_batch": (claims_batch_typed, "lineitem"),
    "claims_stream": (claims_stream_typed, "events"),
    "members": (members_typed, "customer"),
    "providers": (providers_typed, "supplier"),
    "diagnosis_reference": (diagnosis_typed, "part"),
}


def bronze(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The bronze table of ``source`` (same columns as a file ingest)."""
    build, table = _TYPED[source]
    df = build(spark, sf_dir)
    lineage = F.lit(f"{sf_dir.rstrip('/')}/{table}.parquet")
    cols = {"source_file": lineage}
    if "ingestion_timestamp" not in df.columns:
        # Batch dimension tables: one load time for the whole load.
        cols = {"ingestion_timestamp": F.current_timestamp(), **cols}
    if source == "claims_batch":
        cols["OriginalIngestTimestamp"] = F.to_timestamp("IngestTimestamp", TIMESTAMP_FORMAT)
    # Keep the bronze column order of a file ingest: source columns,
    # ingestion_timestamp, source_file, then derived columns.
    ordered = [c for c in df.columns if c != "ingestion_timestamp"]
    df = df.select(*ordered, *[c for c in df.columns if c == "ingestion_timestamp"])
    return df.withColumns(cols)


def raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The rows of ``source`` as its files carry them (text dates)."""
    build, _ = _TYPED[source]
    df = build(spark, sf_dir)
    casts = {}
    for field in df.schema.fields:
        if field.dataType.typeName() == "date":
            casts[field.name] = F.date_format(field.name, DATE_FORMAT)
        elif field.name == "EventTimestamp":
            casts[field.name] = F.date_format(field.name, TIMESTAMP_FORMAT)
    return df.withColumns(casts).drop("ingestion_timestamp")

