"""Independent DuckDB statements for every registered query.

These are written directly against the driver's tables (lineitem, orders,
customer, nation, region, supplier, part, events) and rebuild the role
binding and every dataset from scratch in SQL, so they share no code with
the Spark plans.  Output columns and types mirror
:func:`claimwright.queries.comparable`.

Where Spark and DuckDB differ, the SQL spells out Spark's semantics:

* ``avg`` over decimal(10,2) is computed by Spark as a double average of
  the cents, cast to decimal(14,6) (see ``_dec_avg_exact6``), a double in
  DuckDB -> the same double steps are spelled out here;
* the amount deviation is exact decimal arithmetic in Spark -> integer
  micro-units here, and its bands compare the exact values;
* ``round(double, s)`` rounds the shortest decimal text of the double
  half-up in Spark -> rounded through ``CAST(x AS VARCHAR)`` here;
* DuckDB raises on division by zero -> divisors wrapped in ``NULLIF``.
"""

from __future__ import annotations

AS_OF = "DATE '2000-06-01'"
AS_OF_SPARK_TEXT = "DATE'2000-06-01'"


def _spark_round(expr: str, scale: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,17)), {scale}) AS DOUBLE)"


def _dec_avg_exact6(col: str) -> str:
    """Spark's avg over decimal(10,2) as DECIMAL(38,6).

    Catalyst rewrites that average (precision + 4 <= 15) into a double
    average of the unscaled values divided by 10^scale, then casts it to
    decimal(14,6), rounding the double's decimal text half-up.
    """
    dbl = (f"((CAST(sum(CAST({col} * 100 AS BIGINT)) AS DOUBLE) "
           f"/ NULLIF(CAST(count({col}) AS DOUBLE), 0)) / 100.0)")
    return f"round(CAST(CAST({dbl} AS VARCHAR) AS DECIMAL(38,17)), 6)"


def _dec_avg_micro(col: str) -> str:
    return f"CAST({_dec_avg_exact6(col)} * 1000000 AS HUGEINT)"


def _dec_avg(col: str) -> str:
    return f"CAST({_dec_avg_exact6(col)} AS DOUBLE)"


def _dbl_avg(col: str) -> str:
    """avg of integers / integer-valued doubles: exact sum / count, like Spark."""
    return f"(CAST(sum({col}) AS DOUBLE) / NULLIF(count({col}), 0))"


def _count_when(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


_PID = ("CASE l_suppkey % 3 WHEN 0 THEN 'P' || CAST(l_suppkey AS VARCHAR) "
        "WHEN 1 THEN 'P' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) "
        "ELSE 'P' || CAST(l_suppkey AS VARCHAR) || '-x' || CAST(l_partkey % 40 AS VARCHAR) END")

_TS = "'%Y-%m-%d %H:%M:%S'"

# name -> (dependencies, body)
_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    _CTES[name] = (deps, body)


# --- bronze roles -------------------------------------------------------------
_cte("cb", (), f"""
SELECT
  CASE WHEN l_partkey % 97 = 0 THEN NULL
       ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS ClaimID,
  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE 'M' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS MemberID,
  CASE WHEN l_partkey % 10 = 7 THEN 'U' || CAST(l_suppkey AS VARCHAR) ELSE {_PID} END AS ProviderID,
  CAST(l_shipdate AS DATE) + CAST(CASE
      WHEN l_suppkey % 5 = 4 AND l_partkey % 5 = 0 THEN 400
      WHEN l_suppkey % 5 = 4 AND l_partkey % 5 = 1 THEN -5
      WHEN l_suppkey % 5 = 4 AND l_partkey % 5 = 2 THEN 120
      WHEN l_suppkey % 5 = 4 THEN 20 WHEN l_suppkey % 5 = 3 THEN 12
      WHEN l_suppkey % 5 = 2 THEN 5 WHEN l_suppkey % 5 = 1 THEN 2
      ELSE 0 END + l_linenumber % 3 - 1 AS INTEGER) AS ClaimDate,
  CAST(l_shipdate AS DATE) AS ServiceDate,
  CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(4,2))
       * CAST(l_quantity AS DECIMAL(4,0)) * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS Amount,
  o_orderstatus AS Status,
  CASE WHEN l_partkey % 13 = 0 THEN NULL
       WHEN l_partkey % 4 = 0 THEN 'A' || CAST(l_partkey % 90 AS VARCHAR)
       WHEN l_partkey % 4 = 1 THEN 'A' || CAST(l_partkey % 90 AS VARCHAR) || ';B2'
       WHEN l_partkey % 4 = 2 THEN 'A' || CAST(l_partkey % 90 AS VARCHAR) || ';'
       ELSE 'A1;B2;C3' END AS ICD10Codes,
  CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN '99213' ELSE '99213;80050' END AS CPTCodes,
  CASE WHEN l_returnflag = 'R' THEN 'Inpatient' ELSE 'Outpatient' END AS ClaimType,
  CASE WHEN l_linestatus = 'F' THEN 'Portal' ELSE 'Paper' END AS SubmissionChannel,
  CAST(NULL AS VARCHAR) AS Notes,
  strftime(l_shipdate, {_TS}) AS IngestTimestamp,
  l_shipdate + to_seconds(l_partkey) AS ingestion_timestamp,
  CAST(l_shipdate AS TIMESTAMP) AS OriginalIngestTimestamp
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

_cte("cs", (), """
SELECT
  CASE WHEN event_id % 50 = 0 THEN CAST(event_id AS VARCHAR) || '-1' ELSE 'E' || CAST(event_id AS VARCHAR) END AS ClaimID,
  'M' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS MemberID,
  'P' || CAST((user_id % 10) * 3 AS VARCHAR) AS ProviderID,
  CAST(ts AS DATE) - 8766 AS ClaimDate,
  CAST(CAST(value AS DECIMAL(10,2)) * 20 AS DECIMAL(10,2)) AS Amount,
  event_type AS Status,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'A1;E' || CAST(event_id % 20 AS VARCHAR) END AS ICD10Codes,
  '99213' AS CPTCodes,
  CAST(ts AS TIMESTAMP) AS EventTimestamp,
  TIMESTAMP '2002-01-01 00:00:00' AS ingestion_timestamp
FROM events""")

_cte("mbase", (), """
SELECT c_custkey, c_name, c_mktsegment, r_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

_cte("mb", ("mbase",), """
SELECT
  CASE WHEN c_custkey % 211 = 3 THEN 'M' || CAST(c_custkey % 10 AS VARCHAR)
       ELSE 'M' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS MemberID,
  c_name AS Name,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE DATE '1935-01-01' + CAST(c_custkey * 37 % 23000 AS INTEGER) END AS DOB,
  CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS Gender,
  r_name AS Region,
  c_mktsegment AS PlanType,
  DATE '1998-01-01' + CAST(c_custkey % 700 AS INTEGER) AS EffectiveDate,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'ab@mail.test'
       ELSE lower(c_name) || '@mail.test' END AS Email,
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS IsActive,
  DATE '2000-01-01' + CAST(c_custkey % 200 - 300 * v AS INTEGER) AS LastUpdated
FROM (SELECT *, 0 AS v FROM mbase UNION ALL SELECT *, 1 AS v FROM mbase WHERE c_custkey % 5 = 0)""")

_cte("pids", (), f"""
SELECT DISTINCT {_PID} AS ProviderID, l_suppkey
FROM lineitem""")

_cte("pbase", ("pids",), """
SELECT p.ProviderID, s.s_suppkey, s.s_name, s.s_acctbal, n.n_name
FROM pids p JOIN supplier s ON p.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""")

_LOC = "STRUCT(Address VARCHAR, City VARCHAR, State VARCHAR)"
_cte("pb", ("pbase",), f"""
SELECT
  ProviderID,
  CASE WHEN s_suppkey % 37 = 5 THEN NULL ELSE s_name END AS Name,
  CASE s_suppkey % 4 WHEN 0 THEN CAST(NULL AS VARCHAR[]) WHEN 1 THEN ['Cardiology']
       WHEN 2 THEN [' Cardiology ', 'Oncology'] ELSE ['Radiology', 'Oncology', 'ENT'] END AS Specialties,
  CASE (s_suppkey // 3) % 3
       WHEN 0 THEN CAST([] AS {_LOC}[])
       WHEN 1 THEN [CAST({{'Address': '1 Main', 'City': n_name, 'State': ' tx'}} AS {_LOC})]
       ELSE [CAST({{'Address': '1 Main', 'City': n_name, 'State': ' tx'}} AS {_LOC}),
             CAST({{'Address': '2 Side', 'City': CAST(NULL AS VARCHAR), 'State': 'Ca '}} AS {_LOC})] END AS Locations,
  (s_acctbal > 0 AND v = 0) AS IsActive,
  lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS TIN,
  DATE '1999-01-01' + CAST(s_suppkey % 365 - 400 * v AS INTEGER) AS LastVerified
FROM (SELECT *, 0 AS v FROM pbase UNION ALL SELECT *, 1 AS v FROM pbase WHERE s_suppkey % 4 = 1)""")

_cte("db", (), """
SELECT
  CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN upper(p_brand)
       WHEN p_partkey % 3 = 1 THEN ' ' || lower(p_brand) ELSE p_brand END AS Code,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE ' ' || p_name END AS Description
FROM part""")

# --- silver -------------------------------------------------------------------
_cte("cu", ("cb", "cs"), """
SELECT ClaimID AS claim_id, MemberID AS member_id, ProviderID AS provider_id, Amount AS claim_amount,
       ClaimDate AS claim_date, ServiceDate AS service_date, Status AS status, ICD10Codes AS icd10_codes,
       CPTCodes AS cpt_codes, ClaimType AS claim_type, SubmissionChannel AS submission_channel, Notes AS notes,
       OriginalIngestTimestamp AS original_ingest_timestamp, ingestion_timestamp, 'batch' AS source_type
FROM cb
UNION ALL
SELECT ClaimID, MemberID, ProviderID, Amount, ClaimDate, ClaimDate, Status, ICD10Codes, CPTCodes,
       'Outpatient', 'API', CAST(NULL AS VARCHAR), EventTimestamp, ingestion_timestamp, 'streaming'
FROM cs""")

_cte("cf", ("cu",), """
SELECT *,
  CASE WHEN icd10_codes IS NOT NULL THEN string_split(icd10_codes, ';') ELSE CAST([] AS VARCHAR[]) END AS icd10_codes_array,
  CASE WHEN cpt_codes IS NOT NULL THEN string_split(cpt_codes, ';') ELSE CAST([] AS VARCHAR[]) END AS cpt_codes_array,
  claim_amount > 5000 AS is_high_value_claim,
  (CASE WHEN icd10_codes IS NOT NULL THEN len(string_split(icd10_codes, ';')) ELSE 0 END) > 1 AS has_multiple_diagnoses,
  (CASE WHEN cpt_codes IS NOT NULL THEN len(string_split(cpt_codes, ';')) ELSE 0 END) > 1 AS has_multiple_procedures,
  CAST(date_diff('day', service_date, claim_date) AS INTEGER) AS days_to_claim,
  CASE WHEN claim_amount > 50000 THEN false
       WHEN date_diff('day', service_date, claim_date) < 0 THEN false
       WHEN date_diff('day', service_date, claim_date) > 365 THEN false
       WHEN icd10_codes IS NULL THEN false
       ELSE true END AS is_valid_claim
FROM cu""")

_cte("cd", ("cf",), """
SELECT * FROM cf
QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY ingestion_timestamp DESC NULLS LAST,
  source_type ASC NULLS LAST, claim_date ASC NULLS LAST, service_date ASC NULLS LAST,
  claim_amount ASC NULLS LAST, member_id ASC NULLS LAST, provider_id ASC NULLS LAST) = 1""")

_cte("cp", ("cd",), f"""
SELECT * FROM cd
WHERE claim_id IS NOT NULL AND member_id IS NOT NULL AND provider_id IS NOT NULL
  AND claim_amount > 0 AND service_date IS NOT NULL AND service_date <= {AS_OF}""")

_cte("mf", ("mb",), f"""
SELECT *,
  CASE WHEN Email IS NOT NULL THEN regexp_replace(Email, '(.{{3}}).*@', '\\1***@') END AS masked_email,
  CASE WHEN DOB IS NOT NULL THEN CAST(floor(CAST(date_diff('day', DOB, {AS_OF}) AS DOUBLE) / 365.25::DOUBLE) AS BIGINT) END AS age,
  CASE WHEN IsActive = 1.0 THEN true WHEN IsActive = 0.0 THEN false END AS is_active_member,
  (Name IS NOT NULL AND DOB IS NOT NULL AND Gender IS NOT NULL AND Email IS NOT NULL) AS has_complete_profile
FROM mb""")

_cte("md", ("mf",), """
SELECT * FROM mf
QUALIFY row_number() OVER (PARTITION BY MemberID ORDER BY LastUpdated DESC NULLS LAST,
  Name ASC NULLS LAST, DOB ASC NULLS LAST, Gender ASC NULLS LAST, Region ASC NULLS LAST,
  PlanType ASC NULLS LAST, EffectiveDate ASC NULLS LAST, Email ASC NULLS LAST, IsActive ASC NULLS LAST) = 1""")

_cte("mp", ("md",), "SELECT * FROM md WHERE MemberID IS NOT NULL AND length(MemberID) >= 5")

_cte("pd", ("pb",), """
SELECT * FROM pb
QUALIFY row_number() OVER (PARTITION BY ProviderID ORDER BY LastVerified DESC NULLS LAST,
  Name ASC NULLS LAST, IsActive ASC NULLS LAST, TIN ASC NULLS LAST) = 1""")

_cte("pn", ("pd",), f"""
SELECT
  ProviderID AS provider_id, Name AS provider_name, specialty,
  struct_extract(location, 'Address') AS address, struct_extract(location, 'City') AS city,
  struct_extract(location, 'State') AS state, IsActive AS is_active, TIN AS tin, LastVerified AS last_verified,
  CASE WHEN struct_extract(location, 'State') IS NOT NULL THEN upper(trim(struct_extract(location, 'State'))) END AS state_standardized,
  CASE WHEN specialty IS NOT NULL THEN trim(specialty) END AS specialty_standardized,
  (struct_extract(location, 'Address') IS NOT NULL AND struct_extract(location, 'City') IS NOT NULL
   AND struct_extract(location, 'State') IS NOT NULL) AS has_complete_address
FROM (
  SELECT *, unnest(CASE WHEN len(Locations) > 0 THEN Locations ELSE [CAST(NULL AS {_LOC})] END) AS location
  FROM (SELECT *, unnest(CASE WHEN len(Specialties) > 0 THEN Specialties ELSE [CAST(NULL AS VARCHAR)] END) AS specialty
        FROM pd))""")

_cte("pp", ("pn",), "SELECT * FROM pn WHERE provider_id IS NOT NULL AND provider_name IS NOT NULL")

_cte("dd", ("db",), """
SELECT *, upper(trim(Code)) AS code_standardized, trim(Description) AS description_clean FROM db
QUALIFY row_number() OVER (PARTITION BY Code ORDER BY Description ASC NULLS LAST) = 1""")

_cte("dp", ("dd",), "SELECT * FROM dd WHERE Code IS NOT NULL AND Description IS NOT NULL")

# --- gold ---------------------------------------------------------------------
_cte("ps", ("cp",), f"""
SELECT provider_id,
  {_dec_avg_micro('claim_amount')} AS avg_micro,
  {_dec_avg('claim_amount')} AS avg_claim_amount,
  count(claim_id) AS total_claims,
  count(DISTINCT member_id) AS unique_members,
  max(claim_date) AS last_claim_date,
  sum(claim_amount) AS total_claim_value,
  {_dbl_avg('days_to_claim')} AS avg_processing_days
FROM cp GROUP BY provider_id""")

_cte("ms", ("cp",), """
SELECT member_id, count(claim_id) AS member_claim_frequency, sum(claim_amount) AS member_total_claims,
       max(claim_date) AS member_last_claim
FROM cp GROUP BY member_id""")

_cte("psum", ("pp",), """
SELECT provider_id, provider_name, first(is_active) AS provider_is_active, count(specialty) AS specialty_count,
       count(address) AS location_count, max(last_verified) AS last_verified
FROM pp GROUP BY provider_id, provider_name""")

_cte("ce", ("cp", "mp", "psum", "ps", "ms"), """
SELECT c.*, m.age, m.is_active_member, m.Gender, m.Region, m.PlanType, m.has_complete_profile,
  s.provider_name, s.provider_is_active, s.specialty_count, s.location_count, s.last_verified,
  st.avg_micro, st.avg_claim_amount, st.total_claims, st.unique_members, st.last_claim_date,
  st.total_claim_value, st.avg_processing_days,
  x.member_claim_frequency, x.member_total_claims, x.member_last_claim,
  CASE WHEN st.total_claims > 100 THEN 0.9::DOUBLE WHEN st.total_claims > 50 THEN 0.7::DOUBLE
       WHEN st.total_claims > 10 THEN 0.5::DOUBLE ELSE 0.3::DOUBLE END AS provider_reputation_score,
  CASE WHEN st.avg_processing_days <= 1 THEN 100 WHEN st.avg_processing_days <= 7 THEN 80
       WHEN st.avg_processing_days <= 30 THEN 60 ELSE 40 END AS claim_efficiency_score
FROM cp c
LEFT JOIN mp m ON c.member_id = m.MemberID
LEFT JOIN psum s ON c.provider_id = s.provider_id
LEFT JOIN ps st ON c.provider_id = st.provider_id
LEFT JOIN ms x ON c.member_id = x.member_id""")

_cte("ca0", ("ce",), """
SELECT *,
  CAST(claim_amount * 100 AS HUGEINT) * 10000 AS a_micro,
  CAST(date_diff('day', service_date, claim_date) AS INTEGER) AS days_diff
FROM ce""")

_cte("ca1", ("ca0",), """
SELECT *,
  CASE WHEN avg_micro > 0 THEN CAST((2 * abs(a_micro - avg_micro) * 1000000 + avg_micro) // (2 * avg_micro) AS DOUBLE) / 1000000.0
       ELSE 0.0 END AS amount_deviation,
  CASE WHEN avg_micro > 0 AND abs(a_micro - avg_micro) > 2 * avg_micro THEN 30
       WHEN avg_micro > 0 AND abs(a_micro - avg_micro) > avg_micro THEN 15 ELSE 0 END AS amount_score,
  CASE WHEN days_diff < 0 THEN 25 WHEN days_diff > 365 THEN 20 WHEN days_diff > 90 THEN 10 ELSE 0 END AS timing_score,
  CASE WHEN provider_reputation_score < 0.5 THEN 25 WHEN provider_reputation_score < 0.7 THEN 15 ELSE 0 END AS provider_score,
  CASE WHEN member_claim_frequency > 10 THEN 20 WHEN member_claim_frequency > 5 THEN 10 ELSE 0 END AS volume_score
FROM ca0""")

_cte("ca2", ("ca1",), """
SELECT *, least(CAST(amount_score + timing_score + provider_score + volume_score AS DOUBLE), 100.0::DOUBLE) AS fraud_risk_score
FROM ca1""")

_cte("ca", ("ca2",), """
SELECT *,
  CASE WHEN fraud_risk_score >= 70 THEN 'HIGH' WHEN fraud_risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category,
  CASE WHEN fraud_risk_score >= 70 AND claim_amount > 10000 THEN 'URGENT' WHEN fraud_risk_score >= 70 THEN 'HIGH'
       WHEN fraud_risk_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS investigation_priority
FROM ca2""")

_cte("mcs", ("ca",), f"""
SELECT strftime(service_date, '%Y-%m') AS claim_month,
  CAST(year(service_date) AS BIGINT) AS claim_year,
  CAST(year(service_date) AS VARCHAR) || '-Q' || CAST(quarter(service_date) AS VARCHAR) AS claim_quarter,
  provider_name, risk_category,
  CAST(sum(claim_amount) AS DOUBLE) AS total_amount,
  count(claim_id) AS claim_count,
  {_dbl_avg('fraud_risk_score')} AS avg_fraud_score,
  count(DISTINCT member_id) AS unique_members,
  {_count_when("investigation_priority = 'URGENT'")} AS urgent_cases,
  {_count_when("investigation_priority = 'HIGH'")} AS high_priority_cases,
  {_dec_avg('claim_amount')} AS avg_claim_amount,
  CAST(max(claim_amount) AS DOUBLE) AS max_claim_amount,
  {_count_when('is_high_value_claim')} AS high_value_claim_count
FROM ca
GROUP BY 1, 2, 3, provider_name, risk_category""")

_cte("pm", ("ca",), f"""
SELECT provider_id, provider_name,
  count(claim_id) AS total_claims,
  sum(claim_amount) AS total_claim_value,
  {_dec_avg('claim_amount')} AS avg_claim_amount,
  count(DISTINCT member_id) AS unique_members_served,
  {_dbl_avg('fraud_risk_score')} AS avg_fraud_risk,
  {_count_when("risk_category = 'HIGH'")} AS high_risk_claims,
  {_count_when("risk_category = 'MEDIUM'")} AS medium_risk_claims,
  {_count_when("risk_category = 'LOW'")} AS low_risk_claims,
  {_dbl_avg('days_to_claim')} AS avg_claim_processing_days,
  first(provider_reputation_score) AS reputation_score,
  first(specialty_count) AS specialty_count,
  first(location_count) AS location_count,
  max(service_date) AS last_service_date,
  min(service_date) AS first_service_date
FROM ca GROUP BY provider_id, provider_name""")

_TIE = "provider_id ASC NULLS FIRST, provider_name ASC NULLS FIRST"
_cte("pperf0", ("pm",), f"""
SELECT *,
  row_number() OVER (ORDER BY total_claim_value DESC NULLS LAST, {_TIE}) AS value_rank,
  row_number() OVER (ORDER BY avg_fraud_risk ASC NULLS FIRST, {_TIE}) AS fraud_risk_rank,
  row_number() OVER (ORDER BY total_claims DESC NULLS LAST, {_TIE}) AS volume_rank,
  {_spark_round('CAST(high_risk_claims AS DOUBLE) / CAST(total_claims AS DOUBLE) * 100', 2)} AS high_risk_percentage,
  CASE WHEN avg_claim_processing_days <= 1 THEN 100 WHEN avg_claim_processing_days <= 3 THEN 90
       WHEN avg_claim_processing_days <= 7 THEN 75 WHEN avg_claim_processing_days <= 14 THEN 60
       ELSE 40 END AS efficiency_score
FROM pm""")

_cte("pperf", ("pperf0",), f"""
SELECT *,
  {_spark_round('reputation_score * 40 + CAST(efficiency_score * 30 AS DOUBLE) + (100 - high_risk_percentage) * 30', 2)}
    AS overall_provider_score
FROM pperf0""")

_cte("mrp0", ("ca",), f"""
SELECT member_id,
  first(age) AS member_age, first(Gender) AS member_gender, first(Region) AS member_region,
  first(PlanType) AS plan_type, first(is_active_member) AS is_active,
  count(claim_id) AS total_claims,
  sum(claim_amount) AS total_claim_amount,
  {_dec_avg('claim_amount')} AS avg_claim_amount,
  max(claim_amount) AS max_claim_amount,
  count(DISTINCT provider_id) AS unique_providers,
  {_dbl_avg('fraud_risk_score')} AS avg_fraud_risk,
  {_count_when("risk_category = 'HIGH'")} AS high_risk_claims,
  {_count_when('is_high_value_claim')} AS high_value_claims,
  {_dbl_avg('len(icd10_codes_array)')} AS avg_diagnoses_per_claim,
  {_dbl_avg('len(cpt_codes_array)')} AS avg_procedures_per_claim,
  {_dbl_avg('days_to_claim')} AS avg_claim_submission_days,
  max(service_date) AS last_service_date,
  min(service_date) AS first_service_date
FROM ca GROUP BY member_id""")

_cte("mrp", ("mrp0",), """
SELECT *,
  CASE WHEN avg_fraud_risk >= 70 THEN 'HIGH_RISK' WHEN avg_fraud_risk >= 40 THEN 'MEDIUM_RISK'
       WHEN total_claims > 20 THEN 'HIGH_UTILIZATION' ELSE 'LOW_RISK' END AS member_risk_tier,
  COALESCE(total_claim_amount > 50000 OR high_risk_claims > 0 OR total_claims > 15, false) AS needs_case_management
FROM mrp0""")


def _with(final: str, *roots: str) -> str:
    """Prefix ``final`` with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in _CTES[name][0]:
            visit(dep)
        order.append(name)

    for r in roots:
        visit(r)
    body = ",\n".join(f"{n} AS ({_CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{final}"


# --- output projections (mirror queries.comparable) ---------------------------

def _codes(col: str) -> str:
    return f"array_to_string({col}, '|')"


_CLAIM_BASE = f"""
  claim_id, member_id, provider_id, CAST(claim_amount AS DOUBLE) AS claim_amount, claim_date, service_date,
  status, icd10_codes, cpt_codes, claim_type, submission_channel, notes,
  strftime(original_ingest_timestamp, {_TS}) AS original_ingest_timestamp,
  strftime(ingestion_timestamp, {_TS}) AS ingestion_timestamp, source_type"""

_CLAIM_FLAGS = f"""{_CLAIM_BASE},
  {_codes('icd10_codes_array')} AS icd10_codes_array, {_codes('cpt_codes_array')} AS cpt_codes_array,
  is_high_value_claim, has_multiple_diagnoses, has_multiple_procedures,
  CAST(days_to_claim AS BIGINT) AS days_to_claim, is_valid_claim"""

_MEMBER_OUT = """
  MemberID, Name, DOB, Gender, Region, PlanType, EffectiveDate, Email, IsActive, LastUpdated,
  masked_email, age, is_active_member, has_complete_profile"""

_PROVIDER_OUT = """
  provider_id, provider_name, specialty, address, city, state, is_active, tin, last_verified,
  state_standardized, specialty_standardized, has_complete_address"""

_LOC_TEXT = ("array_to_string(list_transform(Locations, lambda x: concat_ws('/', "
             "coalesce(struct_extract(x, 'Address'), '~'), coalesce(struct_extract(x, 'City'), '~'), "
             "coalesce(struct_extract(x, 'State'), '~'))), '|')")

_ENRICHED_OUT = f"""{_CLAIM_FLAGS},
  CAST(age AS BIGINT) AS age, is_active_member, Gender, Region, PlanType, has_complete_profile,
  provider_name, provider_is_active, CAST(specialty_count AS BIGINT) AS specialty_count,
  CAST(location_count AS BIGINT) AS location_count, last_verified,
  avg_claim_amount, total_claims, unique_members, last_claim_date,
  CAST(total_claim_value AS DOUBLE) AS total_claim_value, avg_processing_days,
  member_claim_frequency, CAST(member_total_claims AS DOUBLE) AS member_total_claims, member_last_claim,
  provider_reputation_score, CAST(claim_efficiency_score AS BIGINT) AS claim_efficiency_score"""


def _metrics(dataset: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    """Per-rule failure counts; ``rules`` = (name, spark predicate text, duckdb predicate)."""
    all_ok = " AND ".join(f"COALESCE({d}, false)" for _, _, d in rules)
    parts = []
    for name, spark_text, duck in rules:
        spark_sql = spark_text.replace("'", "''")
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{name}' AS rule, '{spark_sql}' AS predicate, "
            f"CAST(count(*) FILTER (WHERE NOT COALESCE({duck}, false)) AS BIGINT) AS failed_records, "
            f"CAST(count(*) AS BIGINT) AS total_records, "
            f"CAST(count(*) FILTER (WHERE {all_ok}) AS BIGINT) AS passed_records FROM {source}")
    return "\nUNION ALL\n".join(parts)


_SERVICE_RULE_SPARK = f"service_date IS NOT NULL AND service_date <= {AS_OF_SPARK_TEXT}"
_CLAIM_RULES = [
    ("valid_claim_id", "claim_id IS NOT NULL", "claim_id IS NOT NULL"),
    ("valid_member_id", "member_id IS NOT NULL", "member_id IS NOT NULL"),
    ("valid_provider_id", "provider_id IS NOT NULL", "provider_id IS NOT NULL"),
    ("positive_amount", "claim_amount > 0", "claim_amount > 0"),
    ("valid_service_date", _SERVICE_RULE_SPARK, f"service_date IS NOT NULL AND service_date <= {AS_OF}"),
]
_MEMBER_RULES = [
    ("valid_member_id", "MemberID IS NOT NULL", "MemberID IS NOT NULL"),
    ("member_id_length", "length(MemberID) >= 5", "length(MemberID) >= 5"),
]
_PROVIDER_RULES = [
    ("valid_provider_id", "provider_id IS NOT NULL", "provider_id IS NOT NULL"),
    ("valid_provider_name", "provider_name IS NOT NULL", "provider_name IS NOT NULL"),
]
_DIAGNOSIS_RULES = [
    ("valid_diagnosis_code", "Code IS NOT NULL", "Code IS NOT NULL"),
    ("valid_diagnosis_description", "Description IS NOT NULL", "Description IS NOT NULL"),
]


def _dq_summary() -> str:
    return f"""
SELECT 'claims' AS table_name, count(*) AS total_records, {_count_when('is_valid_claim')} AS valid_records,
       {_count_when('is_high_value_claim')} AS high_value_claims FROM cp
UNION ALL
SELECT 'members', count(*), {_count_when('has_complete_profile')}, {_count_when('is_active_member')} FROM mp
UNION ALL
SELECT 'providers', count(*), {_count_when('has_complete_address')}, {_count_when('is_active')} FROM pp"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ingest_claims_csv_stream"] = _with(f"""
SELECT ClaimID, MemberID, ProviderID, ClaimDate, ServiceDate, CAST(Amount AS DOUBLE) AS Amount, Status,
       ICD10Codes, CPTCodes, ClaimType, SubmissionChannel, Notes, IngestTimestamp,
       strftime(OriginalIngestTimestamp, {_TS}) AS OriginalIngestTimestamp
FROM cb""", "cb")
    q["ingest_claims_json_stream"] = _with(f"""
SELECT ClaimID, MemberID, ProviderID, ClaimDate, CAST(Amount AS DOUBLE) AS Amount, Status, ICD10Codes, CPTCodes,
       strftime(EventTimestamp, {_TS}) AS EventTimestamp
FROM cs""", "cs")
    q["ingest_members_csv"] = _with("""
SELECT MemberID, Name, DOB, Gender, Region, PlanType, EffectiveDate, Email, IsActive, LastUpdated FROM mb""", "mb")
    q["ingest_providers_json"] = _with(f"""
SELECT ProviderID, Name, {_codes('Specialties')} AS Specialties, {_LOC_TEXT} AS Locations,
       IsActive, TIN, LastVerified FROM pb""", "pb")
    q["ingest_diagnosis_csv"] = _with("SELECT Code, Description FROM db", "db")
    q["stream_ingest_idempotent"] = _with("""
SELECT count(*) AS total_rows, count(DISTINCT ClaimID) AS distinct_claims,
       CAST(sum(Amount) AS DOUBLE) AS total_amount, count(*) AS first_run_rows,
       CAST(0 AS BIGINT) AS second_run_rows
FROM cs""", "cs")
    q["claims_union"] = _with(f"SELECT {_CLAIM_BASE} FROM cu", "cu")
    q["claims_rules"] = _with(f"SELECT {_CLAIM_FLAGS} FROM cf", "cf")
    q["claims_dedup"] = _with(f"SELECT {_CLAIM_FLAGS} FROM cd", "cd")
    q["claims_processed"] = _with(f"SELECT {_CLAIM_FLAGS} FROM cp", "cp")
    q["sql_select_claims"] = q["claims_processed"]
    q["members_dedup"] = _with(f"SELECT {_MEMBER_OUT} FROM md", "md")
    q["members_processed"] = _with(f"SELECT {_MEMBER_OUT} FROM mp", "mp")
    q["mask_email"] = _with("""
SELECT MemberID, Email,
  CASE WHEN Email IS NOT NULL THEN regexp_replace(Email, '(.{3}).*@', '\\1***@') END AS masked_email,
  CASE WHEN Email IS NOT NULL THEN regexp_replace(Email, '^(.{0,3}).*@', '\\1***@') END AS masked_email_strict
FROM mb""", "mb")
    q["providers_dedup"] = _with(f"""
SELECT ProviderID, Name, {_codes('Specialties')} AS Specialties, {_LOC_TEXT} AS Locations,
       IsActive, TIN, LastVerified FROM pd""", "pd")
    q["providers_normalized"] = _with(f"SELECT {_PROVIDER_OUT} FROM pn", "pn")
    q["providers_processed"] = _with(f"SELECT {_PROVIDER_OUT} FROM pp", "pp")
    q["diagnosis_processed"] = _with(
        "SELECT Code, Description, code_standardized, description_clean FROM dp", "dp")
    q["expectation_metrics"] = _with(
        "\nUNION ALL\n".join([
            _metrics("claims_processed", "cd", _CLAIM_RULES),
            _metrics("members_processed", "md", _MEMBER_RULES),
            _metrics("providers_processed", "pn", _PROVIDER_RULES),
            _metrics("diagnosis_reference_processed", "dd", _DIAGNOSIS_RULES),
        ]), "cd", "md", "pn", "dd")
    q["data_quality_summary"] = _with(_dq_summary(), "cp", "mp", "pp")
    q["provider_stats"] = _with("""
SELECT provider_id, avg_claim_amount, total_claims, unique_members, last_claim_date,
       CAST(total_claim_value AS DOUBLE) AS total_claim_value, avg_processing_days FROM ps""", "ps")
    q["member_stats"] = _with("""
SELECT member_id, member_claim_frequency, CAST(member_total_claims AS DOUBLE) AS member_total_claims,
       member_last_claim FROM ms""", "ms")
    q["provider_summary"] = _with("""
SELECT provider_id, provider_name, provider_is_active, CAST(specialty_count AS BIGINT) AS specialty_count,
       CAST(location_count AS BIGINT) AS location_count, last_verified FROM psum""", "psum")
    q["claims_enriched"] = _with(f"SELECT {_ENRICHED_OUT} FROM ce", "ce")
    q["claims_enriched_bucketed"] = q["claims_enriched"]
    q["fraud_score"] = _with("""
SELECT claim_id, member_id, provider_id, CAST(claim_amount AS DOUBLE) AS claim_amount, avg_claim_amount,
       provider_reputation_score, member_claim_frequency, amount_deviation,
       CAST(amount_score AS BIGINT) AS amount_score, CAST(days_diff AS BIGINT) AS days_diff,
       CAST(timing_score AS BIGINT) AS timing_score, CAST(provider_score AS BIGINT) AS provider_score,
       CAST(volume_score AS BIGINT) AS volume_score, fraud_risk_score, risk_category, investigation_priority
FROM ca""", "ca")
    q["monthly_claims_summary"] = _with("SELECT * FROM mcs", "mcs")
    q["monthly_summary_positions"] = _with(
        "SELECT *, row_number() OVER (ORDER BY claim_month NULLS FIRST, provider_name NULLS FIRST, "
        "risk_category NULLS FIRST) AS position FROM mcs", "mcs")
    periods = {"month": "strftime(service_date, '%Y-%m')", "year": "CAST(year(service_date) AS VARCHAR)",
               "quarter": "CAST(year(service_date) AS VARCHAR) || '-Q' || CAST(quarter(service_date) AS VARCHAR)"}
    q["distinct_rollups"] = _with("""
SELECT 'month_provider' AS rollup, claim_month AS period, provider_name AS provider, risk_category,
       CAST(NULL AS VARCHAR) AS member, unique_members AS distinct_count FROM mcs
UNION ALL SELECT 'provider', NULL, provider_id, NULL, NULL, count(DISTINCT member_id) FROM ca GROUP BY provider_id
UNION ALL SELECT 'member', NULL, NULL, NULL, member_id, count(DISTINCT provider_id) FROM ca GROUP BY member_id""" + "".join(
        f"\nUNION ALL SELECT '{name}', {period}, NULL, risk_category, NULL, count(DISTINCT member_id) FROM ca "
        f"GROUP BY {period}, risk_category" for name, period in periods.items()), "ca", "mcs")
    q["provider_performance"] = _with("""
SELECT provider_id, provider_name, total_claims, CAST(total_claim_value AS DOUBLE) AS total_claim_value,
       avg_claim_amount, unique_members_served, avg_fraud_risk, high_risk_claims, medium_risk_claims,
       low_risk_claims, avg_claim_processing_days, reputation_score, CAST(specialty_count AS BIGINT) AS specialty_count,
       CAST(location_count AS BIGINT) AS location_count, last_service_date, first_service_date,
       CAST(value_rank AS BIGINT) AS value_rank, CAST(fraud_risk_rank AS BIGINT) AS fraud_risk_rank,
       CAST(volume_rank AS BIGINT) AS volume_rank, high_risk_percentage,
       CAST(efficiency_score AS BIGINT) AS efficiency_score, overall_provider_score
FROM pperf""", "pperf")
    q["member_risk_profile"] = _with("""
SELECT member_id, CAST(member_age AS BIGINT) AS member_age, member_gender, member_region, plan_type, is_active,
       total_claims, CAST(total_claim_amount AS DOUBLE) AS total_claim_amount, avg_claim_amount,
       CAST(max_claim_amount AS DOUBLE) AS max_claim_amount, unique_providers, avg_fraud_risk,
       high_risk_claims, high_value_claims, avg_diagnoses_per_claim, avg_procedures_per_claim,
       avg_claim_submission_days, last_service_date, first_service_date, member_risk_tier, needs_case_management
FROM mrp""", "mrp")
    q["global_rank"] = _with("""
SELECT claim_id, provider_id, CAST(claim_amount AS DOUBLE) AS claim_amount,
       CAST(row_number() OVER (ORDER BY claim_amount DESC NULLS LAST, claim_id ASC NULLS FIRST) AS BIGINT) AS amount_rank
FROM cp""", "cp")
    datasets = [  # name, rows, content figure, tier
        ("claims_batch", "cb", "sum(Amount)", "bronze"),
        ("claims_stream", "cs", "sum(Amount)", "bronze"),
        ("members", "mb", "sum(IsActive)", "bronze"),
        ("providers", "pb", "sum(len(Locations))", "bronze"),
        ("diagnosis_reference", "db", "sum(length(Code))", "bronze"),
        ("claims_processed", "cp", "sum(claim_amount)", "silver"),
        ("members_processed", "mp", "sum(age)", "silver"),
        ("providers_processed", "pp", "count(specialty)", "silver"),
        ("diagnosis_reference_processed", "dp", "sum(length(code_standardized))", "silver"),
        ("data_quality_summary", f"({_dq_summary()})", "sum(valid_records)", None),
        ("claims_analytics", "ca", "sum(fraud_risk_score)", "gold"),
        ("claims_summary", "mcs", "sum(claim_count)", "gold"),
        ("provider_performance", "pperf", "sum(value_rank + total_claims)", "gold"),
        ("member_risk_profile", "mrp", "sum(total_claims)", "gold"),
    ]
    q["medallion_end_to_end"] = _with("\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS row_count, CAST({content} AS DOUBLE) AS content, "
        f"{'CAST(NULL AS BIGINT)' if name == 'claims_summary' else 'count(*)'} AS with_clock, "
        f"{repr(tier) if tier else 'CAST(NULL AS VARCHAR)'} AS tier, true AS comment_kept FROM {rows}"
        for name, rows, content, tier in datasets),
        "cb", "cs", "mb", "pb", "db", "cp", "mp", "pp", "dp", "ca", "mcs", "pperf", "mrp").replace(
            # files that are ingested together have one load time, before the event feed's
            "l_shipdate + to_seconds(l_partkey) AS ingestion_timestamp",
            "TIMESTAMP '2001-01-01 00:00:00' AS ingestion_timestamp")
    q["expectation_quarantine"] = q["expectation_metrics"]
    q["sql_fraud_score"] = q["fraud_score"]
    q["bronze_file_audit"] = _with("\nUNION ALL ".join(
        f"SELECT '{source}' AS source, count(*) AS file_rows, count(*) AS bronze_rows, CAST(0 AS BIGINT) AS files_missing, "
        f"CAST(0 AS BIGINT) AS files_doubled, CAST(0 AS BIGINT) AS files_unknown, true AS all_ok FROM {rows}"
        for source, rows in (("claims_batch", "cb"), ("claims_stream", "cs"), ("members", "mb"), ("providers", "pb"),
                             ("diagnosis_reference", "db"))), "cb", "cs", "mb", "pb", "db")
    # in steps or at once: the rows are the same
    q["claims_incremental"] = q["claims_processed"]
    q["provider_stats_incremental"] = q["provider_stats"]
    q["member_stats_incremental"] = q["member_stats"]
    q["claims_optional_feed"] = _with("""
SELECT 'with feed' AS run, source_type, count(*) AS row_count FROM cu GROUP BY source_type
UNION ALL SELECT 'without feed', 'batch', count(*) FROM cb""", "cu", "cb")
    q["bronze_lineage"] = _with("\nUNION ALL ".join(
        f"SELECT '{source}' AS source, count(*) AS row_count, count(*) AS with_file, count(*) AS with_time, "
        f"count(*) > 0 AS has_files FROM {rows}"
        for source, rows in (("claims_batch", "cb"), ("claims_stream", "cs"), ("members", "mb"), ("providers", "pb"),
                             ("diagnosis_reference", "db"))), "cb", "cs", "mb", "pb", "db")
    q["bronze_malformed_dates"] = _with(f"""
SELECT 'members' AS source, MemberID AS id,
       CASE WHEN ascii(Region) % 3 < 2 THEN NULL ELSE CAST(DOB AS VARCHAR) END AS parsed FROM mb
UNION ALL SELECT 'claims_stream', ClaimID,
       CASE WHEN Status = 'click' THEN NULL ELSE strftime(EventTimestamp, {_TS}) END FROM cs""", "mb", "cs")
    return q
