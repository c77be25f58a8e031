"""Silver layer: canonical, cleaned, de-duplicated tables.

Every function takes bronze DataFrames and returns a lazy DataFrame; the
pipeline decides whether to materialise it.  The newest row per key is kept
first and columns are derived from the rows that stay: the derived columns
depend on their own row alone, so the result is the published one, and only
canonical columns go through the shuffle.  The expectations apply to what
survives (an invalid newest row removes the key; an older valid row does not
take its place).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions import rules as R
from claimwright.operators.dedup import keep_first, latest_first
from claimwright.operators.expectations import expect_all_or_drop

# --- fixed values ---------------------------------------------------------
HIGH_VALUE_AMOUNT = 5000
SUSPICIOUS_AMOUNT = 50000
MAX_DAYS_TO_CLAIM = 365
STREAM_CLAIM_TYPE = "Outpatient"
STREAM_CHANNEL = "API"
# --- end of fixed values --------------------------------------------------

# Tie-breaks that make every "newest row" choice deterministic when the
# ordering column ties (e.g. rows of one micro-batch share its timestamp).
CLAIM_TIE_BREAK = ("source_type", "claim_date", "service_date", "claim_amount", "member_id",
                   "provider_id", "status", "icd10_codes", "cpt_codes", "claim_type",
                   "submission_channel", "original_ingest_timestamp", "source_file")
MEMBER_TIE_BREAK = ("Name", "DOB", "Gender", "Region", "PlanType", "EffectiveDate",
                    "Email", "IsActive", "source_file")
PROVIDER_TIE_BREAK = ("Name", "IsActive", "TIN", "source_file")
DIAGNOSIS_TIE_BREAK = ("Description", "source_file")


def as_of_column(as_of: str | _dt.date | None) -> Column:
    """The evaluation date: a fixed date, or the session's current date."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date")


def _as_of_sql(as_of: str | _dt.date | None) -> str:
    return "current_date()" if as_of is None else f"DATE'{as_of}'"


# --- claims -----------------------------------------------------------------

def claims_rules(as_of: str | _dt.date | None = None) -> dict[str, str]:
    return {
        "valid_claim_id": "claim_id IS NOT NULL",
        "valid_member_id": "member_id IS NOT NULL",
        "valid_provider_id": "provider_id IS NOT NULL",
        "positive_amount": "claim_amount > 0",
        "valid_service_date": f"service_date IS NOT NULL AND service_date <= {_as_of_sql(as_of)}",
    }


# --- fixed values: published claim columns <- source fields ----------------
# (None: the feed has no such field; a constant or NULL is used instead)
BATCH_CLAIM_FIELDS = {
    "claim_id": "ClaimID", "member_id": "MemberID", "provider_id": "ProviderID",
    "claim_amount": "Amount", "claim_date": "ClaimDate", "service_date": "ServiceDate",
    "status": "Status", "icd10_codes": "ICD10Codes", "cpt_codes": "CPTCodes",
    "claim_type": "ClaimType", "submission_channel": "SubmissionChannel", "notes": "Notes",
    "original_ingest_timestamp": "OriginalIngestTimestamp",
    "ingestion_timestamp": "ingestion_timestamp", "source_file": "source_file",
}
STREAM_CLAIM_FIELDS = {
    "claim_id": "ClaimID", "member_id": "MemberID", "provider_id": "ProviderID",
    "claim_amount": "Amount", "claim_date": "ClaimDate", "service_date": "ClaimDate",
    "status": "Status", "icd10_codes": "ICD10Codes", "cpt_codes": "CPTCodes",
    "claim_type": None, "submission_channel": None, "notes": None,
    "original_ingest_timestamp": "EventTimestamp",
    "ingestion_timestamp": "ingestion_timestamp", "source_file": "source_file",
}
# --- end of fixed values ------------------------------------------------------


def _canonical(df: DataFrame, fields: dict[str, str | None], constants: dict[str, Column],
               source_type: str) -> DataFrame:
    cols = [F.col(src).alias(name) if src is not None else constants[name].alias(name)
            for name, src in fields.items()]
    return df.select(*cols, F.lit(source_type).alias("source_type"))


def standardize_batch_claims(batch: DataFrame) -> DataFrame:
    return _canonical(batch, BATCH_CLAIM_FIELDS, {}, "batch")


def standardize_stream_claims(stream: DataFrame) -> DataFrame:
    """The event feed has no service date (the claim date stands in), type,
    channel or notes."""
    constants = {"claim_type": F.lit(STREAM_CLAIM_TYPE), "submission_channel": F.lit(STREAM_CHANNEL),
                 "notes": F.lit(None).cast("string")}
    return _canonical(stream, STREAM_CLAIM_FIELDS, constants, "streaming")


def union_claims(batch: DataFrame, stream: DataFrame | None = None) -> DataFrame:
    """Batch claims plus the optional event feed (UNION ALL by name).

    A missing feed is simply left out; an empty one is the identity of the
    union, so no row-count probe is needed to decide.
    """
    out = standardize_batch_claims(batch)
    if stream is not None:
        out = out.unionByName(standardize_stream_claims(stream))
    return out


def claim_columns(claims: DataFrame) -> DataFrame:
    """Code arrays, value / complexity flags, days to claim, validity flag: they follow from the row alone."""
    step1 = claims.withColumns({
        "icd10_codes_array": R.split_codes("icd10_codes"),
        "cpt_codes_array": R.split_codes("cpt_codes"),
    })
    step2 = step1.withColumns({
        "is_high_value_claim": F.col("claim_amount") > HIGH_VALUE_AMOUNT,
        "has_multiple_diagnoses": F.size("icd10_codes_array") > 1,
        "has_multiple_procedures": F.size("cpt_codes_array") > 1,
        "days_to_claim": F.datediff(F.col("claim_date"), F.col("service_date")),
    })
    days = F.col("days_to_claim")
    return step2.withColumns({
        "is_valid_claim": (F.when(F.col("claim_amount") > SUSPICIOUS_AMOUNT, F.lit(False))
                            .when(days < 0, F.lit(False))
                            .when(days > MAX_DAYS_TO_CLAIM, F.lit(False))
                            .when(F.col("icd10_codes").isNull(), F.lit(False))
                            .otherwise(F.lit(True))),
    })


def add_claim_flags(claims: DataFrame) -> DataFrame:
    """:func:`claim_columns` and the time of processing."""
    return claim_columns(claims).withColumn("processed_timestamp", F.current_timestamp())


#: What :func:`claim_columns` adds.
CLAIM_COLUMNS = ("icd10_codes_array", "cpt_codes_array", "is_high_value_claim", "has_multiple_diagnoses",
                 "has_multiple_procedures", "days_to_claim", "is_valid_claim")


def dedup_claims(claims: DataFrame) -> DataFrame:
    """Newest row per claim_id by ingestion time."""
    return keep_first(claims, ["claim_id"], latest_first("ingestion_timestamp", CLAIM_TIE_BREAK))


def valid_claims(batch: DataFrame, stream: DataFrame | None = None,
                 as_of: str | _dt.date | None = None) -> DataFrame:
    """The processed claims' canonical columns alone: the rules read no others,
    and :func:`add_claim_flags` derives the rest from each row."""
    return expect_all_or_drop(dedup_claims(union_claims(batch, stream)), claims_rules(as_of))


def claims_processed(batch: DataFrame, stream: DataFrame | None = None,
                     as_of: str | _dt.date | None = None) -> DataFrame:
    newest = dedup_claims(union_claims(batch, stream))
    return expect_all_or_drop(add_claim_flags(newest), claims_rules(as_of))


# --- members ----------------------------------------------------------------

# fixed values: published rule names and conditions
MEMBER_RULES = {
    "valid_member_id": "MemberID IS NOT NULL",
    "member_id_length": "length(MemberID) >= 5",
}


def add_member_fields(members: DataFrame, as_of: str | _dt.date | None = None,
                      strict_mask: bool = False) -> DataFrame:
    return members.withColumns({
        "masked_email": R.mask_email("Email", strict=strict_mask),
        "age": R.age_years("DOB", as_of_column(as_of)),
        "is_active_member": R.flag_from_number("IsActive"),
        "has_complete_profile": R.all_present(("Name", "DOB", "Gender", "Email")),
        "processed_timestamp": F.current_timestamp(),
    })


def dedup_members(members: DataFrame) -> DataFrame:
    """Newest row per MemberID by LastUpdated (NULL dates last)."""
    return keep_first(members, ["MemberID"], latest_first("LastUpdated", MEMBER_TIE_BREAK))


def members_processed(members: DataFrame, as_of: str | _dt.date | None = None,
                      strict_mask: bool = False, drop_columns: tuple[str, ...] = ()) -> DataFrame:
    """Masked, de-duplicated members.  ``drop_columns`` can remove raw PII."""
    out = expect_all_or_drop(add_member_fields(dedup_members(members), as_of, strict_mask), MEMBER_RULES)
    return out.drop(*drop_columns) if drop_columns else out


# --- providers --------------------------------------------------------------

# --- fixed values: published provider columns <- (exploded) source fields --
PROVIDER_FIELDS = {
    "provider_id": "ProviderID", "provider_name": "Name", "specialty": "specialty",
    "address": "location.Address", "city": "location.City", "state": "location.State",
    "is_active": "IsActive", "tin": "TIN", "last_verified": "LastVerified",
    "ingestion_timestamp": "ingestion_timestamp",
}
# --- end of fixed values ------------------------------------------------------

# fixed values: published rule names and conditions
PROVIDER_RULES = {
    "valid_provider_id": "provider_id IS NOT NULL",
    "valid_provider_name": "provider_name IS NOT NULL",
}


def dedup_providers(providers: DataFrame) -> DataFrame:
    """Newest row per ProviderID by LastVerified (NULL dates last)."""
    return keep_first(providers, ["ProviderID"], latest_first("LastVerified", PROVIDER_TIE_BREAK))


def normalize_providers(providers: DataFrame) -> DataFrame:
    """One row per specialty x location (outer: empty / NULL lists keep one row)."""
    exploded = (providers
                .withColumn("specialty", F.explode_outer("Specialties"))
                .withColumn("location", F.explode_outer("Locations")))
    flat = exploded.select(*[F.col(src).alias(name) for name, src in PROVIDER_FIELDS.items()])
    return flat.withColumns({
        "state_standardized": R.trimmed_upper("state"),
        "specialty_standardized": R.trimmed("specialty"),
        "has_complete_address": R.all_present(("address", "city", "state")),
        "processed_timestamp": F.current_timestamp(),
    })


def providers_processed(providers: DataFrame) -> DataFrame:
    return expect_all_or_drop(normalize_providers(dedup_providers(providers)), PROVIDER_RULES)


# --- diagnosis codes --------------------------------------------------------

# fixed values: published rule names and conditions
DIAGNOSIS_RULES = {
    "valid_diagnosis_code": "Code IS NOT NULL",
    "valid_diagnosis_description": "Description IS NOT NULL",
}


def add_diagnosis_fields(codes: DataFrame) -> DataFrame:
    return codes.withColumns({
        "code_standardized": F.upper(F.trim("Code")),
        "description_clean": F.trim("Description"),
        "processed_timestamp": F.current_timestamp(),
    })


def dedup_diagnosis(codes: DataFrame) -> DataFrame:
    """One row per raw Code (``a01`` and ``A01 `` stay apart).

    The published table keeps an arbitrary row per code; here the smallest
    description wins (NULL last), so reruns give the same table.
    """
    return keep_first(codes, ["Code"], [F.col(c).asc_nulls_last() for c in DIAGNOSIS_TIE_BREAK])


def diagnosis_processed(codes: DataFrame) -> DataFrame:
    return expect_all_or_drop(add_diagnosis_fields(dedup_diagnosis(codes)), DIAGNOSIS_RULES)
