"""Explicit source schemas.  No reader in this package infers a schema.

Fixed values: the five source layouts (field names, order and types) must be
exactly these for the published tables to match, so they are stated here
as-is.  Keys are declared non-nullable; file readers relax that, and the
silver expectations do the real not-null enforcement.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

AMOUNT = DecimalType(10, 2)

# --- fixed values: source layouts -------------------------------------------
CLAIMS_BATCH_SCHEMA = StructType([
    StructField("ClaimID", StringType(), False),
    StructField("MemberID", StringType(), False),
    StructField("ProviderID", StringType(), False),
    StructField("ClaimDate", StringType(), True),
    StructField("ServiceDate", StringType(), True),
    StructField("Amount", AMOUNT, True),
    StructField("Status", StringType(), True),
    StructField("ICD10Codes", StringType(), True),
    StructField("CPTCodes", StringType(), True),
    StructField("ClaimType", StringType(), True),
    StructField("SubmissionChannel", StringType(), True),
    StructField("Notes", StringType(), True),
    StructField("IngestTimestamp", StringType(), True),
])

CLAIMS_STREAM_SCHEMA = StructType([
    StructField("ClaimID", StringType(), False),
    StructField("MemberID", StringType(), False),
    StructField("ProviderID", StringType(), False),
    StructField("ClaimDate", StringType(), True),
    StructField("Amount", AMOUNT, True),
    StructField("Status", StringType(), True),
    StructField("ICD10Codes", StringType(), True),
    StructField("CPTCodes", StringType(), True),
    StructField("EventTimestamp", StringType(), True),
])

MEMBERS_SCHEMA = StructType([
    StructField("MemberID", StringType(), False),
    StructField("Name", StringType(), True),
    StructField("DOB", StringType(), True),
    StructField("Gender", StringType(), True),
    StructField("Region", StringType(), True),
    StructField("PlanType", StringType(), True),
    StructField("EffectiveDate", StringType(), True),
    StructField("Email", StringType(), True),
    StructField("IsActive", DoubleType(), True),
    StructField("LastUpdated", StringType(), True),
])

LOCATION = StructType([
    StructField("Address", StringType(), True),
    StructField("City", StringType(), True),
    StructField("State", StringType(), True),
])

PROVIDERS_SCHEMA = StructType([
    StructField("ProviderID", StringType(), False),
    StructField("Name", StringType(), True),
    StructField("Specialties", ArrayType(StringType()), True),
    StructField("Locations", ArrayType(LOCATION), True),
    StructField("IsActive", BooleanType(), True),
    StructField("TIN", StringType(), True),
    StructField("LastVerified", StringType(), True),
])

DIAGNOSIS_SCHEMA = StructType([
    StructField("Code", StringType(), False),
    StructField("Description", StringType(), True),
])

# Raw text formats of date and timestamp fields in the source files.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# --- end of fixed values -----------------------------------------------------

# Which raw string fields each source parses into dates / timestamps.
DATE_FIELDS = {
    "claims_batch": ("ClaimDate", "ServiceDate"),
    "claims_stream": ("ClaimDate",),
    "members": ("DOB", "EffectiveDate", "LastUpdated"),
    "providers": ("LastVerified",),
    "diagnosis_reference": (),
}

SOURCE_SCHEMAS = {
    "claims_batch": CLAIMS_BATCH_SCHEMA,
    "claims_stream": CLAIMS_STREAM_SCHEMA,
    "members": MEMBERS_SCHEMA,
    "providers": PROVIDERS_SCHEMA,
    "diagnosis_reference": DIAGNOSIS_SCHEMA,
}
