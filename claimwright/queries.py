"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query runs the engine's real operator over the whole role-bound test
tables and returns its output in a *comparable* shape (see
:func:`comparable`): clock columns and file paths removed, decimals as
double, integers as bigint, arrays joined into text, timestamps as text.
The independent DuckDB statements in :mod:`claimwright.oracle` produce the
same shape.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.functions import sql_functions
from claimwright.operators.expectations import expectation_metrics, stored_metrics, write_with_quarantine
from claimwright.operators.materialize import materialize
from claimwright.operators.ordered import store_ordered
from claimwright.operators.ranking import global_row_number
from claimwright.plans import bucketed, distinct_rollups, gold, incremental, lineage, medallion, quality, silver
from claimwright.session import disk_spared, remove_folder, scratch_path
from claimwright.sources import testdata as TD
from claimwright.sources.files import read_bronze, write_raw
from claimwright.streaming.ingest import ingest_directory

AS_OF = TD.AS_OF
RAW_SOURCES = ("claims_batch", "claims_stream", "members", "providers", "diagnosis_reference")

# Columns whose values depend on the wall clock or on where files live.
CLOCK_COLUMNS = ("processed_timestamp", "calculated_at", "calculated_timestamp", "source_file")
LOAD_TIME = ("ingestion_timestamp",)

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        return F.concat_ws("/", *[F.coalesce(c[f.name].cast("string"), F.lit("~")) for f in dtype.fields])
    return c.cast("string")


def _element_text(dtype: T.DataType) -> Callable[[Column], Column]:
    # F.transform passes (element, index) to two-argument functions, so the
    # element type is bound in a closure instead of a default argument.
    def fn(x: Column) -> Column:
        return _as_text(x, dtype)
    return fn


def comparable(df: DataFrame, drop: tuple[str, ...] = CLOCK_COLUMNS) -> DataFrame:
    """Normalise column types for an engine-independent comparison."""
    out = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, _INTEGRAL):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType):
            et = t.elementType
            if not isinstance(et, T.StringType):
                c = F.transform(c, _element_text(et))
            c = F.array_join(c, "|")
        out.append(c.alias(f.name))
    return df.select(*out)


# --- inputs ------------------------------------------------------------------

def _bronze(spark: SparkSession, d: str, source: str) -> DataFrame:
    return TD.bronze(spark, d, source)


def _claims_union(spark: SparkSession, d: str) -> DataFrame:
    return silver.union_claims(_bronze(spark, d, "claims_batch"), _bronze(spark, d, "claims_stream"))


def _claims_processed(spark: SparkSession, d: str) -> DataFrame:
    return silver.claims_processed(_bronze(spark, d, "claims_batch"), _bronze(spark, d, "claims_stream"), AS_OF)


def _members_processed(spark: SparkSession, d: str) -> DataFrame:
    return silver.members_processed(_bronze(spark, d, "members"), AS_OF)


def _providers_processed(spark: SparkSession, d: str) -> DataFrame:
    return silver.providers_processed(_bronze(spark, d, "providers"))


def _silver_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three silver tables gold reads, each computed once and stored.

    They are independent, so the three writes run as concurrent jobs.  Of the
    claims the canonical columns are stored (and shuffled by gold); their flags
    are derived where they are used.
    """
    valid = silver.valid_claims(_bronze(spark, d, "claims_batch"), _bronze(spark, d, "claims_stream"), AS_OF)
    plans = [(valid, "claims_processed"),
             (_members_processed(spark, d), "members_processed"),
             (_providers_processed(spark, d), "providers_processed")]
    with ThreadPoolExecutor(max_workers=len(plans)) as pool:
        claims, members, providers = pool.map(lambda p: materialize(*p), plans)
    return claims, members, providers


def _dimensions(claims: DataFrame, members: DataFrame, providers: DataFrame) -> gold.Dimensions:
    return gold.store_dimensions(silver.add_claim_flags(claims), members, providers)


def _analytics(spark: SparkSession, d: str) -> DataFrame:
    claims, members, providers = _silver_tables(spark, d)
    return gold.claims_analytics(claims, _dimensions(claims, members, providers), derive=silver.add_claim_flags)


# --- ingestion (files written by Spark from the test tables, then read back) ---

def _stage(spark: SparkSession, d: str, source: str, compression: str | None = None) -> str:
    """Raw files of ``source``, as many as the derived rows have partitions."""
    return write_raw(TD.raw(spark, d, source), source, scratch_path(spark, f"stage-{source}"), compression=compression)


def _ingest_stream(spark: SparkSession, d: str, source: str) -> DataFrame:
    staged = _stage(spark, d, source)
    sink = scratch_path(spark, f"bronze-{source}")
    ingest_directory(spark, source, staged, sink, scratch_path(spark, f"ckpt-{source}"))
    return comparable(spark.read.parquet(sink), CLOCK_COLUMNS + LOAD_TIME)


def _ingest_batch(spark: SparkSession, d: str, source: str) -> DataFrame:
    staged = _stage(spark, d, source)
    return comparable(read_bronze(spark, source, staged), CLOCK_COLUMNS + LOAD_TIME)


def q_ingest_claims_csv_stream(spark: SparkSession, d: str) -> DataFrame:
    return _ingest_stream(spark, d, "claims_batch")


def q_ingest_claims_json_stream(spark: SparkSession, d: str) -> DataFrame:
    return _ingest_stream(spark, d, "claims_stream")


def q_ingest_members_csv(spark: SparkSession, d: str) -> DataFrame:
    return _ingest_batch(spark, d, "members")


def q_ingest_providers_json(spark: SparkSession, d: str) -> DataFrame:
    return _ingest_batch(spark, d, "providers")


def q_ingest_diagnosis_csv(spark: SparkSession, d: str) -> DataFrame:
    return _ingest_batch(spark, d, "diagnosis_reference")


def q_stream_ingest_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """Two availableNow runs on one checkpoint: the second adds nothing."""
    source = "claims_stream"
    staged = _stage(spark, d, source)
    sink = scratch_path(spark, f"bronze-{source}")
    ckpt = scratch_path(spark, f"ckpt-{source}")
    first = ingest_directory(spark, source, staged, sink, ckpt, max_files_per_trigger=2)
    second = ingest_directory(spark, source, staged, sink, ckpt, max_files_per_trigger=2)
    table = spark.read.parquet(sink)
    return table.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("ClaimID").alias("distinct_claims"),
        F.sum("Amount").cast("double").alias("total_amount"),
    ).select("*", F.lit(first.input_rows).cast("bigint").alias("first_run_rows"),
             F.lit(second.input_rows).cast("bigint").alias("second_run_rows"))


# --- silver ------------------------------------------------------------------

def q_claims_union(spark: SparkSession, d: str) -> DataFrame:
    return comparable(_claims_union(spark, d))


def q_claims_rules(spark: SparkSession, d: str) -> DataFrame:
    return comparable(silver.add_claim_flags(_claims_union(spark, d)))


def q_claims_dedup(spark: SparkSession, d: str) -> DataFrame:
    return comparable(silver.add_claim_flags(silver.dedup_claims(_claims_union(spark, d))))


def q_claims_processed(spark: SparkSession, d: str) -> DataFrame:
    return comparable(_claims_processed(spark, d))


def q_members_dedup(spark: SparkSession, d: str) -> DataFrame:
    m = silver.dedup_members(_bronze(spark, d, "members"))
    return comparable(silver.add_member_fields(m, AS_OF), CLOCK_COLUMNS + LOAD_TIME)


def q_members_processed(spark: SparkSession, d: str) -> DataFrame:
    return comparable(_members_processed(spark, d), CLOCK_COLUMNS + LOAD_TIME)


def q_mask_email(spark: SparkSession, d: str) -> DataFrame:
    from claimwright.functions.rules import mask_email
    m = _bronze(spark, d, "members")
    return m.select("MemberID", "Email",
                    mask_email("Email").alias("masked_email"),
                    mask_email("Email", strict=True).alias("masked_email_strict"))


def q_providers_dedup(spark: SparkSession, d: str) -> DataFrame:
    return comparable(silver.dedup_providers(_bronze(spark, d, "providers")), CLOCK_COLUMNS + LOAD_TIME)


def q_providers_normalized(spark: SparkSession, d: str) -> DataFrame:
    p = silver.normalize_providers(silver.dedup_providers(_bronze(spark, d, "providers")))
    return comparable(p, CLOCK_COLUMNS + LOAD_TIME)


def q_providers_processed(spark: SparkSession, d: str) -> DataFrame:
    return comparable(_providers_processed(spark, d), CLOCK_COLUMNS + LOAD_TIME)


def q_diagnosis_processed(spark: SparkSession, d: str) -> DataFrame:
    return comparable(silver.diagnosis_processed(_bronze(spark, d, "diagnosis_reference")),
                      CLOCK_COLUMNS + LOAD_TIME)


def q_expectation_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Per-rule failure counts of the four silver datasets (before dropping)."""
    claims = silver.add_claim_flags(silver.dedup_claims(_claims_union(spark, d)))
    members = silver.add_member_fields(silver.dedup_members(_bronze(spark, d, "members")), AS_OF)
    providers = silver.normalize_providers(silver.dedup_providers(_bronze(spark, d, "providers")))
    codes = silver.add_diagnosis_fields(silver.dedup_diagnosis(_bronze(spark, d, "diagnosis_reference")))
    parts = [
        expectation_metrics(claims, silver.claims_rules(AS_OF), "claims_processed"),
        expectation_metrics(members, silver.MEMBER_RULES, "members_processed"),
        expectation_metrics(providers, silver.PROVIDER_RULES, "providers_processed"),
        expectation_metrics(codes, silver.DIAGNOSIS_RULES, "diagnosis_reference_processed"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_expectation_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """The same counts from the stored datasets: published rows and quarantine together are all rows."""
    inputs = [
        (silver.add_claim_flags(silver.dedup_claims(_claims_union(spark, d))), silver.claims_rules(AS_OF), "claims_processed"),
        (silver.add_member_fields(silver.dedup_members(_bronze(spark, d, "members")), AS_OF), silver.MEMBER_RULES, "members_processed"),
        (silver.normalize_providers(silver.dedup_providers(_bronze(spark, d, "providers"))), silver.PROVIDER_RULES, "providers_processed"),
        (silver.add_diagnosis_fields(silver.dedup_diagnosis(_bronze(spark, d, "diagnosis_reference"))), silver.DIAGNOSIS_RULES,
         "diagnosis_reference_processed"),
    ]

    def store(item: tuple[DataFrame, dict[str, str], str]) -> DataFrame:
        df, rules, name = item
        path = scratch_path(spark, f"quarantine-{name}")
        write_with_quarantine(df, rules, name, path)
        return stored_metrics(spark, path, rules, name)

    with ThreadPoolExecutor(max_workers=len(inputs)) as pool:  # independent tables
        return reduce(DataFrame.unionByName, pool.map(store, inputs))


def q_data_quality_summary(spark: SparkSession, d: str) -> DataFrame:
    dq = quality.data_quality_summary(_claims_processed(spark, d), _members_processed(spark, d),
                                      _providers_processed(spark, d))
    return comparable(dq)


# --- gold --------------------------------------------------------------------

def q_provider_stats(spark: SparkSession, d: str) -> DataFrame:
    return comparable(gold.provider_stats(_claims_processed(spark, d)))


def q_member_stats(spark: SparkSession, d: str) -> DataFrame:
    return comparable(gold.member_stats(_claims_processed(spark, d)))


def q_provider_summary(spark: SparkSession, d: str) -> DataFrame:
    return comparable(gold.provider_summary(_providers_processed(spark, d)))


def q_claims_enriched(spark: SparkSession, d: str) -> DataFrame:
    claims, members, providers = _silver_tables(spark, d)
    return comparable(gold.claims_enriched(claims, _dimensions(claims, members, providers), derive=silver.add_claim_flags))


def q_claims_enriched_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The enrichment from stored buckets: the member join moves no row."""
    claims, members, providers = _silver_tables(spark, d)
    stored = bucketed.store_bucketed(claims, _dimensions(claims, members, providers))
    return comparable(stored.enriched(derive=silver.add_claim_flags))


FRAUD_OUTPUT = ("claim_id", "member_id", "provider_id", "claim_amount", "avg_claim_amount",
                "provider_reputation_score", "member_claim_frequency", "amount_deviation",
                "amount_score", "days_diff", "timing_score", "provider_score", "volume_score",
                "fraud_risk_score", "risk_category", "investigation_priority")


def q_fraud_score(spark: SparkSession, d: str) -> DataFrame:
    a = _analytics(spark, d)
    out = a.select(*FRAUD_OUTPUT).withColumn("amount_deviation", F.round("amount_deviation", 6))
    return comparable(out)


def q_sql_fraud_score(spark: SparkSession, d: str) -> DataFrame:
    """The fraud score by SQL text alone, over the enriched claims."""
    claims, members, providers = _silver_tables(spark, d)
    enriched = gold.claims_enriched(claims, _dimensions(claims, members, providers), derive=silver.add_claim_flags)
    enriched.createOrReplaceTempView("claims_enriched")
    sql_functions.register(spark)
    return comparable(spark.sql("""
        WITH parts AS (
            SELECT *, cw_reputation_score(total_claims) AS reputation, datediff(claim_date, service_date) AS days_diff,
                   cw_amount_deviation(claim_amount, avg_claim_amount) AS deviation FROM claims_enriched),
        scored AS (SELECT *, cw_fraud_risk_score(deviation, days_diff, reputation, member_claim_frequency) AS fraud_risk_score FROM parts)
        SELECT claim_id, member_id, provider_id, claim_amount, avg_claim_amount, reputation AS provider_reputation_score,
               member_claim_frequency, round(deviation, 6) AS amount_deviation, cw_amount_score(deviation) AS amount_score, days_diff,
               cw_timing_score(days_diff) AS timing_score, cw_provider_score(reputation) AS provider_score,
               cw_volume_score(member_claim_frequency) AS volume_score, fraud_risk_score,
               cw_risk_category(fraud_risk_score) AS risk_category,
               cw_investigation_priority(fraud_risk_score, claim_amount) AS investigation_priority
        FROM scored"""))


def q_monthly_claims_summary(spark: SparkSession, d: str) -> DataFrame:
    return comparable(gold.monthly_claims_summary(_analytics(spark, d)))


def q_monthly_summary_positions(spark: SparkSession, d: str) -> DataFrame:
    """The monthly roll-up stored in its published order, with each row's place in it."""
    summary = gold.monthly_claims_summary(_analytics(spark, d), sort=False)
    return comparable(store_ordered(summary, gold.MONTHLY_ORDER, "monthly").positions())


def q_distinct_rollups(spark: SparkSession, d: str) -> DataFrame:
    """Distinct members and providers of every roll-up, from one stored aggregate."""
    return comparable(distinct_rollups.store_distinct_rollups(_analytics(spark, d)).all())


def q_provider_performance(spark: SparkSession, d: str) -> DataFrame:
    return comparable(gold.provider_performance(_analytics(spark, d)))


def q_member_risk_profile(spark: SparkSession, d: str) -> DataFrame:
    return comparable(gold.member_risk_profile(_analytics(spark, d)))


def q_global_rank(spark: SparkSession, d: str) -> DataFrame:
    """Every processed claim ranked by amount (desc), claim_id as tie-break."""
    c = _claims_processed(spark, d).select("claim_id", "provider_id", "claim_amount")
    ranked = global_row_number(c, [F.col("claim_amount").desc_nulls_last(), F.col("claim_id").asc_nulls_first()],
                               "amount_rank")
    return comparable(ranked)


def q_sql_select_claims(spark: SparkSession, d: str) -> DataFrame:
    _claims_processed(spark, d).createOrReplaceTempView("claims_processed")
    return comparable(spark.sql("SELECT * FROM claims_processed"))


# one figure per dataset that depends on its contents
CONTENT = {
    "claims_batch": "sum(Amount)", "claims_stream": "sum(Amount)", "members": "sum(IsActive)",
    "providers": "sum(size(Locations))", "diagnosis_reference": "sum(length(Code))",
    "claims_processed": "sum(claim_amount)", "members_processed": "sum(age)", "providers_processed": "count(specialty)",
    "diagnosis_reference_processed": "sum(length(code_standardized))", "data_quality_summary": "sum(valid_records)",
    "claims_analytics": "sum(fraud_risk_score)", "claims_summary": "sum(claim_count)",
    "provider_performance": "sum(value_rank + total_claims)", "member_risk_profile": "sum(total_claims)",
}


# the load or calculation time of each layer's rows
CLOCK = {"claims_summary": None, "data_quality_summary": "calculated_at", "provider_performance": "calculated_timestamp",
         "member_risk_profile": "calculated_timestamp"}
CLOCK_OF_LAYER = {"bronze": "ingestion_timestamp", "silver": "processed_timestamp", "gold": "processed_timestamp"}


def q_medallion_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """Raw files to gold, read by SQL over the published tables and the view.

    Rows, a content figure, rows with a load or calculation time, comment and
    tier of every dataset.  The run has catalog databases of its own; they are dropped again (the
    tables are external, so the files stay for the returned frame).
    """
    with disk_spared(spark), ThreadPoolExecutor(max_workers=len(RAW_SOURCES)) as pool:  # independent files
        raw_dirs = dict(zip(RAW_SOURCES, pool.map(lambda s: _stage(spark, d, s, "gzip"), RAW_SOURCES)))
    prefix = f"run_{uuid.uuid4().hex[:8]}_"
    medallion.run_all(spark, raw_dirs, scratch_path(spark, "medallion"), as_of=AS_OF, catalog_prefix=prefix, consume_raw=True)
    parts = []
    for ds in medallion.datasets():
        table, comment, tier = ds.name, ds.comment, None
        if ds.kind != "view":
            table = prefix + ds.qualified_name
            told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
            comment = told.get("Comment")
            tier = re.search(r"quality=(\w+)", told.get("Table Properties", "")).group(1)
        clock = CLOCK.get(ds.name, CLOCK_OF_LAYER[ds.layer])
        parts.append(spark.sql(f"""
            SELECT '{ds.name}' AS dataset, count(*) AS row_count, CAST({CONTENT[ds.name]} AS DOUBLE) AS content,
                   {f"count({clock})" if clock else "CAST(NULL AS BIGINT)"} AS with_clock
            FROM {table}""").withColumns({"tier": F.lit(tier).cast("string"), "comment_kept": F.lit(comment == ds.comment)}))
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {prefix}{layer} CASCADE")
    return reduce(DataFrame.unionByName, parts)


def q_claims_optional_feed(spark: SparkSession, d: str) -> DataFrame:
    """A run with the event feed, then one without it in the same session."""
    paths = medallion.store_bronze({s: TD.bronze(spark, d, s) for s in ("claims_batch", "claims_stream")},
                                   scratch_path(spark, "optional-feed"))
    parts = []
    for run, given in (("with feed", paths), ("without feed", {"claims_batch": paths["claims_batch"]})):
        t = medallion.bronze_tables(spark, given)
        claims = silver.union_claims(t["claims_batch"], t.get("claims_stream"))
        parts.append(claims.groupBy(F.lit(run).alias("run"), "source_type").agg(F.count(F.lit(1)).alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def q_bronze_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each ingested source that know their file and their load time."""
    parts = []
    for source in RAW_SOURCES:
        if source.startswith("claims"):
            sink = scratch_path(spark, f"bronze-{source}")
            ingest_directory(spark, source, _stage(spark, d, source), sink, scratch_path(spark, f"ckpt-{source}"))
            df = spark.read.parquet(sink)
        else:
            df = read_bronze(spark, source, _stage(spark, d, source))
        parts.append(df.agg(F.lit(source).alias("source"), F.count(F.lit(1)).alias("row_count"),
                            F.count("source_file").alias("with_file"), F.count("ingestion_timestamp").alias("with_time"),
                            (F.count_distinct("source_file") > 0).alias("has_files")))
    return reduce(DataFrame.unionByName, parts)


def q_bronze_file_audit(spark: SparkSession, d: str) -> DataFrame:
    """Each source's raw files against the bronze rows that name them: files in every state, and their rows."""
    def audit(source: str) -> DataFrame:
        raw_dir = _stage(spark, d, source)
        if source.startswith("claims"):
            sink = scratch_path(spark, f"bronze-{source}")
            ingest_directory(spark, source, raw_dir, sink, scratch_path(spark, f"ckpt-{source}"))
            bronze = spark.read.parquet(sink)
        else:
            bronze = read_bronze(spark, source, raw_dir)
        files = lineage.reconcile(lineage.manifest(spark, source, raw_dir), bronze)
        return files.agg(F.lit(source).alias("source"), F.sum("rows").alias("file_rows"), F.sum("bronze_rows").alias("bronze_rows"),
                         *[F.count_if(F.col("status") == s).alias(f"files_{s}") for s in ("missing", "doubled", "unknown")],
                         (F.count_if(F.col("status") == "ok") == F.count(F.lit(1))).alias("all_ok"))

    with ThreadPoolExecutor(max_workers=len(RAW_SOURCES)) as pool:  # independent sources
        return reduce(DataFrame.unionByName, pool.map(audit, RAW_SOURCES))


def q_bronze_malformed_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates and timestamps that do not parse become NULL; their rows stay."""
    members = TD.raw(spark, d, "members").withColumn("DOB", F.expr(
        "CASE length(Name) + ascii(Region) % 3 WHEN length(Name) THEN 'unknown' "
        "WHEN length(Name) + 1 THEN '1999-13-45' ELSE DOB END"))
    events = TD.raw(spark, d, "claims_stream").withColumn("EventTimestamp", F.expr(
        "CASE WHEN Status = 'click' THEN '2024/01/01' ELSE EventTimestamp END"))
    m = read_bronze(spark, "members", write_raw(members, "members", scratch_path(spark, "malformed-members")))
    e = read_bronze(spark, "claims_stream", write_raw(events, "claims_stream", scratch_path(spark, "malformed-events")))
    return (m.select(F.lit("members").alias("source"), F.col("MemberID").alias("id"), F.col("DOB").cast("string").alias("parsed"))
            .unionByName(e.select(F.lit("claims_stream").alias("source"), F.col("ClaimID").alias("id"),
                                  F.date_format("EventTimestamp", "yyyy-MM-dd HH:mm:ss").alias("parsed"))))


# --- growing input -------------------------------------------------------------

ARRIVALS, BUCKETS = 3, 16


def _grown(spark: SparkSession, d: str) -> incremental.ClaimsState:
    """The claims state after all bronze rows have come in three arrivals.

    Rows of one claim come in different arrivals, so later ones replace or
    hide what earlier steps have published.
    """
    feeds = {s: TD.bronze(spark, d, s) for s in ("claims_batch", "claims_stream")}
    turn = F.pmod(F.xxhash64("ClaimID", "ingestion_timestamp"), F.lit(ARRIVALS))

    def dealt(df: DataFrame) -> tuple[str, DataFrame]:  # a feed is derived once, not once for each arrival
        path = scratch_path(spark, "arrivals")
        turns = df.withColumn("turn", turn.cast("int"))
        turns.write.partitionBy("turn").parquet(path)
        return path, spark.read.schema(turns.schema).parquet(path)

    def arrivals(staged: dict[str, tuple[str, DataFrame]]) -> Iterator[dict[str, DataFrame]]:
        for k in range(ARRIVALS):
            yield {s: df.filter(F.col("turn") == k).drop("turn") for s, (_, df) in staged.items()}
            for path, _ in staged.values():  # its rows are in the bronze tables now
                remove_folder(spark, f"{path}/turn={k}")

    with disk_spared(spark):
        with ThreadPoolExecutor(max_workers=len(feeds)) as pool:  # independent feeds
            staged = dict(zip(feeds, pool.map(dealt, feeds.values())))
        # nobody reads the state before its last step
        return incremental.grow_in_steps(spark, scratch_path(spark, "incremental"), arrivals(staged), AS_OF, BUCKETS, keep=1)


def q_claims_incremental(spark: SparkSession, d: str) -> DataFrame:
    return comparable(_grown(spark, d).claims_processed())


def q_provider_stats_incremental(spark: SparkSession, d: str) -> DataFrame:
    return comparable(_grown(spark, d).provider_stats())


def q_member_stats_incremental(spark: SparkSession, d: str) -> DataFrame:
    return comparable(_grown(spark, d).member_stats())


def entry_query(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the monthly roll-up over the whole enriched, scored chain."""
    return q_monthly_claims_summary(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_claims_csv_stream": q_ingest_claims_csv_stream,
    "ingest_claims_json_stream": q_ingest_claims_json_stream,
    "ingest_members_csv": q_ingest_members_csv,
    "ingest_providers_json": q_ingest_providers_json,
    "ingest_diagnosis_csv": q_ingest_diagnosis_csv,
    "stream_ingest_idempotent": q_stream_ingest_idempotent,
    "claims_union": q_claims_union,
    "claims_rules": q_claims_rules,
    "claims_dedup": q_claims_dedup,
    "claims_processed": q_claims_processed,
    "members_dedup": q_members_dedup,
    "members_processed": q_members_processed,
    "mask_email": q_mask_email,
    "providers_dedup": q_providers_dedup,
    "providers_normalized": q_providers_normalized,
    "providers_processed": q_providers_processed,
    "diagnosis_processed": q_diagnosis_processed,
    "expectation_metrics": q_expectation_metrics,
    "data_quality_summary": q_data_quality_summary,
    "provider_stats": q_provider_stats,
    "member_stats": q_member_stats,
    "provider_summary": q_provider_summary,
    "claims_enriched": q_claims_enriched,
    "fraud_score": q_fraud_score,
    "monthly_claims_summary": q_monthly_claims_summary,
    "provider_performance": q_provider_performance,
    "member_risk_profile": q_member_risk_profile,
    "global_rank": q_global_rank,
    "sql_select_claims": q_sql_select_claims,
    "claims_optional_feed": q_claims_optional_feed,
    "bronze_lineage": q_bronze_lineage,
    "bronze_malformed_dates": q_bronze_malformed_dates,
    "medallion_end_to_end": q_medallion_end_to_end,
    "expectation_quarantine": q_expectation_quarantine,
    "sql_fraud_score": q_sql_fraud_score,
    "bronze_file_audit": q_bronze_file_audit,
    "claims_incremental": q_claims_incremental,
    "provider_stats_incremental": q_provider_stats_incremental,
    "member_stats_incremental": q_member_stats_incremental,
    "claims_enriched_bucketed": q_claims_enriched_bucketed,
    "monthly_summary_positions": q_monthly_summary_positions,
    "distinct_rollups": q_distinct_rollups,
}
