"""Claims and their statistics, kept up to date from new bronze files only.

The full pipeline de-duplicates all claims at each run.  Here a *state* holds
the newest row of each claim (valid or not: an invalid newest row hides the
claim), in ``buckets`` by a hash of the claim id.  A step

1. lists the bronze files that no earlier step has seen (an anti-join with the
   stored list of files; the stream sinks' own logs say which files count),
2. finds the buckets of the new rows from their claim ids alone, keeps the newest
   of these buckets' old and new rows per claim in one shuffle and rewrites those
   buckets alone,
3. publishes files, buckets and statistics in one commit
   (:class:`~claimwright.operators.publish.VersionedStore`): a step that dies
   has no effect and the next one sees the same new files again.

Statistics change by *retraction*: in the rewritten buckets every old published
row counts -1 and every new one +1, so claims that stay as they were cancel out
and what is left is what changed; no join looks for the changed claims.  They are
kept as sums per (provider, member, claim date), which is fine enough for
everything the two statistics tables need: sums and counts add and subtract, a
group at count 0 goes, and the latest date and the distinct members of a provider
are those of the groups that are left.  Only statistics buckets with changes are
rewritten.

Buckets are taken from the hash by which Spark deals the rows of a key to
shuffle partitions.  So a task that writes after the shuffle on the key holds few
buckets where the number of partitions and of buckets share a factor, and no
second shuffle gathers the rows of a bucket.  What is written does not depend on
that, only in how many files.

No step reads the bronze rows of earlier files, and none collects more than the
names of new files and touched buckets.  A hot claim id is reduced to one row
per task before the shuffle, a hot provider is aggregated per task, and a bucket
is written by any number of tasks, so no key has to fit one task.
``as_of`` decides which claims are valid, so it belongs to the state: a step
with another date is refused.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.operators.dedup import keep_first, latest_first
from claimwright.operators.expectations import expect_all_or_drop
from claimwright.operators.materialize import materialize
from claimwright.operators.publish import KEPT_VERSIONS, Version, VersionedStore
from claimwright.plans import silver
from claimwright.session import disk_spared

FEEDS = {"claims_batch": silver.standardize_batch_claims, "claims_stream": silver.standardize_stream_claims}
GRAIN = ("provider_id", "member_id", "claim_date")
SUMS = ("n", "amount", "timed", "days")
LAYOUT = 2  # how rows are dealt to buckets; a state with another layout cannot be continued
SLICES = 2  # parts in which a step writes its buckets
FILES, CLAIMS, STATISTICS = "incremental/files", "incremental/claims", "incremental/statistics"


@dataclass(frozen=True)
class Step:
    """What one step did: its version (None if there was nothing new), new files, rewritten buckets."""
    version: int | None
    new_files: int
    claim_buckets: tuple[int, ...]
    statistics_buckets: tuple[int, ...]


def _newest(rows: DataFrame) -> DataFrame:
    return keep_first(rows, ["claim_id"], latest_first("ingestion_timestamp", silver.CLAIM_TIE_BREAK))


class ClaimsState:
    """The incremental claims under ``root``; ``keep`` versions stay, one at least for its readers."""

    def __init__(self, spark: SparkSession, root: str, as_of: str | _dt.date, buckets: int = 64, keep: int = KEPT_VERSIONS):
        self.spark, self.buckets, self.as_of, self.keep = spark, buckets, str(as_of), keep
        self.store = VersionedStore(spark, root)
        now = self.store.current()
        told = now.notes if now else {}
        if told and (told["buckets"], told["as_of"]) != (buckets, self.as_of):
            raise ValueError(f"the state has {told['buckets']} buckets as of {told['as_of']}")
        if told and told.get("layout") != LAYOUT:
            raise ValueError(f"the state has layout {told.get('layout')}, not {LAYOUT}")

    # --- reading ---------------------------------------------------------------

    def newest_rows(self) -> DataFrame:
        """The newest row of each claim, valid or not."""
        return self._buckets(self._current(), CLAIMS)

    def claims_processed(self) -> DataFrame:
        return self._processed(self.newest_rows())

    def provider_stats(self) -> DataFrame:
        """Like :func:`claimwright.plans.gold.provider_stats` over all processed claims."""
        # fixed values: published names and functions
        return self._statistics().groupBy("provider_id").agg(
            _mean_amount(F.sum("amount"), F.sum("n")).alias("avg_claim_amount"), F.sum("n").alias("total_claims"),
            F.count_distinct("member_id").alias("unique_members"), F.max("claim_date").alias("last_claim_date"),
            F.sum("amount").cast("decimal(20,2)").alias("total_claim_value"),
            F.try_divide(F.sum("days").cast("double"), F.sum("timed").cast("double")).alias("avg_processing_days"))

    def member_stats(self) -> DataFrame:
        """Like :func:`claimwright.plans.gold.member_stats` over all processed claims."""
        # fixed values: published names and functions
        return self._statistics().groupBy("member_id").agg(
            F.sum("n").alias("member_claim_frequency"), F.sum("amount").cast("decimal(20,2)").alias("member_total_claims"),
            F.max("claim_date").alias("member_last_claim"))

    def _current(self) -> Version:
        now = self.store.current()
        if now is None:
            raise KeyError("no step has been published")
        return now

    def _statistics(self) -> DataFrame:
        return self._buckets(self._current(), STATISTICS)

    def _buckets(self, version: Version | None, table: str, only: list[int] | None = None) -> DataFrame | None:
        """Rows of a table's buckets (of those in ``only``); None if there is no such bucket."""
        numbers = range(self.buckets) if only is None else only
        paths = [p for b in numbers for p in (version.paths.get(f"{table}/{b}", []) if version else [])]
        return self.spark.read.parquet(*paths) if paths else None

    def _processed(self, newest: DataFrame) -> DataFrame:
        return expect_all_or_drop(silver.add_claim_flags(newest), silver.claims_rules(self.as_of))

    def _bucket_of(self, *keys: str) -> Column:
        return F.pmod(F.hash(*keys), F.lit(self.buckets)).cast("int")

    # --- a step ----------------------------------------------------------------

    def step(self, bronze_paths: Mapping[str, str]) -> Step:
        """Take in the files under the bronze tables' paths that are new."""
        with disk_spared(self.spark):
            return self._step(bronze_paths)

    def _step(self, bronze_paths: Mapping[str, str]) -> Step:
        now = self.store.current()
        listed = {source: self.spark.read.parquet(path) for source, path in bronze_paths.items()}
        new = self._new_files(now, {source: table.inputFiles() for source, table in listed.items()})
        if not new:
            return Step(None, 0, (), ())
        number = self.store.begin()
        parts = []
        for source, files in _by_source(new).items():
            rows = self.spark.read.schema(listed[source].schema).parquet(*files)
            parts.append(FEEDS[source](rows))
        arrived = reduce(DataFrame.unionByName, parts)
        touched = _numbers(arrived.select(self._bucket_of("claim_id").alias("bucket")))
        old = self._buckets(now, CLAIMS, touched)
        newest = _newest(arrived if old is None else old.select(*arrived.columns).unionByName(arrived))
        claims = self._written(newest.withColumn("bucket", self._bucket_of("claim_id")), number, CLAIMS)
        changed, statistics = self._change_statistics(now, old, number, claims)
        files = self.spark.createDataFrame(new, "source string, file string")
        if now and FILES in now.paths:
            files = self.spark.read.parquet(*now.paths[FILES]).unionByName(files)
        files.write.parquet(self.store.path(number, FILES))
        self.store.commit(number, {FILES: self.store.path(number, FILES), **self._named(CLAIMS, claims, touched),
                                   **self._named(STATISTICS, statistics, changed)},
                          {"buckets": self.buckets, "as_of": self.as_of, "layout": LAYOUT}, self.keep)
        return Step(number, len(new), tuple(touched), tuple(changed))

    def _new_files(self, now: Version | None, listed: dict[str, list[str]]) -> list[tuple[str, str]]:
        given = [(source, file) for source, files in listed.items() for file in files]
        if not given or now is None or FILES not in now.paths:
            return given
        seen = self.spark.read.parquet(*now.paths[FILES])
        files = self.spark.createDataFrame(given, "source string, file string")
        return [tuple(r) for r in files.join(seen, ["source", "file"], "left_anti").collect()]

    def _written(self, rows: DataFrame, number: int, table: str) -> str:
        """Write rows by bucket; a bucket is one folder, however many tasks write it.

        Some of the buckets at a time: the filter goes below the shuffle, and the disk
        holds the shuffle files of one slice.
        """
        path = self.store.path(number, table)
        for i in range(SLICES):
            rows.filter(F.pmod("bucket", F.lit(SLICES)) == i).write.mode("append").partitionBy("bucket").parquet(path)
        return path

    def _named(self, table: str, path: str, buckets: list[int]) -> dict[str, str | list[str]]:
        """Folders of the rewritten buckets; a bucket without rows has none."""
        written = {int(p.rsplit("=", 1)[1]) for p in self.store.listed(f"{path}/bucket=*")}
        return {f"{table}/{b}": f"{path}/bucket={b}" if b in written else [] for b in buckets}

    def _change_statistics(self, now: Version | None, old: DataFrame | None, number: int, claims: str) -> tuple[list[int], str]:
        """Retract the old rows of the rewritten buckets, count their new ones."""
        signed = [self._processed(rows).withColumn("sign", F.lit(sign))
                  for rows, sign in ((old, -1), (self.spark.read.parquet(claims).drop("bucket"), 1)) if rows is not None]
        counted = F.col("days_to_claim").isNotNull().cast("int")
        delta = (reduce(DataFrame.unionByName, signed)
                 .select(*GRAIN, F.col("sign").cast("bigint").alias("n"),
                         (F.col("sign") * F.col("claim_amount")).cast("decimal(38,2)").alias("amount"),
                         (F.col("sign") * counted).cast("bigint").alias("timed"),
                         (F.col("sign") * F.coalesce("days_to_claim", F.lit(0))).cast("bigint").alias("days")))
        delta = self._added(delta).filter(" OR ".join(f"{c} != 0" for c in SUMS))
        delta = materialize(delta.withColumn("bucket", self._bucket_of(*GRAIN)), "incremental-delta")
        changed = _numbers(delta)
        old = self._buckets(now, STATISTICS, changed)
        if old is None:  # the sums of the delta are all there is
            return changed, self._written(delta.filter("n != 0"), number, STATISTICS)
        kept = self._added(old.select(*GRAIN, *SUMS).unionByName(delta.drop("bucket"))).filter("n != 0")
        return changed, self._written(kept.withColumn("bucket", self._bucket_of(*GRAIN)), number, STATISTICS)

    @staticmethod
    def _added(rows: DataFrame) -> DataFrame:
        types = {"amount": "decimal(38,2)"}
        return rows.groupBy(*GRAIN).agg(*[F.sum(c).cast(types.get(c, "bigint")).alias(c) for c in SUMS])


def _mean_amount(total: Column, n: Column) -> Column:
    """Mean of amounts with two decimals, to six decimals, half up, from exact sums (amounts are positive)."""
    millionths = F.call_function("div", (total * 2_000_000).cast("decimal(38,0)") + n, n * 2)
    return (millionths.cast("decimal(20,0)") * F.lit(0.000001).cast("decimal(7,6)")).cast("decimal(14,6)")


def _numbers(rows: DataFrame) -> list[int]:
    """Bucket numbers of the rows: at most as many as there are buckets."""
    return sorted(r[0] for r in rows.select("bucket").distinct().collect())


def _by_source(files: list[tuple[str, str]]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for source, file in files:
        out.setdefault(source, []).append(file)
    return out


def grow_in_steps(spark: SparkSession, root: str, arrivals: Iterable[Mapping[str, DataFrame]], as_of: str | _dt.date,
                  buckets: int = 64, keep: int = KEPT_VERSIONS) -> ClaimsState:
    """Append each arrival's bronze rows to the bronze tables under ``root`` and take a step after each."""
    state = ClaimsState(spark, f"{root}/state", as_of, buckets, keep)
    paths: dict[str, str] = {}
    for arrival in arrivals:
        paths |= {source: f"{root}/bronze/{source}" for source in arrival}
        with ThreadPoolExecutor(max_workers=max(1, len(arrival))) as pool:  # independent tables
            list(pool.map(lambda item: item[1].write.mode("append").parquet(paths[item[0]]), arrival.items()))
        state.step(paths)
    return state
