"""Claims and member dimension stored in matching buckets, so that they join in place.

The claims are read again and again (enrichment, then every change of the
scoring), while their member does not change.  Here the exchange on member_id is
paid once, when the claims are written: claims and member dimension become
tables with the same number of buckets on the same columns, and the member
join of every later run reads bucket by bucket with no exchange on either side.

A bucket is read by one task and, unlike a shuffle partition, cannot be split
at run time.  So hot members are split when written: a member with more than
``total / buckets`` claims gets one *salt* for each such share, its claims are
dealt over the salts by a hash of the claim id, and its dimension row is
repeated for each salt.  Buckets are on (member_id, salt).  Fewer than
``buckets`` members can be hot, and the repeats are fewer than 2 x ``buckets``
rows, whatever the data: that is the proven bound of the one broadcast here.
The null member is salted like any other (it matches no dimension row).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.functions.scoring import DEFAULT_SCORING, ScoringConfig
from claimwright.plans import gold
from claimwright.session import scratch_path

KEY, SALT = "member_id", "__salt"
BUCKETS = 32


@dataclass(frozen=True)
class BucketedClaims:
    """Catalog tables in matching buckets on (member_id, salt)."""
    claims: DataFrame
    dims: gold.Dimensions  # its member table is bucketed, too
    tables: tuple[str, str]

    def enriched(self, cfg: ScoringConfig = DEFAULT_SCORING,
                 derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        return gold.claims_enriched(self.claims, self.dims, cfg, (KEY, SALT), derive)

    def drop(self) -> None:
        for table in self.tables:
            self.claims.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


def hot_members(claims: DataFrame, buckets: int) -> DataFrame:
    """(member, salts) of the members with more than ``total / buckets`` claims."""
    total = claims.count()
    counts = claims.groupBy(F.col(KEY).alias("__member")).agg(F.count(F.lit(1)).alias("__n"))
    share = max(1, -(-total // buckets))  # claims of one member that one salt holds (about)
    return counts.filter(F.col("__n") > share).select("__member", F.ceil(F.col("__n") / share).cast("int").alias("__salts"))


def store_bucketed(claims: DataFrame, dims: gold.Dimensions, buckets: int = BUCKETS, database: str = "default") -> BucketedClaims:
    """Write claims and member dimension as bucketed tables; the number of buckets should grow with the claims."""
    spark = claims.sparkSession
    hot = hot_members(claims, buckets)
    own = F.pmod(F.xxhash64("claim_id"), F.coalesce("__salts", F.lit(1))).cast("int")
    salted = (claims.join(F.broadcast(hot), F.col(KEY).eqNullSafe(F.col("__member")), "left")
              .withColumn(SALT, own).drop("__member", "__salts"))
    repeated = (dims.member.join(F.broadcast(hot), F.col(KEY) == F.col("__member"), "left")
                .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__member", "__salts"))
    run = uuid.uuid4().hex[:12]
    names = []
    for name, df in (("claims", salted), ("member_dimension", repeated)):
        table = f"{database}.bucketed_{name}_{run}"
        # the shuffle deals rows as the buckets do, so each task writes one bucket's file
        (df.repartition(buckets, KEY, SALT).write.bucketBy(buckets, KEY, SALT).sortBy(KEY, SALT)
         .option("path", scratch_path(spark, f"bucketed-{name}")).saveAsTable(table))
        names.append(table)
    stored = [spark.table(t) for t in names]
    return BucketedClaims(stored[0], replace(dims, member=stored[1]), (names[0], names[1]))
