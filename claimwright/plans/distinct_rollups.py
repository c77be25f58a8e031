"""Distinct members and providers of every roll-up from one stored aggregate.

The claim rows are read once, for five narrow columns.  Their members are
numbered, and one table of cells (see :mod:`claimwright.operators.distinct`) by
month, provider and risk category serves all counts: members of a month and
provider, of a provider, of a month, quarter or year, and providers of a member.
Quarters and years come from the months' bitmaps.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.operators import distinct
from claimwright.operators.materialize import materialize
from claimwright.plans.gold import MONTH_START, period_columns

FINE = [MONTH_START, "provider_id", "provider_name", "risk_category"]
MONTH = [MONTH_START, "risk_category"]


@dataclass(frozen=True)
class DistinctRollups:
    fine: DataFrame     # FINE, block, positions of the members
    months: DataFrame   # MONTH and the names of its periods, block, bits of the members
    members: DataFrame  # member_id, member_number

    def members_by_month_and_provider(self) -> DataFrame:
        found = distinct.counted(self.fine, [MONTH_START, "provider_name", "risk_category"], "unique_members")
        return found.select(period_columns()["claim_month"].alias("claim_month"), "provider_name", "risk_category", "unique_members")

    def members_by_provider(self) -> DataFrame:
        return distinct.counted(self.fine, ["provider_id"], "unique_members")

    def members_by_period(self, period: str) -> DataFrame:
        """``period`` is claim_month, claim_quarter or claim_year."""
        keys = [period, "risk_category"]
        return distinct.cardinality(distinct.merged(self.months, keys), keys, "unique_members")

    def providers_by_member(self) -> DataFrame:
        each = distinct.numbers_of(self.fine, ["provider_id"], "number")
        found = each.groupBy("number").agg(F.count_distinct("provider_id").alias("unique_providers"))
        return found.join(self.members, found["number"] == self.members["member_number"], "left").select(
            "member_id", "unique_providers")

    def all(self) -> DataFrame:
        """(rollup, period, provider, risk_category, member, distinct_count) of all of them."""
        def rows(rollup: str, df: DataFrame, count: str, **columns: Column) -> DataFrame:
            names = ("period", "provider", "risk_category", "member")
            return df.select(F.lit(rollup).alias("rollup"),
                             *[columns.get(n, F.lit(None)).cast("string").alias(n) for n in names],
                             F.col(count).cast("bigint").alias("distinct_count"))

        risk = F.col("risk_category")
        parts = [
            rows("month_provider", self.members_by_month_and_provider(), "unique_members",
                 period=F.col("claim_month"), provider=F.col("provider_name"), risk_category=risk),
            rows("provider", self.members_by_provider(), "unique_members", provider=F.col("provider_id")),
            rows("member", self.providers_by_member(), "unique_providers", member=F.col("member_id")),
            *[rows(p.removeprefix("claim_"), self.members_by_period(p), "unique_members", period=F.col(p), risk_category=risk)
              for p in ("claim_month", "claim_quarter", "claim_year")],
        ]
        return reduce(DataFrame.unionByName, parts)


def store_distinct_rollups(analytics: DataFrame) -> DistinctRollups:
    narrow = materialize(analytics.select("member_id", "provider_id", "provider_name", "risk_category",
                                          F.trunc("service_date", "MM").alias(MONTH_START)), "distinct-rows")
    members = materialize(distinct.number_values(narrow, "member_id", "member_number"), "distinct-members")
    numbered = distinct.with_number(narrow, "member_id", members, "member_number")
    fine = materialize(distinct.cells(numbered, FINE, "member_number"), "distinct-cells")
    months = materialize(distinct.bitmaps(fine, MONTH).withColumns(period_columns()), "distinct-months")
    return DistinctRollups(fine, months, members)
