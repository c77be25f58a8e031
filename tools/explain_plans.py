"""Print the physical plan of each silver / gold dataset, built on stored inputs.

    python tools/explain_plans.py [sf_dir] [--static]

``--static`` switches AQE and automatic broadcasts off, to show the plan a
large input gets before any runtime re-planning (every join a sort-merge
join, every exchange visible).  For each dataset it prints the counts of
exchanges, joins and aggregate operators, then the formatted plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    static = "--static" in argv
    args = [a for a in argv if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.001"

    from claimwright import queries as Q
    from claimwright.operators.materialize import materialize
    from claimwright.plans import gold, quality, silver
    from claimwright.session import get_session
    from claimwright.sources import testdata as TD

    spark = get_session("local[8]")
    bronze = {s: materialize(TD.bronze(spark, sf_dir, s), f"explain-{s}")
              for s in ("claims_batch", "claims_stream", "members", "providers", "diagnosis_reference")}
    claims = materialize(silver.claims_processed(bronze["claims_batch"], bronze["claims_stream"], Q.AS_OF),
                         "explain-claims")
    members = materialize(silver.members_processed(bronze["members"], Q.AS_OF), "explain-members")
    providers = materialize(silver.providers_processed(bronze["providers"]), "explain-providers")
    dims = gold.store_dimensions(claims, members, providers)
    analytics = materialize(gold.claims_analytics(claims, dims), "explain-analytics")
    if static:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    plans = {
        "claims_processed": silver.claims_processed(bronze["claims_batch"], bronze["claims_stream"], Q.AS_OF),
        "members_processed": silver.members_processed(bronze["members"], Q.AS_OF),
        "providers_processed": silver.providers_processed(bronze["providers"]),
        "diagnosis_processed": silver.diagnosis_processed(bronze["diagnosis_reference"]),
        "data_quality_summary": quality.data_quality_summary(claims, members, providers),
        "claims_analytics": gold.claims_analytics(claims, dims),
        "claims_summary": gold.monthly_claims_summary(analytics, sort=False),
        "provider_metrics": gold.provider_metrics(analytics),
        "member_risk_profile": gold.member_risk_profile(analytics),
    }
    for name, df in plans.items():
        text = df._jdf.queryExecution().executedPlan().toString()
        counts = {op: len(re.findall(op, text)) for op in
                  ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
                   "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate",
                   "SortAggregate", "WindowGroupLimit")}
        print(f"== {name}: " + ", ".join(f"{k}={v}" for k, v in counts.items() if v))
        df.explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
