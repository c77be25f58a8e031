"""Row-level expectations: named SQL predicates attached to a dataset.

``expect_all_or_drop`` keeps a row only if every rule is TRUE; a rule that
evaluates to NULL counts as a violation (WHERE semantics).  Rules are
applied to what the dataset produces, i.e. after de-duplication.

Failure counts come either from a separate one-pass aggregate
(``expectation_metrics``) or, when the dataset is being written anyway, from
``DataFrame.observe`` which gathers them during that same write.

Dropped rows need not be lost: ``write_with_quarantine`` stores all rows in one
write, in partitions by the set of rules that they break (a bit per rule, in the
partition's name and not in the files).  The partition 0 is the dataset; the
others are its quarantine, and reading one does not touch the other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def rule_holds(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def all_rules_hold(rules: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for rule in rules.values():
        cond = cond & rule_holds(rule)
    return cond


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Drop every row that violates at least one rule."""
    if not rules:
        return df
    return df.filter(all_rules_hold(rules))


def _metric_columns(rules: Mapping[str, str]) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("total_records"),
            F.count_if(all_rules_hold(rules)).alias("passed_records")]
    cols += [F.count_if(~rule_holds(rule)).alias(f"failed__{name}") for name, rule in rules.items()]
    return cols


def expectation_metrics(df: DataFrame, rules: Mapping[str, str], dataset: str) -> DataFrame:
    """One row per rule: dataset, rule, predicate, failed / total / passed.

    A single aggregate over the input (partial aggregation on every task,
    one row to finalise) and a constant-size unpivot afterwards.
    """
    wide = df.agg(*_metric_columns(rules))
    per_rule = [
        F.struct(F.lit(name).alias("rule"), F.lit(rule).alias("predicate"),
                 F.col(f"failed__{name}").alias("failed_records"))
        for name, rule in rules.items()
    ]
    return (wide.select(
                F.lit(dataset).alias("dataset"),
                F.explode(F.array(*per_rule)).alias("r"),
                "total_records", "passed_records")
            .select("dataset", "r.rule", "r.predicate", "r.failed_records",
                    "total_records", "passed_records"))


def observe_and_drop(df: DataFrame, rules: Mapping[str, str], name: str) -> tuple[DataFrame, Observation]:
    """Filter like ``expect_all_or_drop`` and count failures on the way.

    The returned ``Observation`` is filled when an action runs on the
    returned frame (e.g. the table write): no extra pass over the data.
    """
    obs = Observation(name)
    observed = df.observe(obs, *_metric_columns(rules))
    return expect_all_or_drop(observed, rules), obs


#: The partition column: the rules that a row breaks, a bit for each in their order.
VIOLATIONS = "violations"


def violation_bits(rules: Mapping[str, str]) -> Column:
    bits = F.lit(0)
    for i, rule in enumerate(rules.values()):
        bits = bits + F.when(rule_holds(rule), F.lit(0)).otherwise(F.lit(1 << i))
    return bits.cast("int")


def write_with_quarantine(df: DataFrame, rules: Mapping[str, str], name: str, path: str) -> tuple[str, Observation]:
    """Store all rows under ``path`` in one pass; returns the folder of those that break no rule, and the counters."""
    spark = df.sparkSession
    obs = Observation(name)
    observed = df.observe(obs, *_metric_columns(rules))
    observed.withColumn(VIOLATIONS, violation_bits(rules)).write.partitionBy(VIOLATIONS).parquet(path)
    kept = f"{path}/{VIOLATIONS}=0"
    if not obs.get["passed_records"]:
        spark.createDataFrame([], df.schema).write.parquet(kept)
    return kept, obs


def quarantined(spark: SparkSession, path: str, rules: Mapping[str, str]) -> DataFrame:
    """The rows that ``write_with_quarantine`` kept out, with the names of the rules they break."""
    rows = spark.read.parquet(path).filter(F.col(VIOLATIONS) != 0)
    names = [F.when(F.col(VIOLATIONS).bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(rules)]
    return rows.withColumn("failed_rules", F.array_compact(F.array(*names)))


def stored_metrics(spark: SparkSession, path: str, rules: Mapping[str, str], dataset: str) -> DataFrame:
    """Like :func:`expectation_metrics`, from the partitions of a stored dataset: only their names and row counts are read."""
    rows = spark.read.parquet(path).groupBy(VIOLATIONS).count()
    wide = rows.agg(F.sum("count").alias("total"), F.sum(F.when(F.col(VIOLATIONS) == 0, F.col("count")).otherwise(0)).alias("passed"),
                    *[F.sum(F.when(F.col(VIOLATIONS).bitwiseAND(F.lit(1 << i)) != 0, F.col("count")).otherwise(0)).alias(f"f{i}")
                      for i in range(len(rules))])
    per_rule = [F.struct(F.lit(name).alias("rule"), F.lit(rule).alias("predicate"), F.coalesce(f"f{i}", F.lit(0)).alias("failed_records"))
                for i, (name, rule) in enumerate(rules.items())]
    return (wide.select(F.lit(dataset).alias("dataset"), F.explode(F.array(*per_rule)).alias("r"),
                        F.coalesce("total", F.lit(0)).alias("total_records"), F.coalesce("passed", F.lit(0)).alias("passed_records"))
            .select("dataset", "r.rule", "r.predicate", "r.failed_records", "total_records", "passed_records"))
