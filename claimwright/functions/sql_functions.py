"""The published formulas as SQL functions, for users who write SQL only.

:func:`register` creates temporary functions in a session; their bodies are SQL
(``CREATE FUNCTION ... RETURN``), so Catalyst inlines them into the query like
any expression and no Python runs.  Ladders and thresholds come from the same
:class:`~claimwright.functions.scoring.ScoringConfig` and fixed values as the
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from claimwright.functions import rules as R
from claimwright.functions.scoring import DEFAULT_SCORING, Bands, ScoringConfig


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def _ladder(value: str, bands: Bands, otherwise: object) -> str:
    """SQL of :func:`claimwright.functions.rules.band`."""
    steps = " ".join(f"WHEN {value} {op} {_literal(bound)} THEN {_literal(result)}" for op, bound, result in bands)
    return f"CASE {steps} ELSE {_literal(otherwise)} END"


def definitions(cfg: ScoringConfig = DEFAULT_SCORING) -> dict[str, tuple[str, str, str]]:
    """(parameters, result type, body) of each function."""
    deviation = "CASE WHEN average > 0 THEN CAST(abs(amount - average) / average AS DOUBLE) ELSE 0D END"
    return {
        "split_codes": ("codes STRING", "ARRAY<STRING>",
                        f"CASE WHEN codes IS NOT NULL THEN split(codes, {_literal(R.CODE_SEPARATOR)}) ELSE CAST(array() AS ARRAY<STRING>) END"),
        "mask_email": ("email STRING", "STRING",
                       f"regexp_replace(email, {_literal(R.EMAIL_MASK_PATTERN)}, {_literal(R.EMAIL_MASK_REPLACEMENT)})"),
        "age_years": ("dob DATE, as_of DATE", "BIGINT", f"floor(datediff(as_of, dob) / CAST({R.DAYS_PER_YEAR!r} AS DOUBLE))"),
        "reputation_score": ("total_claims BIGINT", "DOUBLE", _ladder("total_claims", cfg.reputation, cfg.reputation_default)),
        "claim_efficiency_score": ("average_days DOUBLE", "INT",
                                   _ladder("average_days", cfg.claim_efficiency, cfg.claim_efficiency_default)),
        "amount_deviation": ("amount DECIMAL(10,2), average DECIMAL(14,6)", "DOUBLE", deviation),
        "amount_score": ("deviation DOUBLE", "INT", _ladder("deviation", cfg.amount, cfg.part_default)),
        "timing_score": ("days INT", "INT", _ladder("days", cfg.timing, cfg.part_default)),
        "provider_score": ("reputation DOUBLE", "INT", _ladder("reputation", cfg.provider, cfg.part_default)),
        "volume_score": ("claims BIGINT", "INT", _ladder("claims", cfg.volume, cfg.part_default)),
        "fraud_risk_score": ("deviation DOUBLE, days INT, reputation DOUBLE, claims BIGINT", "DOUBLE",
                             "least(" + " + ".join(_ladder(v, b, cfg.part_default) for v, b in (
                                 ("deviation", cfg.amount), ("days", cfg.timing), ("reputation", cfg.provider),
                                 ("claims", cfg.volume))) + f", {_literal(cfg.score_cap)})"),
        "risk_category": ("score DOUBLE", "STRING", _ladder("score", cfg.category, cfg.category_default)),
        "investigation_priority": ("score DOUBLE, amount DECIMAL(10,2)", "STRING",
                                   f"CASE WHEN score >= {cfg.urgent_score!r} AND amount > {cfg.urgent_amount!r} THEN 'URGENT' "
                                   f"ELSE {_ladder('score', cfg.category, cfg.category_default)} END"),
    }


def register(spark: SparkSession, cfg: ScoringConfig = DEFAULT_SCORING, prefix: str = "cw_") -> list[str]:
    """Create the functions ``<prefix><name>`` for this session; returns their names."""
    made = []
    for name, (parameters, result, body) in definitions(cfg).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {body}")
        made.append(prefix + name)
    return made
