"""Filters that say why a record is left out, and set comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_reason(reasons: list[tuple[str, Column]]) -> Column:
    """The first reason that holds; null for a record that passes. A null condition doesn't hold."""
    out = F.lit(None).cast("string")
    for name, holds in reversed(reasons):
        out = F.when(F.coalesce(holds, F.lit(False)), name).otherwise(out)
    return out


def trajectory_reason(df: DataFrame, exclude_errors: bool = False, min_turns: int | None = None, max_turns: int | None = None, model: str | None = None, example_id: str | None = None) -> Column:
    """Why a rollout is left out: a reward other than 1, then errors, too few or too many turns, another model or example."""
    turns = F.coalesce(F.col("num_turns"), F.lit(0)) if "num_turns" in df.columns else F.lit(0)
    reasons = [("failed", ~F.coalesce(F.col("reward") == 1.0, F.lit(False)))]
    if exclude_errors and "has_error" in df.columns:
        reasons.append(("excluded_by_error", F.col("has_error") == 1.0))
    if min_turns is not None:
        reasons.append(("excluded_by_min_turns", turns < min_turns))
    if max_turns is not None:
        reasons.append(("excluded_by_max_turns", turns > max_turns))
    for name, wanted in (("model", model), ("example_id", example_id)):
        if wanted is not None:
            reasons.append((f"excluded_by_{name}", ~F.col(name).eqNullSafe(F.lit(wanted)) if name in df.columns else F.lit(True)))
    return first_reason(reasons)


def reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    """(reason, n), 'passed' for the records kept."""
    return df.groupBy(F.coalesce(reason, F.lit("passed")).alias("reason")).agg(F.count("*").alias("n"))


def without(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in done; null keys stay."""
    return df.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def expected_against_actual(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of one and not of the other, with `state` missing or unexpected."""
    return expected.exceptAll(actual).withColumn("state", F.lit("missing")).unionByName(actual.exceptAll(expected).withColumn("state", F.lit("unexpected")))
