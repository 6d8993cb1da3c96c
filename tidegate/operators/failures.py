"""Decide over a log of failures which ones a retry can mend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions import failure
from tidegate.session import small_side


def classify_failures(errors: DataFrame) -> DataFrame:
    """Add ``category`` and ``should_retry`` to every failure."""
    category = failure.failure_category(F.col("error"), F.col("error_type"))
    return (errors.withColumn("category", category)
            .withColumn("should_retry", failure.should_retry(F.col("category"))))


def classify_receive_errors(errors: DataFrame) -> DataFrame:
    return errors.withColumn("error_class", failure.receive_error_class(F.col("error")))


def failure_signatures(errors: DataFrame, order: str = "ts") -> DataFrame:
    """One decision per signature, taken on its first failure, and how often it was used."""
    keyed = errors.withColumn("signature",
                              failure.signature(F.col("error_type"), F.col("error")))
    first = keyed.groupBy("signature").agg(
        F.count(F.lit(1)).alias("failures"), F.min(order).alias("first_at"),
        F.min_by(F.struct("error_type", "error"), order).alias("first"))
    return classify_failures(first.select("signature", "failures", "first_at", "first.*"))


def share_decisions(errors: DataFrame, order: str = "ts") -> DataFrame:
    """Give every failure the decision of the first one with its signature."""
    shared = failure_signatures(errors, order).select("signature", "category", "should_retry")
    return (errors.withColumn("signature",
                              failure.signature(F.col("error_type"), F.col("error")))
            .join(small_side(shared), "signature", "left"))


def backoff_schedule(errors: DataFrame, max_attempts: int = 3, lo: float = 1,
                     hi: float = 10) -> DataFrame:
    """A row per failure and wait between its attempts."""
    low, high = failure.ATTEMPT_BOUNDS
    if not low <= max_attempts <= high:
        raise ValueError(f"max_attempts must be within {low}..{high}, not {max_attempts}")
    waits = (F.sequence(F.lit(1), F.lit(max_attempts - 1)) if max_attempts > 1
             else F.array().cast("array<int>"))
    return (errors.withColumn("retry_attempt", F.explode(waits))
            .withColumn("wait_seconds", failure.backoff_seconds(F.col("retry_attempt"), lo, hi)))


def check_decisions(decisions: DataFrame) -> DataFrame:
    """Add ``in_bounds`` to decisions with ``suggested_wait_seconds`` and ``confidence``."""
    return decisions.withColumn("in_bounds", F.coalesce(failure.within_decision_bounds(
        F.col("suggested_wait_seconds"), F.col("confidence")), F.lit(False)))
