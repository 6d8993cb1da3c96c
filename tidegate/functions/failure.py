"""Rules that turn an error message into a decision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of failures that a retry cannot mend, by category, in order of test.
FATAL = {
    "auth": r"\b401\b|\b403\b|unauthori[sz]ed|authentication|authori[sz]ation|forbidden|access denied",
    "schema": r"schema mismatch|constraint",
    "format": r"invalid (data )?format|type error|data type",
    "quota": r"quota exceeded",
    "not_found": r"\b404\b|not found|does not exist",
    "syntax": r"syntax error",
    "configuration": r"configuration",
    "bad_request": r"\b400\b|malformed|bad request",
    "validation": r"validation",
}

# Wording of failures worth a retry, by category, in order of test.
RETRYABLE = {
    "network": r"time(d)?[ -]?out|connection (error|reset|refused|lost|closed|aborted)|network",
    "unavailable": r"\b503\b|\b429\b|unavailable",
    "busy": r"locked|busy",
    "transient": r"transient|temporar",
    "rate_limit": r"rate limit|throttl",
    "dns": r"\bdns\b|name resolution",
    "pool": r"pool (is )?exhaust",
}

# Phrases of a receive error that point at credentials or at permissions.
CREDENTIAL_PHRASES = [
    "credential",
    "failed to invoke azure cli",
    "failed to retrieve a token",
    "defaultazurecredential failed",
    "authentication unavailable",
]
PERMISSION_PHRASES = [
    "unauthorized",
    "not authorized",
    "authenticationerror",
    "permission",
    "access denied",
    "forbidden",
    "401",
    "403",
]

# Bounds of a retry decision and of the number of attempts.
WAIT_BOUNDS = (1, 60)
CONFIDENCE_BOUNDS = (0.0, 1.0)
ATTEMPT_BOUNDS = (1, 10)
SIGNATURE_CHARS = 100


def failure_category(error: Column, error_type: Column | None = None) -> Column:
    """Category of a failure: fatal wording is looked for first, ``unknown`` if nothing fits."""
    text = F.lower(F.coalesce(error, F.lit("")))
    if error_type is not None:
        text = F.concat_ws(" ", F.lower(error_type), text)
    chosen = F.lit("unknown")
    for name, pattern in reversed(list({**FATAL, **RETRYABLE}.items())):
        chosen = F.when(text.rlike(pattern), F.lit(name)).otherwise(chosen)
    return chosen


def should_retry(category: Column) -> Column:
    """Only a known transient category is retried."""
    return category.isin(*RETRYABLE)


def receive_error_class(error: Column) -> Column:
    text = F.lower(F.coalesce(error, F.lit("")))

    def mentions(phrases: list[str]) -> Column:
        found = F.lit(False)
        for phrase in phrases:
            found = found | text.contains(phrase)
        return found

    return (F.when(mentions(CREDENTIAL_PHRASES), "credential")
            .when(mentions(PERMISSION_PHRASES), "rbac")
            .otherwise("other"))


def signature(error_type: Column, error: Column) -> Column:
    """Failures with equal type and equal first 100 characters share one decision."""
    return F.concat(error_type, F.lit(":"), F.substring(error, 1, SIGNATURE_CHARS))


def backoff_seconds(attempt: Column, lo: float, hi: float) -> Column:
    """Wait after a failed attempt: doubling from one second, kept within ``lo..hi``."""
    return F.greatest(F.lit(float(lo)),
                      F.least(F.lit(float(hi)), F.pow(F.lit(2.0), attempt - 1)))


def within_decision_bounds(wait: Column, confidence: Column) -> Column:
    return wait.between(*WAIT_BOUNDS) & confidence.between(*CONFIDENCE_BOUNDS)
