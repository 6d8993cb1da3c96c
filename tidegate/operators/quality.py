"""Split rows by the validity of the names they carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.names import ROUTING_RULES


def checked(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Add ``reasons``, the rules a row breaks, and ``valid``.

    A missing name breaks its rule. Rules on columns the frame lacks are left out.
    """
    rules = ROUTING_RULES if rules is None else rules
    broken = [F.when(~F.coalesce(rule(F.col(column)), F.lit(False)), F.lit(name))
              for name, (column, rule) in rules.items() if column in df.columns]
    reasons = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return (df.withColumn("reasons", reasons)
            .withColumn("valid", F.size("reasons") == 0))


def quarantine(df: DataFrame, rules: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the others with their ``reasons``."""
    marked = checked(df, rules)
    return (marked.where("valid").drop("reasons", "valid"),
            marked.where("NOT valid").drop("valid"))
