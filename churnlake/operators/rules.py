"""Declarative row validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "rejection_reason"


@dataclass(frozen=True)
class Rule:
    """A predicate a good row satisfies, and the reason given when it does not.

    A predicate that is NULL counts as not satisfied.
    """

    reason: str
    holds: Column


def first_failure(rules: Sequence[Rule]) -> Column:
    """The reason of the first rule a row fails, NULL for a good row."""
    return F.coalesce(
        *[F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.reason)) for rule in rules]
    )


def judge(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(REASON, first_failure(rules))
