"""Data-quality checks; each counts offenders, and a good table has none."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.standardize import NORMAL_MONTH
from churnlake.operators.keys import orphan_keys


class QualityError(RuntimeError):
    """A quality check found offenders."""


def _is_null(name: str) -> Column:
    return F.col(name).isNull()


def _negative(name: str) -> Column:
    return F.col(name) < 0


def _outside_unit(name: str) -> Column:
    return (F.col(name) < 0) | (F.col(name) > 1)


def dim_checks() -> dict[str, Column]:
    return {
        "null_cust_key": _is_null("cust_key"),
        "null_customer_id": _is_null("customer_id"),
        "invalid_is_churned": ~F.coalesce(F.col("is_churned").isin(0, 1), F.lit(False)),
        "negative_clv_ltv": _negative("CLV_LTV"),
        "negative_avg_ticket_res_time": _negative("avg_ticket_res_time_hrs"),
    }


def fact_checks() -> dict[str, Column]:
    good_month = F.col("activity_month").rlike(NORMAL_MONTH)
    return {
        "null_activity_key": _is_null("activity_key"),
        "null_cust_key": _is_null("cust_key"),
        "null_customer_id": _is_null("customer_id"),
        "invalid_activity_month": ~F.coalesce(good_month, F.lit(False)),
        "invalid_acceptance_rate": _outside_unit("acceptance_rate"),
        "negative_usage_events": _negative("usage_events"),
        "negative_total_balance": _negative("total_balance"),
        "negative_ticket_count": _negative("ticket_count"),
        "negative_offer_count": _negative("offer_count"),
        "negative_accepted_offers": _negative("accepted_offers"),
        "accepted_above_offered": F.col("accepted_offers") > F.col("offer_count"),
    }


def mart_checks() -> dict[str, Column]:
    return {
        "invalid_churn_rate": _outside_unit("churn_rate"),
        "churned_above_active": F.col("churned_customers") > F.col("active_customers"),
    }


DIM_UNIQUE = {"duplicate_cust_key": ["cust_key"], "duplicate_customer_id": ["customer_id"]}
FACT_UNIQUE = {
    "duplicate_activity_key": ["activity_key"],
    "duplicate_customer_month": ["customer_id", "activity_month"],
}


def row_offenders(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, offenders) of all row checks, in one pass over ``df``."""
    return df.agg(
        *[F.count_if(broken).alias(name) for name, broken in checks.items()]
    ).unpivot([], list(checks), "check_name", "offenders")


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("rows_in_group"))
        .where(F.col("rows_in_group") > 1)
    )


def _counted(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("offenders")).select(
        F.lit(name).alias("check_name"), "offenders"
    )


def table_offenders(
    df: DataFrame, table: str, checks: dict[str, Column], unique: dict[str, list[str]]
) -> DataFrame:
    parts = [row_offenders(df, checks)]
    parts += [
        _counted(duplicate_groups(df, columns), name) for name, columns in unique.items()
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.select(F.lit(table).alias("table_name"), "check_name", "offenders")


def quality_report(dim: DataFrame, fact: DataFrame, mart: DataFrame) -> DataFrame:
    """All checks as (table_name, check_name, offenders, status)."""
    orphans = _counted(orphan_keys(fact, dim, "cust_key"), "orphan_cust_key").select(
        F.lit("fact_customer_activity").alias("table_name"), "check_name", "offenders"
    )
    report = reduce(
        DataFrame.unionByName,
        [
            table_offenders(dim, "dim_customer", dim_checks(), DIM_UNIQUE),
            table_offenders(fact, "fact_customer_activity", fact_checks(), FACT_UNIQUE),
            orphans,
            table_offenders(mart, "monthly_churn_rate", mart_checks(), {}),
        ],
    )
    return report.withColumn(
        "status", F.when(F.col("offenders") == 0, "PASS").otherwise("CHECK")
    )


def require_passed(report: DataFrame) -> None:
    """Raise when a check failed; the report has a fixed number of rows."""
    failed = [
        f"{row.table_name}.{row.check_name}={row.offenders}"
        for row in report.where(F.col("status") != "PASS").collect()
    ]
    if failed:
        raise QualityError("quality checks failed: " + ", ".join(failed))
