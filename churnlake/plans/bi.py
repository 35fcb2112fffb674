"""Thirteen business questions over the gold tables.

Ordered results break ties by key, so that a top-k is the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions import percent, segment

# The cuts of the reports, highest first.
VALUE_CUTS = ((10000, "High Value"), (1000, "Medium Value"))
BALANCE_CUTS = ((10000, "High Balance"), (1000, "Medium Balance"))
ENGAGEMENT_CUTS = ((20, "Highly Engaged"), (5, "Moderately Engaged"))
RESOLUTION_CUTS = ((48, "48+ hrs"), (24, "24-48 hrs"))


def _customers() -> Column:
    return F.count(F.lit(1)).alias("customers")


def _churned() -> Column:
    return F.sum("is_churned").alias("churned_customers")


def _churn_percent() -> Column:
    return percent(F.avg("is_churned")).alias("churn_rate")


def _share_percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 2)


def highest_value_customers(dim: DataFrame, limit: int = 10) -> DataFrame:
    return (
        dim.select("customer_id", "CLV_LTV", "num_products", "is_churned")
        .orderBy(F.desc("CLV_LTV"), "customer_id")
        .limit(limit)
    )


def churn_by_value_segment(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy(
            segment(F.col("CLV_LTV"), VALUE_CUTS, "Low Value").alias("customer_segment")
        )
        .agg(_customers(), _churned(), _churn_percent())
        .orderBy(F.desc("churn_rate"), "customer_segment")
    )


def _monthly_percent(mart: DataFrame) -> DataFrame:
    return mart.select(
        "activity_month",
        "active_customers",
        "churned_customers",
        percent(F.col("churn_rate")).alias("churn_percentage"),
        "churn_rate",
    )


def worst_churn_months(mart: DataFrame, limit: int = 5) -> DataFrame:
    return (
        _monthly_percent(mart)
        .orderBy(F.desc("churn_rate"), "activity_month")
        .limit(limit)
        .drop("churn_rate")
    )


def churn_trend(mart: DataFrame) -> DataFrame:
    return _monthly_percent(mart).orderBy("activity_month").drop("churn_rate")


def most_supported_customers(fact: DataFrame, dim: DataFrame, limit: int = 10) -> DataFrame:
    """The mean is taken over the months of a customer, quiet ones included.

    Every fact row has its customer, so the top is taken before the join.
    """
    per_customer = fact.groupBy("cust_key", "customer_id").agg(
        F.sum("ticket_count").alias("total_tickets"),
        F.round(F.avg("avg_resolution_time"), 2).alias("avg_resolution_time"),
    )
    order = (F.desc("total_tickets"), "customer_id")
    return (
        per_customer.orderBy(*order)
        .limit(limit)
        .join(dim.select("cust_key", "CLV_LTV", "is_churned"), "cust_key")
        .orderBy(*order)
        .select("customer_id", "total_tickets", "avg_resolution_time", "CLV_LTV", "is_churned")
    )


def churn_by_resolution_time(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """A customer counts once in every group one of their months falls into.

    Months are first reduced to one row per group and customer, which takes the
    place of two distinct counts.
    """
    group = segment(F.col("avg_resolution_time"), RESOLUTION_CUTS, "Less than 24 hrs")
    members = fact.select(group.alias("resolution_group"), "cust_key").distinct()
    return (
        members.join(dim.select("cust_key", "is_churned"), "cust_key")
        .groupBy("resolution_group")
        .agg(_customers(), F.count_if(F.col("is_churned") == 1).alias("churned_customers"))
        .withColumn(
            "churn_rate", _share_percent(F.col("churned_customers"), F.col("customers"))
        )
        .orderBy(F.desc("churn_rate"), "resolution_group")
    )


def offer_effectiveness(fact: DataFrame) -> DataFrame:
    """Accepted offers over all offers, not the mean of the monthly rates."""
    return fact.agg(
        F.sum("offer_count").alias("total_offers"),
        F.sum("accepted_offers").alias("accepted_offers"),
    ).withColumn(
        "acceptance_rate", _share_percent(F.col("accepted_offers"), F.col("total_offers"))
    )


def value_by_products(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("num_products")
        .agg(_customers(), F.round(F.avg("CLV_LTV"), 2).alias("avg_clv"), _churn_percent())
        .orderBy("num_products")
    )


def _churn_by_customer_total(
    fact: DataFrame,
    dim: DataFrame,
    measure: str,
    cuts: tuple[tuple[float, str], ...],
    otherwise: str,
    name: str,
    key: str,
) -> DataFrame:
    """``key`` names the customer in both tables; one that they are laid out by
    saves the shuffles."""
    totals = fact.groupBy(key).agg(F.sum(measure).alias("total"))
    return (
        totals.join(dim.select(key, "is_churned"), key)
        .groupBy(segment(F.col("total"), cuts, otherwise).alias(name))
        .agg(_customers(), _churned(), _churn_percent())
        .orderBy(F.desc("churn_rate"), name)
    )


def churn_by_balance(fact: DataFrame, dim: DataFrame, key: str = "customer_id") -> DataFrame:
    return _churn_by_customer_total(
        fact, dim, "total_balance", BALANCE_CUTS, "Low Balance", "balance_segment", key
    )


def churn_by_engagement(fact: DataFrame, dim: DataFrame, key: str = "customer_id") -> DataFrame:
    return _churn_by_customer_total(
        fact, dim, "usage_events", ENGAGEMENT_CUTS, "Low Engagement", "engagement_segment", key
    )


def churn_by_products(dim: DataFrame) -> DataFrame:
    return (
        dim.groupBy("num_products")
        .agg(
            _customers(),
            _churned(),
            _churn_percent(),
            F.round(F.avg("CLV_LTV"), 2).alias("average_clv"),
        )
        .orderBy("num_products")
    )


def retention_priorities(fact: DataFrame, dim: DataFrame, limit: int = 20) -> DataFrame:
    """Staying customers of value who hardly use their products."""
    engagement = (
        fact.groupBy("customer_id")
        .agg(
            F.sum("usage_events").alias("total_usage"),
            F.sum("ticket_count").alias("total_tickets"),
        )
        .where(F.col("total_usage") < 5)
    )
    worth_keeping = dim.where((F.col("is_churned") == 0) & (F.col("CLV_LTV") >= 1000))
    return (
        worth_keeping.join(engagement, "customer_id")
        .orderBy(F.desc("CLV_LTV"), "customer_id")
        .limit(limit)
        .select(
            "customer_id", "CLV_LTV", "num_products", "total_usage", "total_tickets", "is_churned"
        )
    )


def risk_segments(fact: DataFrame, dim: DataFrame) -> DataFrame:
    totals = fact.groupBy("cust_key").agg(
        F.sum("usage_events").alias("total_usage"),
        F.sum("ticket_count").alias("total_tickets"),
    )
    metrics = (
        dim.select("cust_key", "CLV_LTV", "is_churned")
        .join(totals, "cust_key", "left")
        .fillna(0, ["total_usage", "total_tickets"])
    )
    value, usage = F.col("CLV_LTV"), F.col("total_usage")
    risk = (
        F.when(F.col("is_churned") == 1, "Already Churned")
        .when((value >= 10000) & (usage < 5), "High Value - High Risk")
        .when((value >= 1000) & (usage < 5), "Medium Value - High Risk")
        .when(usage >= 20, "Highly Engaged")
        .otherwise("Stable Customer")
    )
    return (
        metrics.groupBy(risk.alias("customer_segment"))
        .agg(
            _customers(),
            F.round(F.avg("CLV_LTV"), 2).alias("average_clv"),
            F.round(F.avg("total_usage"), 2).alias("average_usage"),
            F.round(F.avg("total_tickets"), 2).alias("average_tickets"),
        )
        .orderBy(F.desc("customers"), "customer_segment")
    )
