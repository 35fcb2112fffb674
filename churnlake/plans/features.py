"""Customer-level features for the churn model, from the gold tables.

The monthly mart stays out: it is computed from the label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.operators.keys import dense_key

LABEL = "is_churned"

# A label with more values than this is not a class label.
MAX_CLASSES = 100

# The candidate features of the model.
FEATURES = (
    "CLV_LTV",
    "avg_ticket_res_time_hrs",
    "num_products",
    "months_active",
    "total_usage_events",
    "avg_usage_events",
    "avg_total_balance",
    "avg_balance_mean",
    "total_tickets",
    "avg_resolution_time_mean",
    "total_offers",
    "total_accepted_offers",
    "avg_acceptance_rate",
    "last_usage_events",
    "last_total_balance",
    "last_ticket_count",
)


def last_activity(fact: DataFrame) -> DataFrame:
    """Measures of the latest month of each customer; a month occurs once."""
    return fact.groupBy("customer_id").agg(
        *[
            F.max_by(measure, "activity_month").alias(f"last_{measure}")
            for measure in ("usage_events", "total_balance", "ticket_count")
        ]
    )


def activity_features(fact: DataFrame) -> DataFrame:
    """All activity features in one aggregation.

    Months are counted as rows, the fact having one per customer and month.
    """
    return fact.groupBy("customer_id").agg(
        F.count("activity_month").alias("months_active"),
        F.sum("usage_events").alias("total_usage_events"),
        F.avg("usage_events").alias("avg_usage_events"),
        F.avg("total_balance").alias("avg_total_balance"),
        F.avg("avg_balance").alias("avg_balance_mean"),
        F.sum("ticket_count").alias("total_tickets"),
        F.avg("avg_resolution_time").alias("avg_resolution_time_mean"),
        F.sum("offer_count").alias("total_offers"),
        F.sum("accepted_offers").alias("total_accepted_offers"),
        F.avg("acceptance_rate").alias("avg_acceptance_rate"),
        F.max_by("usage_events", "activity_month").alias("last_usage_events"),
        F.max_by("total_balance", "activity_month").alias("last_total_balance"),
        F.max_by("ticket_count", "activity_month").alias("last_ticket_count"),
    )


def customer_features(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per customer; activity features are NULL without activity."""
    return dim.join(activity_features(fact), "customer_id", "left").select(
        "customer_id", LABEL, *FEATURES
    )


def class_counts(df: DataFrame, label: str = LABEL) -> dict[int, int]:
    """Rows per class, collected; refuses a label that has too many values."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("members"))
    rows = counts.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")
    return {row[label]: row.members for row in rows}


def class_balance(features: DataFrame, label: str = LABEL) -> DataFrame:
    """The share of each class, of the rows in all classes."""
    total = sum(class_counts(features, label).values())
    counts = features.groupBy(label).agg(F.count(F.lit(1)).alias("customers"))
    return counts.withColumn("share", F.col("customers") / F.lit(total)).orderBy(label)


def label_correlation(
    features: DataFrame, columns: tuple[str, ...] = FEATURES, label: str = LABEL
) -> DataFrame:
    """Pearson correlation of every column with the label, in one pass.

    A row counts for a pair when both values are present.
    """
    return (
        features.agg(
            *[F.corr(F.col(name).cast("double"), label).alias(name) for name in columns]
        )
        .unpivot([], list(columns), "feature", "correlation")
        .orderBy(F.desc_nulls_last("correlation"), "feature")
    )


def missing_values(features: DataFrame) -> DataFrame:
    """NULL cells over all columns."""
    per_column = [F.count_if(F.col(name).isNull()) for name in features.columns]
    total = per_column[0]
    for count in per_column[1:]:
        total = total + count
    return features.agg(total.alias("missing_values"))


def stratified_split(
    features: DataFrame,
    test_share: float = 0.2,
    seed: int = 42,
    row_id: str = "customer_id",
    label: str = LABEL,
) -> DataFrame:
    """Add ``split``: 'test' for the same share of every class, else 'train'.

    Rows are numbered by class and by the hash of their id; the first rows of
    each class are its test set. The numbers come from a range sort, so a class
    is never sorted in one task, and the split is the same in every run. The
    label must not be NULL.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))
    numbered = dense_key(
        features.withColumn("_draw", draw), [label, "_draw", row_id], "_place"
    )
    test_until, place = {}, 0
    members = class_counts(numbered, label)
    for value in sorted(members):
        test_until[value] = place + round(members[value] * test_share)
        place += members[value]
    is_test = F.lit(False)
    for value, last in test_until.items():
        is_test = is_test | ((F.col(label) == value) & (F.col("_place") <= last))
    return numbered.select(
        *features.columns, F.when(is_test, "test").otherwise("train").alias("split")
    )
