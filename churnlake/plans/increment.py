"""Gold kept up to date: the rollup as mergeable state, the fact by month.

The activity rollup holds sums and counts only, so the rollup of the rows that came
can be added to it, and that of the rows that went subtracted. A month of the fact
follows from the rollup of that month; only months that changed are built again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.operators.keys import dense_key
from churnlake.plans.gold import (
    ACTIVITIES,
    ACTIVITY_KEY,
    FACT_COLUMNS,
    activity_rollup,
    filled_measures,
)
from churnlake.publish import Commit, current, publish_parts, read_parts
from churnlake.scratch import stage

COUNTS = [f"{source}_rows" for source in ACTIVITIES]
SUMS = [name for activity in ACTIVITIES.values() for name in activity.sums]

# Sums of values, and the count that tells whether there were any.
_COUNT_OF = {name: name.replace("_sum", "_rows") for name in SUMS if name.endswith("_sum")}

Sources = Sequence[DataFrame]


def merge_rollups(*signed: tuple[DataFrame, int]) -> DataFrame:
    """The rollup of several rollups, each added (1) or subtracted (-1).

    One aggregation; a customer's month without rows left disappears, and a sum
    without values is NULL, as if it had been built from the rows that are left.
    """
    parts = [
        rollup.select(
            *ACTIVITY_KEY, *[(F.col(name) * sign).alias(name) for name in (*COUNTS, *SUMS)]
        )
        for rollup, sign in signed
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    merged = stacked.groupBy(*ACTIVITY_KEY).agg(
        *[F.sum(name).alias(name) for name in (*COUNTS, *SUMS)]
    )
    emptied = {
        total: F.when(F.col(count) > 0, F.col(total)) for total, count in _COUNT_OF.items()
    }
    return merged.where(F.greatest(*COUNTS) > 0).withColumns(emptied)


def update_rollup(rollup: DataFrame, added: Sources, removed: Sources | None = None) -> DataFrame:
    """``rollup`` after rows came and went; usage, tickets and offers each.

    A replaced row is one that went and one that came. Only the rows of the change
    are read besides the rollup.
    """
    signed = [(rollup, 1), (activity_rollup(*added), 1)]
    if removed is not None:
        signed.append((activity_rollup(*removed), -1))
    return merge_rollups(*signed)


def changed_months(added: Sources, removed: Sources | None = None) -> list[str]:
    """The months with rows that came or went; there are few months."""
    change = activity_rollup(*added)
    if removed is not None:
        change = change.unionByName(activity_rollup(*removed))
    months = change.where("activity_month is not null").select("activity_month").distinct()
    return sorted(row[0] for row in months.collect())


# --- the fact, a part a month -------------------------------------------


def _known(rollup: DataFrame, dim: DataFrame) -> DataFrame:
    return filled_measures(rollup).join(
        dim.select("customer_id", "cust_key"), "customer_id"
    )


def store_fact(spark: SparkSession, folder: str, rollup: DataFrame, dim: DataFrame) -> Commit:
    """Build the whole fact and publish it with a part for each month."""
    keyed = dense_key(_known(rollup, dim), list(ACTIVITY_KEY), "activity_key")
    return publish_parts(spark, folder, keyed.select(*FACT_COLUMNS), "activity_month")


def _renumbered(rows: DataFrame, before: DataFrame, last: int) -> DataFrame:
    """``rows`` with their keys: those there before keep theirs, new ones take the
    keys of rows that are gone, in order, and then go on after ``last``."""
    own = before.select(*ACTIVITY_KEY, "activity_key")
    joined = stage(rows.join(own, list(ACTIVITY_KEY), "left"), "rejoined")
    new = dense_key(
        joined.where("activity_key is null").drop("activity_key"), list(ACTIVITY_KEY), "_new"
    )
    gone = own.join(rows.select(*ACTIVITY_KEY), list(ACTIVITY_KEY), "left_anti")
    free = dense_key(
        gone.select(F.col("activity_key").alias("_free")), ["_free"], "_new"
    )
    freed = stage(free, "freed-keys")
    count = freed.count()
    numbered = new.join(freed, "_new", "left").withColumn(
        "activity_key", F.coalesce("_free", F.col("_new") - count + last)
    )
    return joined.where("activity_key is not null").unionByName(numbered.drop("_new", "_free"))


def update_fact(
    spark: SparkSession, folder: str, rollup: DataFrame, dim: DataFrame, months: Sequence[str]
) -> Commit:
    """Build the given months of the stored fact again from the updated ``rollup``.

    The other months stay the files they are; old and new parts become the current
    set at once. Activity keys are unique and stable: a customer's month keeps its
    key for as long as it is there. They have no gaps unless more rows went than came.
    """
    commit = current(spark, folder)
    if commit is None:
        raise FileNotFoundError(f"no fact in {folder}")
    touched = F.col("activity_month").isin(list(months))
    whole = read_parts(spark, commit)
    last = whole.agg(F.max("activity_key")).first()[0] or 0
    rows = _known(rollup.where(touched), dim)
    keyed = _renumbered(rows, whole.where(touched), last)
    return publish_parts(
        spark, folder, keyed.select(*FACT_COLUMNS), "activity_month", values=list(months)
    )
