"""Exact-copy and business-key deduplication.

Both are aggregations, not windows: a window would sort every copy of a row,
or every row of a key, in one task. An aggregation combines on the map side,
so a group that holds a third of the table costs its reducer one row per map
task.

Where no key holds more than a task's share of the rows, ``deal_by_key`` brings
the rows of a key together once, and both are done there: the rows are shuffled
once in place of three times.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.operators.rules import REASON

COPIES = "_copies"
EXACT_DUPLICATE = "exact_duplicate"

# Copies written by one row of the intermediate table in ``surplus_copies``.
COPIES_PER_CHUNK = 100_000

# What ``deal_by_key`` deals the rows out by.
DEAL = "_deal"

# Keys are counted in so many groups, far more than a shuffle has tasks.
DEAL_GROUPS = 1 << 13

# A group of keys with no more rows than this is light on any cluster.
LIGHT_ROWS = 100_000

# Rows of a task when rows are dealt out by key. A task holds its rows as groups and
# sorted, which takes nearly a kilobyte each.
ROWS_PER_TASK = 500_000


def collapse_copies(df: DataFrame, columns: Sequence[str], order_col: str) -> DataFrame:
    """One row per distinct content, with the arrival id of the first copy and
    the number of copies."""
    return df.groupBy(*columns).agg(
        F.min(order_col).alias(order_col), F.count(F.lit(1)).alias(COPIES)
    )


def surplus_copies(collapsed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every copy beyond the first as a row of its own, marked as duplicate.

    Copies are equal in all ``columns``, so they are counted out again rather
    than carried through the shuffle. A large group is cut into chunks and the
    chunks are dealt out first; the partition number is given, so that AQE does
    not merge chunks that are small before they are counted out.
    """
    spark = collapsed.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    surplus = F.col(COPIES) - 1
    last_chunk = F.floor((surplus - 1) / COPIES_PER_CHUNK).cast("long")
    chunks = (
        collapsed.where(F.col(COPIES) > 1)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
        .withColumn(
            "_size",
            F.least(
                F.lit(COPIES_PER_CHUNK).cast("long"),
                surplus - F.col("_chunk") * COPIES_PER_CHUNK,
            ),
        )
        .select(*columns, "_chunk", "_size")
        .repartition(partitions, *columns, "_chunk")
    )
    return (
        chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_size"))))
        .select(*columns)
        .withColumn(REASON, F.lit(EXACT_DUPLICATE))
    )


def mark_key_duplicates(
    df: DataFrame, key: str, order_col: str, reason: str, eligible: Column | None = None
) -> DataFrame:
    """Give ``reason`` to every eligible row that is not the first of its key.

    The first rows are joined back on key and arrival id together; arrival ids
    are unique, so no task gets a whole hot key.
    """
    competes = F.lit(True) if eligible is None else eligible
    first = (
        df.where(competes)
        .groupBy(key)
        .agg(F.min(order_col).alias(order_col))
        .select(key, order_col, F.lit(True).alias("_first"))
    )
    beaten = competes & F.col("_first").isNull()
    return (
        df.join(first, [key, order_col], "left")
        .withColumn(REASON, F.when(beaten, F.lit(reason)).otherwise(F.col(REASON)))
        .drop("_first")
    )


def tasks_by_key(df: DataFrame, key: str, other: str) -> int | None:
    """How many tasks to deal the rows out over by ``key``, or None if a key, with its
    copies, is too much for one of them. Rows without key are dealt out by ``other``.

    Keys are counted in groups of their hash, which combine on the map side.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(DEAL_GROUPS, 16 * width)
    group = F.pmod(_deal(key, other), F.lit(groups))
    counts = df.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_rows"))
    found = counts.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("largest")).first()
    total = found.total or 0
    tasks = min(max(1, math.ceil(total / ROWS_PER_TASK)), groups // 16)
    if total and found.largest > max(LIGHT_ROWS, math.ceil(total / max(width, tasks))):
        return None
    return tasks


def _deal(key: str, other: str) -> Column:
    """Rows without key go by another column, so that copies of them are together too."""
    return F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(other))


def deal_by_key(df: DataFrame, key: str, other: str, tasks: int) -> DataFrame:
    """The rows of a key, and all copies of a row, in one task; adds ``DEAL``, which
    groups and windows must name to stay there. ``tasks`` is what ``tasks_by_key`` found."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    dealt = df.withColumn(DEAL, _deal(key, other))
    # AQE merges small partitions until there is one a core, but leaves a given number
    # of partitions as it is.
    return dealt.repartition(tasks, DEAL) if tasks > cores else dealt.repartition(DEAL)


def mark_dealt_duplicates(
    df: DataFrame, key: str, order_col: str, reason: str, eligible: Column
) -> DataFrame:
    """What ``mark_key_duplicates`` does, for rows that ``deal_by_key`` dealt out."""
    of_key = Window.partitionBy(DEAL, key)
    first = F.min(F.when(eligible, F.col(order_col))).over(of_key)
    is_first = F.col(key).isNotNull() & F.coalesce(F.col(order_col) == first, F.lit(False))
    return df.withColumn(
        REASON, F.when(eligible & ~is_first, F.lit(reason)).otherwise(F.col(REASON))
    )
