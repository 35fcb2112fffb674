"""A lookup join that stays balanced when one key holds a large share of rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.scratch import stage

# Rows without a key match nothing; they are dealt out over this many salts.
NULL_SALTS = 1 << 20


def hot_keys(df: DataFrame, key: str, width: int | None = None) -> DataFrame:
    """(key, splits) of the keys with more than a task's share of the rows.

    ``width`` is the number of tasks, by default that of the shuffle. Since the
    rows of all keys add up, at most ``width`` keys can be hot. Rows are counted
    once; the counts per key are stored.
    """
    if width is None:
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stage(
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")),
        "key-counts",
    )
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    share = max(1, math.ceil(total / width))
    splits = F.ceil(F.col("_rows") / share).cast("long")
    return counts.where(F.col("_rows") > share).select(key, splits.alias("_splits"))


def spread_lookup(
    df: DataFrame, lookup: DataFrame, key: str, row_id: Column, hot: DataFrame
) -> DataFrame:
    """Left join of ``df`` with ``lookup``, which has one row per ``key``.

    Rows of a hot key are dealt out over its splits by the hash of their id,
    and the lookup row is repeated once per split. The hash makes a task that
    runs again deal the same way. ``hot`` has at most as many rows as the shuffle
    has tasks, so broadcasting it is safe at any scale. Without hot keys nothing is
    repeated, and the optimizer sees how large ``lookup`` is before rows are shuffled.
    """
    if hot.isEmpty():
        # Not a plain 0, which would no longer be a key of the join.
        unsalted = lookup.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1).cast("long")))
        salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(row_id), F.lit(NULL_SALTS)))
        dealt = df.withColumn("_salt", F.coalesce(salt, F.lit(0).cast("long")))
        return dealt.join(unsalted, [key, "_salt"], "left").drop("_salt")
    small = F.broadcast(hot)
    salt = (
        F.when(F.col(key).isNull(), F.pmod(F.xxhash64(row_id), F.lit(NULL_SALTS)))
        .when(F.col("_splits").isNotNull(), F.pmod(F.xxhash64(row_id), F.col("_splits")))
        .otherwise(F.lit(0).cast("long"))
    )
    dealt = df.join(small, key, "left").withColumn("_salt", salt).drop("_splits")
    repeated = (
        lookup.join(small, key, "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_splits", F.lit(1)) - 1)),
        )
        .drop("_splits")
    )
    return dealt.join(repeated, [key, "_salt"], "left").drop("_salt")
