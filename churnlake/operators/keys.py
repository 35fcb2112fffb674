"""Dense surrogate keys and foreign-key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.operators.skew import hot_keys, spread_lookup
from churnlake.scratch import stage

# monotonically_increasing_id keeps the partition above bit 33 and the place
# within the partition below it.
PLACE_BITS = 33


def dense_key(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1..n in the order of ``order_by``, which must be unique.

    A global ``row_number`` sorts the whole table in one task. Here the rows
    are range-partitioned, numbered within their partition and stored, which
    freezes the partitions; then each partition is shifted by the number of
    rows before it. Split points are sampled from the whole ordering, so
    clustered ids or a heavy leading column do not make a partition heavy.
    The offset table has one row per partition, hence the broadcast and the
    unpartitioned window over it are bounded by the shuffle width.
    """
    slot = F.col("_slot")
    frozen = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()),
        name,
    ).withColumn("_part", F.shiftright(slot, PLACE_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frozen.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = slot.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return frozen.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + place + 1).alias(name)
    )


def key_reference(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL values of ``key``."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def flag_known_keys(
    df: DataFrame,
    key: str,
    reference: DataFrame,
    row_id: Column,
    flag: str,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: true where ``key`` is in ``reference``, else NULL.

    ``reference`` has one row per key. Hot keys are counted on ``counted_on``
    where a stored table with the same keys is cheaper to read than ``df``.
    """
    lookup = reference.select(F.col(reference.columns[0]).alias(key)).withColumn(
        flag, F.lit(True)
    )
    hot = hot_keys(df if counted_on is None else counted_on, key)
    return spread_lookup(df, lookup, key, row_id, hot)


def keep_known_keys(df: DataFrame, key: str, reference: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in ``reference``; ``df`` holds few rows per key."""
    return df.join(reference.select(key), key, "left_semi")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys without a parent; NULL is one of them."""
    return child.select(key).distinct().join(parent.select(key).distinct(), key, "left_anti")


def orphan_row_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: child rows without a parent. Rows are counted per key before
    the join, so neither a hot key nor a NULL key makes a task heavy."""
    return (
        child.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .join(parent.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"))
    )
