"""Arrival order: rows numbered as if their files were read one after the other.

A row's arrival is its file's modification time and path, the byte at which the
block it was read from starts, and its place in that block. Whatever the cluster
cuts files into, blocks and places follow the bytes of the file, so the order does
not depend on it, and neither does the dense number made from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.scratch import stage

SOURCE_ID = "_source_id"

BLOCK = ("modified", "path", "block")


def file_arrival() -> Column:
    """The arrival of a row that comes straight from a file scan."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def number_arrivals(stored: DataFrame, name: str = SOURCE_ID) -> DataFrame:
    """``stored`` with its arrivals in ``name`` replaced by 1..n in their order.

    The places of a block must follow each other without gaps, as they do when a
    scan is stored before a row is dropped, and they must be stored: a scan may be
    cut differently the next time. Rows are not shuffled; the window without
    partitions and the joined table have one row per file block. That table is stored,
    so the optimizer knows its size before it plans the join, and picks a broadcast
    while it is small.
    """
    arrival = F.col(name)
    rows = stored.select(
        *[column for column in stored.columns if column != name],
        *[arrival[part].alias(f"_{part}") for part in (*BLOCK, "place")],
    )
    keys = [f"_{part}" for part in BLOCK]
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy(*keys)
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    number = F.col("_before") + F.col("_place") - F.col("_first") + 1
    others = [column for column in stored.columns if column != name]
    return rows.join(stage(blocks, "arrival-blocks"), keys).select(*others, number.alias(name))
