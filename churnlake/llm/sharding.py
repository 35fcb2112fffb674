"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` cells. Every shard owns virtual nodes at hashed
cells, and a key belongs to the shard of the first virtual node at or clockwise
of its cell. A shard takes no more rows than its capacity; what overflows goes
on clockwise to the next virtual node whose shard has room.

Only the number of rows per cell leaves the executors: at most ``CELLS`` counts,
whatever the input. From them the driver lays out which ranks of each cell go
to which shard and slot, and the rows look their rank up in that layout.
"""

from __future__ import annotations

import bisect
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlake.operators.keys import dense_key
from churnlake.scratch import stage

CELLS = 1 << 14
VIRTUAL_NODES = 64

_LAYOUT = T.StructType(
    [
        T.StructField("cell", T.IntegerType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("base", T.LongType()),
        T.StructField("start", T.LongType()),
    ]
)


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes, clockwise; a node's place depends on
    its shard and number only."""
    return sorted(
        (zlib.crc32(f"shard {shard} node {node}".encode()) % CELLS, shard)
        for shard in range(shards)
        for node in range(virtual_nodes)
    )


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """With no slack the capacities add up to ``rows`` and differ by one at most."""
    if slack:
        return [-int(-(1 + slack) * rows // shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def lay_out(
    counts: dict[int, int], shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES
) -> list[tuple[int, int, int, int, int]]:
    """(cell, low, high, shard, base): ranks low to high - 1 of the cell go to
    the shard, from slot base on.

    In rounds, every cell offers what it has not placed to the virtual node it
    has come to; the shard takes what it has room for, in ring order, and the
    rest moves on to the next node of a shard with room.
    """
    nodes = ring(shards, virtual_nodes)
    cells = [cell for cell, _ in nodes]
    room = capacities(sum(counts.values()), shards, slack)
    used, placed = [0] * shards, []
    waiting = [
        (cell, 0, bisect.bisect_left(cells, cell) % len(nodes)) for cell in sorted(counts)
    ]
    while waiting:
        over = []
        for cell, done, node in waiting:
            shard = nodes[node][1]
            take = min(counts[cell] - done, room[shard] - used[shard])
            if take:
                placed.append((cell, done, done + take, shard, used[shard]))
                used[shard] += take
            if done + take < counts[cell]:
                over.append((cell, done + take, node))
        waiting = []
        for cell, done, node in over:
            while used[nodes[node][1]] == room[nodes[node][1]]:
                node = (node + 1) % len(nodes)
            waiting.append((cell, done, node))
    return placed


def shard_documents(
    docs: DataFrame,
    shards: int,
    *,
    slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES,
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), one row per row of ``docs``.

    ``docs`` has doc_id (long) and text (string); other columns are ignored.
    The key is doc_id, or the text where that is null. ``slack`` is the part by
    which a shard may exceed its even share; with 0 the shards' row counts are
    at most one apart. Slots count the rows of a shard from 0 without gaps.

    size is the UTF-8 length plus 16; a null text has no bytes, so 16 and a CRC
    of 0. Equal rows lie next to each other. No rows give no rows.
    """
    spark: SparkSession = docs.sparkSession
    place = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(
        F.xxhash64(F.lit("text"), "text")
    )
    rows = stage(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
            place.alias("place"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("cell", F.pmod("place", F.lit(CELLS)).cast("int")),
        "shard-rows",
    )
    counts = {row.cell: row["count"] for row in rows.groupBy("cell").count().collect()}
    starts, start = {}, 0
    for cell in sorted(counts):
        starts[cell], start = start, start + counts[cell]
    placed = lay_out(counts, shards, slack, virtual_nodes)
    layout = spark.createDataFrame([(*one, starts[one[0]]) for one in placed], _LAYOUT)
    # Ranks over all rows, by ranges that also cut a cell or a doc_id that holds a
    # large share of them; a cell's ranks follow those of the cells before it.
    ranked = dense_key(rows, ["cell", "place", "doc_id", "text_crc32", "size", "row"], "number")
    # The layout has a row per cell and one more for each time a shard fills up.
    return (
        ranked.join(F.broadcast(layout), "cell")
        .withColumn("rank", F.col("number") - 1 - F.col("start"))
        .where("rank >= low and rank < high")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("base") + F.col("rank") - F.col("low")).alias("slot"),
        )
    )
