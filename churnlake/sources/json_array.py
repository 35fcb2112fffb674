"""Files that hold one JSON array each, read by many tasks.

No line has to end where a record does, so a file is cut at every ``}``: each
record ends at one, wherever the array's line feeds are. Whether such a piece lies
inside a string, and how deep, depends on all bytes before it. That is an
automaton with two kinds of states, inside and outside a string, and a depth; what
a piece does to them is worked out for both ways to enter it, and so is what a
file block does, as the sum of its pieces. A prefix scan over the blocks of a file,
one row each, gives the state at the start of every block, and from there at the
start of every piece. A record ends with the piece that comes back to depth one.

Pieces that are a record by themselves, as all records of flat objects are, stay
where they were read; only those of records with inner objects, or with ``}`` in a
string, are brought together. Where all pieces of a block are records by themselves,
one row for the block says so, and no sum over its pieces is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake.scratch import stage
from churnlake.sources.arrival import SOURCE_ID, file_arrival

END = "}"

# Blocks of fewer bytes are too little for a file of their own.
TINY_BLOCK = 1 << 20

# The rest of a text, for ``substring``.
MOST = (1 << 31) - 1


def _depth_change(texts: str) -> str:
    """Openings less closings in an array of the texts between quotes."""
    joined = f"array_join({texts}, '')"
    opened = f"(length({joined}) - length(translate({joined}, '{{[', '')))"
    return f"({opened} - (length({joined}) - length(translate({joined}, ']', ''))))"


def _transitions(pieces: DataFrame) -> DataFrame:
    """``quotes`` of each piece and the change of depth if it starts outside
    (``change_0``) or inside (``change_1``) a string. The piece's own end counts
    where it lies outside.

    Most pieces are a flat object: a ``{`` before the first quote, no other bracket,
    no escape, and quotes in pairs. Its end undoes what the ``{`` did, so that is known
    without taking the piece apart.
    """
    quoted = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    opened = F.octet_length("value") - F.octet_length(F.replace("value", F.lit("{"), F.lit("")))
    first_quote = F.instr("value", '"')
    flat = (
        ~F.col("value").contains("\\")
        & ~F.col("value").contains("[")
        & ~F.col("value").contains("]")
        & (opened == 1)
        & (quoted % 2 == 0)
        & ((first_quote == 0) | (F.instr("value", "{") < first_quote))
    )
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    even, odd = (f"filter(_parts, (x, i) -> i % 2 = {side})" for side in (0, 1))

    def told(known: str, taken_apart: str) -> Column:
        return F.expr(f"bigint(if(_flat, {known}, {taken_apart}))")

    return (
        pieces.withColumn("_flat", F.coalesce(flat, F.lit(False)))
        .withColumn("_quoted", F.when(F.col("_flat"), quoted))
        .withColumn("_parts", F.when(~F.col("_flat"), parts))
        .withColumn("quotes", told("_quoted", "size(_parts) - 1"))
        .withColumn("change_0", told("0", f"{_depth_change(even)} - if(quotes % 2 = 0, 1, 0)"))
        .withColumn("change_1", told("0", f"{_depth_change(odd)} - if(quotes % 2 = 1, 1, 0)"))
        .drop("_parts", "_flat", "_quoted")
    )


def _sum_before(value: str | Column, window) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(value).over(window), F.lit(0).cast("long"))


def _in_block():
    """The pieces of a block before this one."""
    return (
        Window.partitionBy("path", "block")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def _earlier_blocks():
    return Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _entered(pieces: DataFrame) -> DataFrame:
    """What a piece does to the depth for both ways to enter its block."""
    return (
        pieces.withColumn("quotes_before", _sum_before("quotes", _in_block()))
        .withColumn("entered_0", F.expr("if(quotes_before % 2 = 0, change_0, change_1)"))
        .withColumn("entered_1", F.expr("if(quotes_before % 2 = 0, change_1, change_0)"))
    )


def _block_sums(pieces: DataFrame) -> DataFrame:
    """One row a block: its quotes and changes of depth, and whether it is ``level``, that
    is, all pieces have quotes in pairs and only its first and last change the depth. The
    totals are those of the block if no string ends in another piece than it starts in."""
    level = (
        "uneven = 0 and changes = if(first_change != 0, 1, 0)"
        " + if(pieces > 1 and last_change != 0, 1, 0)"
    )
    return (
        pieces.groupBy("path", "block")
        .agg(
            F.count(F.lit(1)).alias("pieces"),
            F.min("place").alias("first_place"),
            F.count_if(F.col("quotes") % 2 != 0).alias("uneven"),
            F.count_if(F.col("change_0") != 0).alias("changes"),
            F.min_by("change_0", "place").alias("first_change"),
            F.max_by("change_0", "place").alias("last_change"),
            F.sum("quotes").alias("quotes"),
            F.sum("change_0").alias("total_0"),
            F.sum("change_1").alias("total_1"),
        )
        .withColumn("level", F.expr(level))
    )


def _block_states(pieces: DataFrame, sums: DataFrame) -> DataFrame:
    """The blocks with the state at the start of each: ``inside`` a string or not, and
    ``depth``. A block is ``straight`` if it starts outside and all its pieces but the
    first start at depth one, so that nothing needs to be summed over them."""
    keys = ["path", "block"]
    numbers = pieces.select(*keys, "place", "quotes", "change_0", "change_1")
    scanned = (
        _entered(numbers.join(sums.where("uneven > 0").select(*keys), keys))
        .groupBy(*keys)
        .agg(F.sum("entered_0").alias("_scanned_0"), F.sum("entered_1").alias("_scanned_1"))
    )
    return (
        sums.join(scanned, keys, "left")
        .withColumn("total_0", F.coalesce("_scanned_0", "total_0"))
        .withColumn("total_1", F.coalesce("_scanned_1", "total_1"))
        .drop("_scanned_0", "_scanned_1")
        .withColumn("inside", _sum_before("quotes", _earlier_blocks()) % 2)
        .withColumn("total", F.expr("if(inside = 0, total_0, total_1)"))
        .withColumn("depth", _sum_before("total", _earlier_blocks()))
        .withColumn("straight", F.expr("level and inside = 0 and depth + first_change = 1"))
    )


def require_whole_arrays(states: DataFrame) -> None:
    """Stop if a file does not end outside all brackets and strings.

    The text after the last ``}`` holds the array's end and is counted as if a
    ``}`` followed, so a whole array ends at depth -1.
    """
    broken = (
        states.groupBy("path")
        .agg(F.sum("total").alias("depth"), (F.sum("quotes") % 2).alias("inside"))
        .where("depth != -1 or inside != 0")
        .select("path")
        .first()
    )
    if broken is not None:
        raise ValueError(f"not one whole JSON array: {broken.path}")


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, arrival): the text of every element of the arrays below ``path``,
    which must be objects.

    The places in ``arrival`` number the records of a file without gaps. An empty
    array has no records; a file that is no whole array is an error.
    """
    keys = ["path", "block"]
    read = spark.read.option("lineSep", END).text(path).select("value", file_arrival().alias("at"))
    told = _transitions(read.select("value", "at.*"))
    # Each block is stored as a file; those of tiny blocks are merged first.
    tiny = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() < TINY_BLOCK
    pieces = stage(told.hint("rebalance") if tiny else told, "json-pieces")
    sums = stage(_block_sums(pieces), "json-sums")
    states = stage(_block_states(pieces, sums), "json-blocks")
    require_whole_arrays(states)
    known = [*keys, "modified", "place", "value", "starts", "ends"]
    entered = _entered(
        pieces.join(
            states.where("not straight").select(*keys, "inside", F.col("depth").alias("_depth")), keys
        )
    )
    inside = (F.col("inside") + F.col("quotes_before")) % 2
    summed = (
        entered.withColumn("_change", F.expr("if(inside = 0, entered_0, entered_1)"))
        .withColumn("depth", F.col("_depth") + _sum_before("_change", _in_block()))
        .withColumn("starts", (inside == 0) & (F.col("depth") <= 1))
        .withColumn("depth_after", F.col("depth") + F.col("_change"))
        .withColumn("ends", ((inside + F.col("quotes")) % 2 == 0) & (F.col("depth_after") == 1))
        .withColumn("_own", _sum_before(F.col("ends").cast("long"), _in_block()))
        .select(*known, "_own")
    )
    summed = stage(summed, "json-summed")
    # How many records end before a piece: in the blocks before, and in its own.
    counted = summed.groupBy(*keys).agg(F.count_if("ends").alias("_counted"))
    all_but = F.expr("pieces - if(pieces > 1 and last_change != 0, 1, 0)")
    ended = stage(
        states.join(counted, keys, "left")
        .withColumn("_ends", F.when(F.col("straight"), all_but).otherwise(F.col("_counted")))
        .withColumn("_base", _sum_before("_ends", _earlier_blocks()))
        .select(*keys, "straight", "first_place", F.col("depth").alias("_depth"), "_base"),
        "json-ended",
    )
    # Every piece of a straight block ends a record, save its last, which may not.
    straight = (
        pieces.join(ended.where("straight"), keys)
        .withColumn("depth", F.expr("if(place = first_place, _depth, 1)"))
        .withColumn("starts", F.col("depth") <= 1)
        .withColumn("ends", F.col("depth") + F.col("change_0") == 1)
        .withColumn("record", F.expr("_base + place - first_place"))
        .select(*known, "record")
    )
    others = summed.join(ended.select(*keys, "_base"), keys)
    numbered = straight.unionByName(
        others.select(*known, (F.col("_base") + F.col("_own")).alias("record"))
    )
    # What is left after the last record is no record.
    left = F.col("starts") & ~F.col("ends") & F.col("value").rlike(r"^\s*(\[\s*)?\]\s*$")
    numbered = numbered.where(~left)
    alone = numbered.where("starts and ends").select(
        "path", "modified", "record", F.concat("value", F.lit(END)).alias("text")
    )
    together = (
        numbered.where("not (starts and ends)")
        .groupBy("path", "modified", "record")
        .agg(F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("_pieces"))
        .select(
            "path",
            "modified",
            "record",
            F.concat(F.array_join("_pieces.value", END), F.lit(END)).alias("text"),
        )
    )
    # Before a record: the bracket of the array, or a comma.
    opening = r"^\uFEFF?\s*(\[|,)?\s*"
    text = (
        F.when(F.col("text").startswith(",{"), F.substring("text", 2, MOST))
        .when(F.col("text").startswith("\n,{"), F.substring("text", 3, MOST))
        .otherwise(F.regexp_replace("text", opening, ""))
    )
    problem = F.concat(F.lit("an array element is no object: "), F.substring(text, 1, 80))
    checked = F.when(text.startswith("{"), text).otherwise(F.raise_error(problem))
    arrival = F.struct(
        "modified", "path", F.lit(0).cast("long").alias("block"), F.col("record").alias("place")
    )
    return alone.unionByName(together).select(checked.alias("record"), arrival.alias("arrival"))


def read_json_array(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named fields of all records, as text, and their arrival.

    A missing field is NULL, others are ignored. A record that cannot be parsed
    stops the job.
    """
    schema = ", ".join(f"`{name}` string" for name in columns)
    parsed = F.from_json("record", schema, {"mode": "FAILFAST"})
    return (
        array_records(spark, path)
        .select(parsed.alias("_fields"), F.col("arrival").alias(SOURCE_ID))
        .select(*[F.col("_fields").getField(name).alias(name) for name in columns], SOURCE_ID)
    )
