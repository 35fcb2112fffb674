"""Files written from the given tables, as a source would drop them."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake.layout import Layout
from churnlake.scratch import new_dir
from churnlake.sources.readers import SOURCE_ID
from churnlake.sources.specs import CUSTOMERS, SOURCES, USAGE, SourceSpec
from churnlake.workload.raw import RAW

# Milliseconds; a modification time given to files whose age must not decide.
LONG_AGO = 1_000_000_000_000

# Rows that one task sorts and writes into one file.
FILE_ROWS = 500_000

# Blocks that ``small_splits`` aims at for a large folder, and the largest it cuts.
BLOCKS, LARGEST_BLOCK = 256, 16 << 20

KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def block_size(spark: SparkSession, folder: str, smallest: int) -> int:
    """Bytes of the blocks that cut a folder's files into many: ``smallest``, and more
    where that would make far more than ``BLOCKS`` tasks of next to no work."""
    total = sum(system.getFileStatus(file).getLen() for system, file in _files(spark, folder))
    return max(smallest, min(total // BLOCKS, LARGEST_BLOCK))


@contextmanager
def small_splits(spark: SparkSession, folder: str, smallest: int = 64 << 10) -> Iterator[None]:
    """Plans made inside cut files into small blocks, as a large file would be."""
    size = block_size(spark, folder, smallest)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = system.listFiles(path, True)
    while listed.hasNext():
        file = listed.next().getPath()
        if file.getName()[0] not in "._":
            yield system, file


def set_age(spark: SparkSession, folder: str, modified: int = LONG_AGO) -> None:
    """Give all files below a folder one modification time."""
    for system, file in _files(spark, folder):
        system.setTimes(file, modified, -1)


def drop_file(df: DataFrame, path: str) -> None:
    """Write ``df`` as the one Parquet file ``path``, in place of what is there."""
    spark = df.sparkSession
    folder = new_dir(spark, "dropped")
    df.coalesce(1).write.parquet(folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system, file = next(iter(_files(spark, folder)))
    system.mkdirs(target.getParent())
    system.delete(target, False)
    system.rename(file, target)


def file_count(rows: DataFrame, rows_per_file: int = FILE_ROWS) -> int:
    """As many files as leave none with more rows than a task should write."""
    return max(1, math.ceil(rows.count() / rows_per_file))


def in_arrival_order(spark: SparkSession, sf_dir: str, spec: SourceSpec, parts: int = 5) -> DataFrame:
    """The raw rows in the order of their ids, over a few files in that order, or as
    many as the rows need. Narrow rows are brought in order; their cells are made after."""
    source = RAW[spec.name]
    rows, order = source.rows(spark, sf_dir), source.order()
    parts = max(parts, file_count(rows))
    return source.cells(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order))


def _file_number(value: Column, bounds: list[float]) -> Column:
    """How many of the sorted ``bounds`` lie below a value, found by halving them."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    below = _file_number(value, bounds[:middle])
    above = _file_number(value, bounds[middle + 1 :]) + (middle + 1)
    return F.when(value > bounds[middle], above).otherwise(below)


def write_array(
    rows: DataFrame,
    order: str,
    path: str,
    rows_per_file: int = FILE_ROWS,
    cells: Callable[..., DataFrame] | None = None,
) -> None:
    """All rows as one JSON array a file, in the order of a column; one file of one
    array as long as its rows fit a task. ``cells`` makes the fields of rows that are
    in order, by default all other columns.

    Files hold ranges of the column and their paths have its order. The bounds of the
    ranges are about its quantiles; they are part of the plan, so a row has the same
    file whenever it is read.
    """
    files = file_count(rows, rows_per_file)
    shares = [number / files for number in range(1, files)]
    bounds = rows.approxQuantile(order, shares, 0.1 / files) if shares else []
    number = _file_number(F.col(order), sorted(set(bounds)))
    digits = max(5, len(str(files)))
    file = F.lpad(F.when(F.col(order).isNotNull(), number).cast("string"), digits, "0")
    of_file = Window.partitionBy("file").orderBy(order)
    # More tasks than files, so that few of them get more than one.
    placed = (
        rows.withColumn("file", F.coalesce(file, F.lit("null")))
        .repartition(4 * files, "file")
        .withColumn("lead", F.when(F.row_number().over(of_file) == 1, "[").otherwise(","))
        .withColumn("end", F.when(F.lead(F.lit(1)).over(of_file).isNull(), "\n]").otherwise(""))
        .sortWithinPartitions("file", order)
    )
    if cells is not None:
        placed = cells(placed, order, "file", "lead", "end")
    names = [name for name in placed.columns if name not in (order, "file", "lead", "end")]
    line = F.concat("lead", F.to_json(F.struct(*names)), "end")
    placed.select(line.alias("line"), "file").write.partitionBy("file").text(path)


def write_bronze(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake whose bronze files hold all four sources; arrival is the order of the
    raw ids."""
    layout = Layout(new_dir(spark, "lake"))
    for spec in SOURCES:
        path = layout.bronze(spec.name)
        if spec is USAGE:
            usage = RAW[spec.name]
            write_array(usage.rows(spark, sf_dir), SOURCE_ID, path, cells=usage.cells)
        else:
            rows = in_arrival_order(spark, sf_dir, spec).select(*spec.columns)
            rows.write.options(header=spec.header, **KEEP_SPACES).csv(path)
        set_age(spark, path)
    return layout


def write_late_first(spark: SparkSession, sf_dir: str, buckets: int = 7) -> str:
    """Customers by key modulo ``buckets``, a file each; the last bucket came first."""
    folder = f"{new_dir(spark, 'arrivals')}-{uuid.uuid4().hex}"
    rows = RAW[CUSTOMERS.name](spark, sf_dir).withColumn(
        "bucket", F.expr(f"({SOURCE_ID} div 4) % {buckets}")
    )
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", SOURCE_ID)
    rows.select(*CUSTOMERS.columns, "bucket").write.partitionBy("bucket").options(**KEEP_SPACES).csv(folder)
    for bucket in range(buckets):
        place = f"{folder}/bucket={bucket}"
        set_age(spark, place, LONG_AGO + 1000 * (buckets - bucket))
    return folder
