"""Landing of dropped files in bronze.

``watch_files`` and ``land`` are a stream: each path is read once. ``land_changes``
also takes a path that is dropped again with other content: it keeps a manifest of
the versions it has landed and takes the files that differ from it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnlake.operators.keys import dense_key
from churnlake.operators.skew import hot_keys, spread_lookup
from churnlake.publish import PublishConflict, small_files
from churnlake.scratch import new_dir

SOURCE_FILE = "_source_file"
SOURCE_MODIFIED = "_source_modified"
SOURCE_PATH = "_source_path"


def watch_files(
    spark: SparkSession,
    folder: str,
    name_glob: str,
    file_format: str,
    schema: str,
    max_files: int = 10,
    **options: str | bool,
) -> DataFrame:
    """A stream of the rows of all files below ``folder`` with a matching name.

    The files stay where they are. Each row keeps the name, modification time and
    path of its file.
    """
    reader = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
    )
    return reader.load(folder).select(
        "*",
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(SOURCE_MODIFIED),
        F.col("_metadata.file_path").alias(SOURCE_PATH),
    )


def land(
    files: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append the stream to ``path``, each file exactly once.

    Without ``every`` the query takes what is there and ends; with it, it polls
    at that interval.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        files.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _row_id() -> Column:
    return F.struct("_metadata.file_path", "_metadata.row_index")


def landed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version of every file name.

    A name dropped again replaces the earlier file; of files of one name and time
    the last path counts. One file may hold a large share of the rows, so the lookup
    of the newest version spreads hot names.
    """
    landed = spark.read.parquet(path)
    columns = landed.columns
    version = F.struct(SOURCE_MODIFIED, SOURCE_PATH)
    newest = landed.groupBy(SOURCE_FILE).agg(F.max(version).alias("_newest"))
    rows = landed.select("*", _row_id().alias("_row_id"))
    found = spread_lookup(
        rows, newest, SOURCE_FILE, F.col("_row_id"), hot_keys(landed, SOURCE_FILE)
    )
    return found.where(version == F.col("_newest")).select(*columns)


# --- versions of files --------------------------------------------------

SOURCE_BATCH = "_batch"
SOURCE_KEY = "source_key"
_VERSION = "path string, modified timestamp, length long"


def _rows_of(target: str) -> str:
    return f"{target}/rows"


def _manifest_of(target: str) -> str:
    return f"{target}/_manifest"


def dropped_files(spark: SparkSession, folder: str, name_glob: str) -> DataFrame:
    """(path, modified, length) of the files below ``folder``; no content is read.

    A file without a single byte is one that is still being written, and not listed.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("modificationTime").alias("modified"), "length")
    )


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """(path, modified, length, batch): every version of every file that has landed."""
    try:
        records = spark.read.schema(f"batch long, files array<struct<{_fields(_VERSION)}>>").json(
            _manifest_of(target)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{_VERSION}, batch long")
    return records.select(F.explode("files").alias("file"), "batch").select("file.*", "batch")


def _fields(columns: str) -> str:
    return ", ".join(":".join(column.split()) for column in columns.split(", "))


def changed_files(spark: SparkSession, folder: str, name_glob: str, target: str) -> DataFrame:
    """The dropped files whose present version has not landed."""
    last = (
        manifest(spark, target)
        .groupBy("path")
        .agg(F.max_by(F.struct("modified", "length"), "batch").alias("landed"))
        .select("path", "landed.*")
    )
    return dropped_files(spark, folder, name_glob).join(
        last, ["path", "modified", "length"], "left_anti"
    )


def _land_batch(
    spark: SparkSession,
    files: Sequence[Row],
    batch: int,
    file_format: str,
    schema: str,
    target: str,
    options: dict[str, str | bool],
) -> None:
    """Put the rows of a few files in place of what their paths had before.

    Every path has a folder of its own, and only the folders of these files are
    overwritten. Doing it again gives the same rows.
    """
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", file.path) for file in files]
    rows = spark.read.format(file_format).schema(schema).options(**options).load(literal)
    rows.select(
        "*",
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(SOURCE_MODIFIED),
        F.lit(batch).cast("long").alias(SOURCE_BATCH),
        F.sha2("_metadata.file_path", 256).alias(SOURCE_KEY),
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        SOURCE_KEY
    ).parquet(_rows_of(target))
    # A file that holds no rows now has none to replace the earlier ones.
    present = spark.read.format("binaryFile").load(literal).select(
        F.sha2("_metadata.file_path", 256).alias(SOURCE_KEY)
    )
    keys = [row[0] for row in present.collect()]
    store = small_files(spark, target)
    there = [f"{_rows_of(target)}/{SOURCE_KEY}={key}" for key in keys]
    there = [path for path in there if any(name[0] not in "._" for name in store.names(path))]
    for path in there:
        newest = spark.read.schema(f"{SOURCE_BATCH} long").parquet(path).agg(F.max(SOURCE_BATCH))
        if newest.first()[0] != batch:
            store.delete(path)


def land_changes(
    spark: SparkSession,
    folder: str,
    name_glob: str,
    file_format: str,
    schema: str,
    target: str,
    max_files: int = 10,
    before_record: Callable[[int], None] | None = None,
    **options: str | bool,
) -> int:
    """Land all files that are new or differ from the version landed last, in
    batches of ``max_files``, oldest first; the number of batches.

    A batch first replaces the rows of its files, then enters them in the manifest,
    one small file put in place by a rename (``before_record`` is called in
    between). A batch that fails is not in the manifest, so the next run takes its
    files again. Dropped files stay where they are, and rows of files that are gone
    stay too. Reading what has landed is a plain scan: ``landed_versions``.
    """
    store = small_files(spark, target)
    records = [name for name in store.names(_manifest_of(target)) if name[0] not in "._"]
    number = max((int(name.removesuffix(".json")) for name in records), default=0)
    changed = changed_files(spark, folder, name_glob, target)
    numbered = dense_key(changed, ["modified", "path"], "_file")
    take = F.expr(f"(_file - 1) div {max_files}").alias("take")
    # The list may be long: it is stored by batch, and a batch is read at a time.
    waiting = new_dir(spark, "changed-files")
    numbered.select("path", "modified", "length", take).write.partitionBy("take").parquet(waiting)
    listed = spark.read.schema(f"{_VERSION}, take long").parquet(waiting)
    batches = listed.agg(F.max("take")).first()[0]
    for take in range(0 if batches is None else batches + 1):
        files = listed.where(F.col("take") == take).orderBy("modified", "path").collect()
        number += 1
        _land_batch(spark, files, number, file_format, schema, target, options)
        if before_record is not None:
            before_record(number)
        record = {
            "batch": number,
            "files": [
                {"path": file.path, "modified": file.modified.isoformat(), "length": file.length}
                for file in files
            ],
        }
        if not store.put(f"{_manifest_of(target)}/{number:010d}.json", json.dumps(record)):
            raise PublishConflict(f"{target}: batch {number} was landed by another job")
    return 0 if batches is None else batches + 1


def landed_versions(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """The rows of the newest version of every path, with file name, modification
    time and batch; none before anything has landed."""
    whole = f"{schema}, {SOURCE_FILE} string, {SOURCE_MODIFIED} timestamp, {SOURCE_BATCH} long"
    if not any(name[0] not in "._" for name in small_files(spark, target).names(_rows_of(target))):
        return spark.createDataFrame([], whole)
    rows = spark.read.schema(f"{whole}, {SOURCE_KEY} string").parquet(_rows_of(target))
    return rows.drop(SOURCE_KEY)
