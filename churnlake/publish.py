"""Tables that change together, and steps that are not done twice.

A set of tables is written to a folder of its own, with a number higher than that
of the set before. Only a commit record, one small file put in place by a rename,
makes it the current one: readers look the record up and see all tables of the
old set or all of the new one, whatever fails in between. A record also keeps the
fingerprint of the step's inputs, so a job that runs again can tell what it has
already done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlake.sources.writers import write_dataset, write_report

RECORDS, VERSIONS = "_commits", "_versions"


class PublishConflict(RuntimeError):
    """Another job has published the set in the meantime."""


@dataclass(frozen=True)
class Commit:
    """``tables`` maps names to the folders of their files."""

    number: int
    tables: dict[str, str]
    inputs: str = ""
    report: list[dict] = field(default_factory=list)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.tables[table])


class _Files:
    """The file system of one folder, for a handful of small files."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self.system.exists(path):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(path)]

    def text(self, path: str) -> str:
        stream = self.system.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, path: str, text: str) -> bool:
        """Write a file under a name that is not taken; False if it is."""
        folder, name = path.rsplit("/", 1)
        draft = self._path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = self.system.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._path(path)
        if not self.system.exists(target) and self.system.rename(draft, target):
            return True
        self.system.delete(draft, False)
        return False

    def delete(self, path: str) -> None:
        self.system.delete(self._path(path), True)


def small_files(spark: SparkSession, folder: str) -> _Files:
    """Access to the few small files of a folder that Spark's readers are not for."""
    return _Files(spark, folder)


def _numbers(files: _Files, folder: str) -> list[int]:
    names = files.names(f"{folder}/{RECORDS}")
    return sorted(int(name.removesuffix(".json")) for name in names if name[0] not in "._")


def _record(folder: str, number: int) -> str:
    return f"{folder}/{RECORDS}/{number:010d}.json"


def current(spark: SparkSession, folder: str) -> Commit | None:
    """The set of tables that counts, if one was ever published."""
    files = _Files(spark, folder)
    numbers = _numbers(files, folder)
    return Commit(**json.loads(files.text(_record(folder, numbers[-1])))) if numbers else None


def publish(
    spark: SparkSession,
    folder: str,
    tables: dict[str, DataFrame],
    *,
    check: Callable[[dict[str, DataFrame]], list[dict] | None] | None = None,
    inputs: str = "",
    one_file: Collection[str] = (),
    rebalance: Collection[str] = (),
    keep: int = 2,
) -> Commit:
    """Write all ``tables`` and make them the current set of ``folder``.

    ``check`` gets the written tables and raises if they must not be published; what
    it returns is kept in the record. Until the record is there, readers see the set
    before. The last ``keep`` sets stay, so that those who read the one before can
    finish; older ones and what failed runs left are deleted.
    """
    files = _Files(spark, folder)
    known = _numbers(files, folder)
    number = known[-1] + 1 if known else 1
    version = f"{number:010d}-{uuid.uuid4().hex}"
    stored = {}
    for name, df in tables.items():
        path = f"{folder}/{VERSIONS}/{version}/{name}"
        if name in one_file:
            stored[name] = write_report(df, path, replace=False)
        else:
            stored[name] = write_dataset(df, path, replace=False, rebalance=name in rebalance)
    report = (check(stored) if check else None) or []
    paths = {name: f"{folder}/{VERSIONS}/{version}/{name}" for name in tables}
    commit = Commit(number, paths, inputs, report)
    if not files.put(_record(folder, number), json.dumps(asdict(commit), default=str)):
        raise PublishConflict(f"{folder}: set {number} was published by another job")
    _forget(spark, files, folder, keep)
    return commit


def _forget(spark: SparkSession, files: _Files, folder: str, keep: int) -> None:
    numbers = _numbers(files, folder)
    kept = [json.loads(files.text(_record(folder, number))) for number in numbers[-keep:]]
    in_use = {path.rsplit("/", 2)[1] for commit in kept for path in commit["tables"].values()}
    for number in numbers[:-keep]:
        files.delete(_record(folder, number))
    for version in files.names(f"{folder}/{VERSIONS}"):
        # A set of a higher number is one that another job is writing.
        if version not in in_use and int(version.split("-")[0]) <= numbers[-1]:
            files.delete(f"{folder}/{VERSIONS}/{version}")


PART = "_part"


def publish_parts(
    spark: SparkSession,
    folder: str,
    df: DataFrame,
    column: str,
    *,
    values: Collection[str] | None = None,
    inputs: str = "",
    keep: int = 2,
) -> Commit:
    """Publish a table cut by the values of a text column, which are few.

    With ``values``, ``df`` holds the rows of those values only: their parts are
    replaced, or go if there are no rows, and all others stay the files they are.
    """
    files = _Files(spark, folder)
    before = current(spark, folder)
    number = before.number + 1 if before else 1
    version = f"{number:010d}-{uuid.uuid4().hex}"
    path = f"{folder}/{VERSIONS}/{version}"
    # One task writes a value's rows unless AQE splits it by size.
    df.withColumn(PART, F.col(column)).hint("rebalance", PART).write.partitionBy(PART).parquet(path)
    written = [name for name in files.names(path) if name.startswith(f"{PART}=")]
    parts = {name.split("=", 1)[1]: f"{path}/{name}" for name in written}
    if values is not None:
        unexpected = sorted(set(parts) - set(values))
        if unexpected:
            raise ValueError(f"rows of values that are not replaced: {unexpected}")
        old = before.tables if before else {}
        parts = {name: place for name, place in old.items() if name not in values} | parts
    # Kept with the record, for a table without parts has no files to tell it.
    schema = {"schema": df.schema.json()}
    commit = Commit(number, parts, inputs, [schema])
    if not files.put(_record(folder, number), json.dumps(asdict(commit))):
        raise PublishConflict(f"{folder}: set {number} was published by another job")
    _forget(spark, files, folder, keep)
    return commit


def read_parts(spark: SparkSession, commit: Commit) -> DataFrame:
    """The table of all parts."""
    schema = StructType.fromJson(json.loads(commit.report[0]["schema"]))
    if not commit.tables:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*sorted(commit.tables.values()))


def files_fingerprint(spark: SparkSession, path: str) -> str:
    """A digest of the paths, sizes and modification times of all files below a
    folder. They are listed by Spark; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = listed.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(file), F.lit(0)).alias("digest"),
    ).first()
    return f"{row.files} files, {row.bytes} bytes, {row.digest}"


def step(
    spark: SparkSession,
    folder: str,
    inputs: str,
    build: Callable[[], dict[str, DataFrame]],
    **options,
) -> tuple[Commit, bool]:
    """The set that ``build`` makes of ``inputs``, and whether it was made now.

    If the current set of ``folder`` was made of the same inputs, it stays.
    """
    known = current(spark, folder)
    if known is not None and known.inputs == inputs:
        return known, False
    return publish(spark, folder, build(), inputs=inputs, **options), True
