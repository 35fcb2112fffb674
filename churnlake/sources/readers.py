"""Bronze readers. Every column arrives as a string."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.sources.arrival import SOURCE_ID, file_arrival
from churnlake.sources.json_array import read_json_array
from churnlake.sources.specs import SourceSpec


def string_schema(columns: Sequence[str]) -> str:
    return ", ".join(f"`{name}` string" for name in columns)


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool
) -> DataFrame:
    """A CSV folder with its columns named by position; header names are ignored.

    A row of any file that is wider or narrower stops the job when it is read,
    so no cell is lost and no missing one is taken for NULL.
    """
    reader = spark.read.schema(string_schema(columns)).option("header", header)
    return reader.option("mode", "FAILFAST").csv(path)


def read_json(
    spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True
) -> DataFrame:
    """JSON objects with the named fields; a missing field is NULL, others are
    ignored.

    With ``multi_line`` a file is read by one task; ``read_json_array`` reads a
    file that holds one array with many.
    """
    reader = spark.read.schema(string_schema(columns)).option("multiLine", multi_line)
    return reader.json(path)


def read_bronze(
    spark: SparkSession, spec: SourceSpec, path: str, multi_line: bool = True
) -> DataFrame:
    """The raw rows of a source with their arrival, which ``number_arrivals`` makes
    a number once they are stored. JSON files hold one array each, or one object
    a line (``multi_line=False``)."""
    if spec.file_format == "json" and multi_line:
        return read_json_array(spark, path, spec.columns)
    if spec.file_format == "json":
        return with_source_id(read_json(spark, path, spec.columns, multi_line))
    return with_source_id(read_csv(spark, path, spec.columns, spec.header))


def fit_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, as strings: absent ones as NULL, others dropped."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast("string").alias(name)
            for name in columns
        ]
    )


def with_source_id(df: DataFrame) -> DataFrame:
    """Add the arrival of each row of a file scan."""
    return df.select("*", file_arrival().alias(SOURCE_ID))


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A relational table read in parallel ranges of ``split_column``.

    The bounds only place the ranges; rows outside them are read too.
    """
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )


def import_table(source: DataFrame, columns: Sequence[str], path: str) -> None:
    """Land a whole table as headerless CSV, replacing the previous import.

    Cells keep their surrounding spaces: bronze holds what the source holds.
    """
    fit_columns(source, columns).write.mode("overwrite").options(
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def dataset_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """Stop before any work when an input is missing."""
    missing = [path for path in paths if not dataset_exists(spark, path)]
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def require_absent(spark: SparkSession, paths: Sequence[str]) -> None:
    """Stop before any write when an output would be replaced."""
    existing = [path for path in paths if dataset_exists(spark, path)]
    if existing:
        raise FileExistsError("outputs exist: " + ", ".join(existing))
