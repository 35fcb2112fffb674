"""Bronze to silver: standardize, drop copies, validate, keep one row per key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.layout import Layout
from churnlake.operators.dedupe import (
    COPIES,
    DEAL,
    collapse_copies,
    deal_by_key,
    mark_dealt_duplicates,
    mark_key_duplicates,
    surplus_copies,
    tasks_by_key,
)
from churnlake.operators.keys import flag_known_keys, key_reference
from churnlake.operators.reconcile import (
    RECONCILED,
    reconcile,
    rejection_report,
    require_reconciled,
)
from churnlake.operators.rules import REASON, judge
from churnlake.publish import current, files_fingerprint, step
from churnlake.scratch import stage
from churnlake.sources.arrival import SOURCE_ID, number_arrivals
from churnlake.sources.readers import read_bronze
from churnlake.sources.specs import CUSTOMERS, KNOWN_CUSTOMER, SOURCES, SourceSpec


@dataclass(frozen=True)
class Silver:
    """The outcome of one source: ``columns`` of every source row, split."""

    clean: DataFrame
    rejected: DataFrame

    @property
    def all_rows(self) -> DataFrame:
        """Every source row with its reason, NULL for a clean row."""
        return self.clean.withColumn(REASON, F.lit(None).cast("string")).unionByName(
            self.rejected
        )


def standardize(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    return raw.select(
        *[parse(F.col(name)).alias(name) for name, parse in spec.fields.items()], SOURCE_ID
    )


def judged_rows(
    standardized: DataFrame,
    spec: SourceSpec,
    as_of: Column,
    customer_ids: DataFrame | None = None,
) -> DataFrame:
    """One row per distinct content, with its copy count and the first rule it
    fails. A copy is a copy before it is anything else, so rules only see the
    first one."""
    rows = collapse_copies(standardized, spec.columns, SOURCE_ID)
    if spec.foreign_key is not None:
        rows = flag_known_keys(
            rows,
            spec.foreign_key,
            customer_ids,
            F.col(SOURCE_ID),
            KNOWN_CUSTOMER,
            counted_on=standardized,
        )
    return judge(rows, spec.rules(as_of)).select(*spec.columns, SOURCE_ID, COPIES, REASON)


def _marked_by_joins(
    standardized: DataFrame, spec: SourceSpec, as_of: Column, customer_ids: DataFrame | None
) -> DataFrame:
    """The judged rows with their key duplicates, however heavy a key or a copy is. The
    judged rows are stored, since the first rows of the keys are joined back to them."""
    judged = stage(
        judged_rows(standardized, spec, as_of, customer_ids), f"{spec.name}-judged"
    )
    return mark_key_duplicates(
        judged, spec.key, SOURCE_ID, spec.duplicate_reason, F.col(REASON).isNull()
    )


def _other(spec: SourceSpec) -> str:
    """The column that rows without key are dealt out by."""
    return next(name for name in spec.columns if name != spec.key)


def _marked_by_key(
    standardized: DataFrame,
    spec: SourceSpec,
    as_of: Column,
    customer_ids: DataFrame | None,
    tasks: int,
    counted_on: DataFrame,
) -> DataFrame:
    """The same in one shuffle of the rows by their key. Customers are looked up before
    it, where copies find the same."""
    rows, known = standardized, []
    if spec.foreign_key is not None:
        known = [KNOWN_CUSTOMER]
        rows = flag_known_keys(
            rows, spec.foreign_key, customer_ids, F.col(SOURCE_ID), KNOWN_CUSTOMER, counted_on
        )
    dealt = deal_by_key(rows, spec.key, _other(spec), tasks)
    distinct = collapse_copies(dealt, [DEAL, *spec.columns, *known], SOURCE_ID)
    return mark_dealt_duplicates(
        judge(distinct, spec.rules(as_of)),
        spec.key,
        SOURCE_ID,
        spec.duplicate_reason,
        F.col(REASON).isNull(),
    )


def clean_source(
    standardized: DataFrame,
    spec: SourceSpec,
    as_of: Column,
    customer_ids: DataFrame | None = None,
    counted_on: DataFrame | None = None,
) -> Silver:
    """Split a standardized source into clean and rejected rows.

    Arrival ids must be stored or computed from the data: they are read more
    than once. The marked rows are stored, since the clean and the rejected rows
    both start from them. Keys are counted on ``counted_on`` where a stored table
    with the same rows is cheaper to read than ``standardized``.
    """
    counted_on = standardized if counted_on is None else counted_on
    tasks = tasks_by_key(counted_on, spec.key, _other(spec))
    if tasks is None:
        marked = _marked_by_joins(standardized, spec, as_of, customer_ids)
    else:
        marked = _marked_by_key(standardized, spec, as_of, customer_ids, tasks, counted_on)
    marked = stage(marked.select(*spec.columns, COPIES, REASON), f"{spec.name}-marked")
    clean = marked.where(F.col(REASON).isNull()).select(*spec.columns)
    # Copies come from as many partitions as the shuffle has tasks; AQE merges them. The
    # other rows lie as they are stored.
    rejected = marked.where(F.col(REASON).isNotNull()).drop(COPIES).unionByName(
        surplus_copies(marked, spec.columns).hint("rebalance")
    )
    return Silver(clean, rejected)


def run_source(
    spark: SparkSession,
    spec: SourceSpec,
    layout: Layout,
    as_of: Column,
    multi_line: bool = True,
) -> tuple[DataFrame, bool]:
    """Clean one bronze source into the lake; its reconciliation, and whether it
    was done now.

    Clean and rejected rows are published together, after they reconcile. If the
    source's files, the date and the customers it is checked against are those of
    the set that is there, nothing is done.
    """
    customers = None
    if spec.foreign_key is not None:
        customers = current(spark, layout.silver_set(CUSTOMERS.name))
        if customers is None:
            raise FileNotFoundError("no clean customers to check against")
    day = spark.range(1).select(as_of.cast("string")).first()[0]
    known = customers.tables["customer_ids"] if customers else ""
    files = files_fingerprint(spark, layout.bronze(spec.name))
    inputs = f"{files}; as of {day}; json arrays {multi_line}; {known}"

    def build() -> dict[str, DataFrame]:
        raw = read_bronze(spark, spec, layout.bronze(spec.name), multi_line)
        stored = stage(standardize(raw, spec), f"{spec.name}-standardized")
        ids = customers.read(spark, "customer_ids") if customers else None
        silver = clean_source(number_arrivals(stored), spec, as_of, ids, stored)
        tables = {"clean": silver.clean, "rejected": silver.rejected}
        if spec is CUSTOMERS:
            tables["customer_ids"] = key_reference(silver.clean, spec.key)
        build.source = stored
        return tables

    def check(stored: dict[str, DataFrame]) -> list[dict]:
        # Counted once: the report is looked at twice.
        rows = reconcile(spec.name, build.source, stored["clean"], stored["rejected"]).collect()
        report = spark.createDataFrame(rows, RECONCILED)
        require_reconciled(report)
        return [row.asDict() for row in rows]

    commit, done = step(spark, layout.silver_set(spec.name), inputs, build, check=check)
    return spark.createDataFrame(commit.report, RECONCILED), done


def run_silver(
    spark: SparkSession,
    layout: Layout,
    as_of: Column | None = None,
    multi_line: bool = True,
) -> dict[str, str]:
    """Clean all sources and return a status per source; those that are up to date
    are left as they are.

    Without clean customers nothing else can be checked, so a failure there
    ends the run; any other failure leaves the remaining sources to go on.
    ``as_of`` is fixed once, so a run over midnight judges all rows alike.
    """
    if as_of is None:
        today = spark.range(1).select(F.current_date()).first()[0]
        as_of = F.lit(today)
    status: dict[str, str] = {}
    for spec in SOURCES:
        try:
            report, done = run_source(spark, spec, layout, as_of, multi_line)
            report.show(truncate=False)
            if done:
                rejected = spark.read.parquet(layout.rejected(spec.name))
                rejection_report(rejected).show(truncate=False)
            status[spec.name] = "SUCCESS"
        except Exception as error:
            status[spec.name] = f"FAILED: {error}"
            if spec is CUSTOMERS:
                break
    return status
