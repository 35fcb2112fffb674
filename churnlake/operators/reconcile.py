"""Accounting for every source row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.operators.rules import REASON


class ReconciliationError(RuntimeError):
    """Source rows are neither clean nor rejected."""


RECONCILED = (
    "dataset string, source_rows long, clean_rows long, rejected_rows long,"
    " unaccounted_rows long, rejection_rate double"
)


def rejection_report(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason, most frequent first."""
    return (
        rejected.groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
        .orderBy(F.desc("rejected_rows"), REASON)
    )


def reconcile(
    name: str, source: DataFrame, clean: DataFrame, rejected: DataFrame
) -> DataFrame:
    """One row: source, clean, rejected and unaccounted rows, and the rejected
    share in percent."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(part).alias("part"), "rows")
        for part, df in (("source", source), ("clean", clean), ("rejected", rejected))
    ]
    rows = {
        part: F.sum(F.when(F.col("part") == part, F.col("rows")))
        for part in ("source", "clean", "rejected")
    }
    totals = counted[0].unionByName(counted[1]).unionByName(counted[2])
    source_rows = F.col("source_rows")
    rejected_share = F.when(source_rows > 0, F.col("rejected_rows") / source_rows * 100)
    return totals.agg(
        *[total.alias(f"{part}_rows") for part, total in rows.items()]
    ).select(
        F.lit(name).alias("dataset"),
        "source_rows",
        "clean_rows",
        "rejected_rows",
        (source_rows - F.col("clean_rows") - F.col("rejected_rows")).alias("unaccounted_rows"),
        F.round(F.coalesce(rejected_share, F.lit(0.0)), 2).alias("rejection_rate"),
    )


def require_reconciled(report: DataFrame) -> None:
    for row in report.collect():
        if row.unaccounted_rows != 0:
            raise ReconciliationError(
                f"{row.dataset}: {row.unaccounted_rows} of {row.source_rows} rows unaccounted"
            )
