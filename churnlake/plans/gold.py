"""Silver to gold: customer dimension, monthly activity fact, churn mart."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions import guarded_ratio, month, month_of, resolve_column
from churnlake.layout import Layout
from churnlake.operators.keys import dense_key
from churnlake.operators.quality import quality_report, require_passed
from churnlake.publish import Commit, step
from churnlake.scratch import stage
from churnlake.sources.readers import require_absent, require_inputs

# The validity period written to the dimension.
VALID_FROM = "2026-09-03"
VALID_TO = "9999-12-31"

ACTIVITY_KEY = ("customer_id", "activity_month")

# The columns and names of the tables.
DIM_COLUMNS = (
    "cust_key",
    "customer_id",
    "is_churned",
    "CLV_LTV",
    "avg_ticket_res_time_hrs",
    "num_products",
    "dw_start_date",
    "dw_end_date",
)

FACT_COLUMNS = (
    "customer_id",
    "activity_month",
    "usage_events",
    "total_balance",
    "avg_balance",
    "ticket_count",
    "avg_resolution_time",
    "offer_count",
    "accepted_offers",
    "acceptance_rate",
    "cust_key",
    "activity_key",
)

TABLES = ("dim_customer", "fact_customer_activity", "monthly_churn_rate")


@dataclass(frozen=True)
class Gold:
    dim: DataFrame
    fact: DataFrame
    mart: DataFrame


# --- activity by source -------------------------------------------------


@dataclass(frozen=True)
class Activity:
    """How the rows of one source count as a customer's activity in a month.

    The first column of ``dated`` that is there gives the month. ``sums`` are
    aggregates over the columns ``reads``; ``monthly`` and ``overall`` are the
    measures of a month and of all months, out of those sums.
    """

    dated: tuple[str, ...]
    reads: tuple[str, ...]
    sums: dict[str, str]
    monthly: dict[str, str]
    overall: dict[str, str] = field(default_factory=dict)


def _ratio(total: str, rows: str) -> str:
    return f"try_divide(double({total}), {rows})"


# The names of the measures are fixed values.
ACTIVITIES = {
    "usage": Activity(
        dated=("usage_month_date", "usage_month"),
        reads=("usage_log_id", "monthly_balance"),
        sums={
            "usage_events": "count(usage_log_id)",
            "balance_sum": "sum(monthly_balance)",
            "balance_rows": "count(monthly_balance)",
        },
        monthly={
            "usage_events": "usage_events",
            "total_balance": "balance_sum",
            "avg_balance": _ratio("balance_sum", "balance_rows"),
        },
        overall={"CLV_LTV": _ratio("balance_sum", "balance_rows") + " * usage_months"},
    ),
    "tickets": Activity(
        dated=("created_at",),
        reads=("ticket_id", "resolution_time_hrs"),
        sums={
            "ticket_count": "count(ticket_id)",
            "resolution_sum": "sum(resolution_time_hrs)",
            "resolution_rows": "count(resolution_time_hrs)",
        },
        monthly={
            "ticket_count": "ticket_count",
            "avg_resolution_time": _ratio("resolution_sum", "resolution_rows"),
        },
        overall={"avg_ticket_res_time_hrs": _ratio("resolution_sum", "resolution_rows")},
    ),
    "offers": Activity(
        dated=("date_offered",),
        reads=("offer_id", "accepted"),
        sums={
            "offer_count": "count(offer_id)",
            "accepted_offers": "count_if(int(accepted) = 1)",
            "answered_sum": "sum(bigint(accepted))",
            "answered_rows": "count(accepted)",
        },
        monthly={
            "offer_count": "offer_count",
            "accepted_offers": "accepted_offers",
            "acceptance_rate": _ratio("answered_sum", "answered_rows"),
        },
    ),
}


def dated_rows(rows: DataFrame, source: str) -> DataFrame:
    """The rows of a source by customer and month, with the columns it counts."""
    activity = ACTIVITIES[source]
    date = next(name for name in activity.dated if name in rows.columns)
    told_as_text = dict(rows.dtypes)[date] == "string"
    return rows.select(
        F.col("customer_id").cast("long").alias("customer_id"),
        (month if told_as_text else month_of)(F.col(date)).alias("activity_month"),
        F.lit(source).alias("source"),
        *activity.reads,
    )


# --- the gold tables ----------------------------------------------------


def activity_rollup(usage: DataFrame, tickets: DataFrame, offers: DataFrame) -> DataFrame:
    """All activity of a customer in a month, from one pass and one shuffle.

    The three sources are stacked and aggregated once. An aggregate skips the
    NULLs the other sources leave in its column, so the measures equal those of
    separate rollups joined on a common spine. Sums and counts are kept instead
    of means, so that every measure follows from the same rows. Rows without a
    month count for the customer only.
    """
    sources = zip(ACTIVITIES, (usage, tickets, offers), strict=True)
    stacked = reduce(
        partial(DataFrame.unionByName, allowMissingColumns=True),
        [dated_rows(rows, source) for source, rows in sources],
    )
    return (
        stacked.where(F.col("customer_id").isNotNull())
        .groupBy(*ACTIVITY_KEY)
        .agg(
            *[F.count_if(F.col("source") == source).alias(f"{source}_rows") for source in ACTIVITIES],
            *[
                F.expr(total).alias(name)
                for activity in ACTIVITIES.values()
                for name, total in activity.sums.items()
            ],
        )
    )


def _active(sources: tuple[str, ...]) -> Column:
    return F.greatest(F.lit(0), *[F.col(f"{source}_rows") for source in sources]) > 0


def monthly_measures(rollup: DataFrame, *sources: str) -> DataFrame:
    """The measures of the named sources, by default all, in each month with a row
    of one of them; a source without a value has NULL."""
    sources = sources or tuple(ACTIVITIES)
    return rollup.where(F.col("activity_month").isNotNull() & _active(sources)).select(
        *ACTIVITY_KEY,
        *[
            F.expr(measure).alias(name)
            for source in sources
            for name, measure in ACTIVITIES[source].monthly.items()
        ],
    )


def customer_measures(rollup: DataFrame, *sources: str) -> DataFrame:
    """The measures over all months of the customers with a row of one of the
    named sources, by default all."""
    sources = sources or tuple(ACTIVITIES)
    summed = [f"{source}_rows" for source in ACTIVITIES]
    summed += [name for activity in ACTIVITIES.values() for name in activity.sums]
    months = [
        F.count_if((F.col(f"{source}_rows") > 0) & F.col("activity_month").isNotNull()).alias(
            f"{source}_months"
        )
        for source in ACTIVITIES
    ]
    totals = rollup.groupBy("customer_id").agg(
        *months, *[F.sum(name).alias(name) for name in summed]
    )
    return totals.where(_active(sources)).select(
        "customer_id",
        *[
            F.expr(measure).alias(name)
            for source in sources
            for name, measure in ACTIVITIES[source].overall.items()
        ],
    )


def customer_base(customers: DataFrame) -> DataFrame:
    """One row per customer; of several, the one with the smallest values."""
    return (
        customers.select(
            resolve_column(customers, "CustomerId", "customerid", "customer_id")
            .cast("long")
            .alias("customer_id"),
            resolve_column(customers, "Exited", "exited").cast("int").alias("is_churned"),
            resolve_column(customers, "NumOfProducts", "numofproducts")
            .cast("int")
            .alias("num_products"),
        )
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min(F.struct("is_churned", "num_products")).alias("kept"))
        .select("customer_id", "kept.*")
    )


def build_dim(
    customers: DataFrame,
    rollup: DataFrame,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    dim = (
        customer_base(customers)
        .join(customer_measures(rollup), "customer_id", "left")
        .fillna(0.0, ["CLV_LTV", "avg_ticket_res_time_hrs"])
        .withColumn("dw_start_date", F.to_date(F.lit(valid_from)))
        .withColumn("dw_end_date", F.to_date(F.lit(valid_to)))
    )
    return dense_key(dim, ["customer_id"], "cust_key").select(*DIM_COLUMNS)


def filled_measures(rollup: DataFrame) -> DataFrame:
    """The measures of every active month, with 0 for what a source has no value of."""
    measures = monthly_measures(rollup)
    return measures.select(
        *ACTIVITY_KEY,
        *[
            F.coalesce(name, F.lit(0)).alias(name)
            for name in measures.columns
            if name not in ACTIVITY_KEY
        ],
    )


def build_keyed_fact(rollup: DataFrame, dim: DataFrame) -> DataFrame:
    """The activity fact with the churn flag of its customer.

    One join serves three ends: it drops unknown customers, and brings both
    the surrogate key and the flag the churn mart counts.
    """
    known = filled_measures(rollup).join(dim.select("customer_id", "cust_key", "is_churned"), "customer_id")
    return dense_key(known, list(ACTIVITY_KEY), "activity_key").select(
        *FACT_COLUMNS, "is_churned"
    )


def with_churn_flag(fact: DataFrame, dim: DataFrame) -> DataFrame:
    return fact.join(dim.select("customer_id", "is_churned"), "customer_id")


def build_mart(flagged_fact: DataFrame) -> DataFrame:
    """Per month, the share of active customers whose flag says churned.

    The fact has one row per customer and month, so counting rows counts
    customers and no distinct count is needed.
    """
    return (
        flagged_fact.groupBy("activity_month")
        .agg(
            F.count("customer_id").alias("active_customers"),
            F.count_if(F.col("is_churned") == 1).alias("churned_customers"),
        )
        .withColumn(
            "churn_rate",
            guarded_ratio(F.col("churned_customers"), F.col("active_customers")),
        )
        .orderBy("activity_month")
    )


def build_gold(
    customers: DataFrame,
    tickets: DataFrame,
    offers: DataFrame,
    usage: DataFrame,
    valid_from: str = VALID_FROM,
) -> Gold:
    rollup = stage(activity_rollup(usage, tickets, offers), "activity-rollup")
    dim = build_dim(customers, rollup, valid_from)
    return Gold(dim, *build_facts(rollup, dim))


def build_facts(rollup: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The activity fact and the churn mart."""
    keyed = build_keyed_fact(rollup, dim)
    return keyed.drop("is_churned"), build_mart(keyed)


def register_gold(spark: SparkSession, layout: Layout, database: str = "default") -> None:
    """External tables over the stored gold files; a table of the same name that
    points elsewhere is replaced, its files stay."""
    for table in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}_gold")
        spark.sql(
            f"CREATE TABLE {database}.{table}_gold "
            f"USING PARQUET LOCATION '{layout.gold(table)}'"
        )


JOIN_KEY = "cust_key"


def store_bucketed(
    spark: SparkSession, gold: Gold, folder: str, database: str, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """External tables of dimension and fact laid out for their joins.

    Both are cut by the customer's key into the same number of buckets, each one
    sorted file, so aggregations and joins on the key need no shuffle, however
    large the tables. Table and column statistics let the optimizer order joins and
    choose broadcasts by rows, not by file sizes. Take as many buckets as keep one
    within a task's memory.
    """
    stored = []
    for name, df in zip(TABLES[:2], (gold.dim, gold.fact), strict=True):
        table = f"{database}.{name}_by_customer"
        # Dealt out by the same hash as the buckets: one file each.
        (
            df.repartition(buckets, JOIN_KEY)
            .sortWithinPartitions(JOIN_KEY)
            .write.mode("overwrite")
            .bucketBy(buckets, JOIN_KEY)
            .sortBy(JOIN_KEY)
            .option("path", f"{folder}/{name}")
            .saveAsTable(table)
        )
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        stored.append(spark.table(table))
    return tuple(stored)


def row_counts(gold: Gold) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count"
        )
        for table, df in zip(TABLES, (gold.dim, gold.fact, gold.mart), strict=True)
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def read_gold(spark: SparkSession, layout: Layout) -> Gold:
    return Gold(*[spark.read.parquet(layout.gold(table)) for table in TABLES])


def stored_rollup(spark: SparkSession, layout: Layout) -> Commit:
    """The activity rollup of the current silver tables; a step of its own."""
    paths = [layout.silver(source) for source in ("usage", "customer_support_tickets", "offers")]

    def build() -> dict[str, DataFrame]:
        return {"rollup": activity_rollup(*[spark.read.parquet(path) for path in paths])}

    return step(spark, layout.rollup_set, "; ".join(paths), build)[0]


def run_gold(
    spark: SparkSession,
    layout: Layout,
    valid_from: str = VALID_FROM,
    replace: bool = False,
) -> DataFrame:
    """Build, check and publish the gold tables; returns the quality report.

    The three tables are checked as they are written and published as one set, so
    a failed check or run leaves the set before. It is only replaced when
    ``replace`` is set, and left alone if it was made of the same silver tables.
    """
    sources = ("customers", "customer_support_tickets", "offers", "usage")
    require_inputs(spark, [layout.silver(source) for source in sources])
    if not replace:
        require_absent(spark, [layout.gold(table) for table in TABLES])
    rollup = stored_rollup(spark, layout)
    customers = layout.silver("customers")

    def build() -> dict[str, DataFrame]:
        activity = rollup.read(spark, "rollup")
        dim = stage(build_dim(spark.read.parquet(customers), activity, valid_from), "dim")
        # Read twice, from the rows that its key was stored with.
        keyed = build_keyed_fact(activity, dim)
        return dict(zip(TABLES, (dim, keyed.drop("is_churned"), build_mart(keyed)), strict=True))

    def check(stored: dict[str, DataFrame]) -> list[dict]:
        # Checked once: the report is looked at three times.
        found = quality_report(*[stored[table] for table in TABLES])
        rows = found.collect()
        report = spark.createDataFrame(rows, found.schema)
        report.show(100, truncate=False)
        require_passed(report)
        return [row.asDict() for row in rows]

    inputs = f"{customers}; {rollup.tables['rollup']}; {valid_from}"
    commit, _ = step(
        spark, layout.gold_set, inputs, build, check=check, one_file=("monthly_churn_rate",)
    )
    stored = Gold(*[commit.read(spark, table) for table in TABLES])
    row_counts(stored).show(truncate=False)
    return quality_report(stored.dim, stored.fact, stored.mart)
