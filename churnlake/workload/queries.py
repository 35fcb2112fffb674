"""One query per operator; each returns a DataFrame for (spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.functions import (
    currency,
    date,
    decimal,
    fingerprint,
    flag,
    lower_text,
    month,
    month_of,
    text,
    title,
    whole_number,
)
from churnlake.layout import Layout
from churnlake.operators import dedupe, keys, quality
from churnlake.operators import reconcile as accounting
from churnlake.operators.rules import REASON
from churnlake.plans import bi, features, forest, gold, increment, model
from churnlake.plans.silver import judged_rows
from churnlake.publish import current, publish, read_parts
from churnlake.scratch import new_dir, stage
from churnlake.sources.arrival import number_arrivals
from churnlake.sources.json_array import read_json_array
from churnlake.sources.readers import (
    SOURCE_ID,
    import_table,
    read_csv,
    read_json,
    with_source_id,
)
from churnlake.sources.specs import CUSTOMERS, KNOWN_CUSTOMER, OFFERS, TICKETS, USAGE, SourceSpec
from churnlake.streaming import landing
from churnlake.workload import defects, lake
from churnlake.workload.dropped import drop_file, small_splits, write_array, write_late_first
from churnlake.workload.raw import RAW, UNKNOWN, as_of, line_counts, raw_text, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DECIMALS = 6

# Added before rounding in both engines. A mean over 32 months can end exactly
# half way between two roundings, where the last digits of a double decide.
NUDGE = 1e-9


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Means depend on the order of addition in their last digits."""
    return df.withColumns({name: F.round(F.col(name) + NUDGE, DECIMALS) for name in names})


# --- sources ------------------------------------------------------------


@query
def bronze_csv_scan(spark, sf_dir):
    path = new_dir(spark, "bronze-customers")
    import_table(RAW["customers"](spark, sf_dir), CUSTOMERS.columns, path)
    return read_csv(spark, path, CUSTOMERS.columns, header=False)


@query
def bronze_csv_header_scan(spark, sf_dir):
    path = new_dir(spark, "bronze-offers")
    raw = raw_text(spark, sf_dir, OFFERS.name, OFFERS.columns)
    keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.toDF(*[f"c{n}" for n in range(len(raw.columns))]).write.options(
        header=True, **keep_spaces
    ).csv(path)
    return read_csv(spark, path, OFFERS.columns, header=True)


@query
def bronze_json_scan(spark, sf_dir):
    """Numbers come back as text, a missing field as NULL, an extra one is left out."""
    path = new_dir(spark, "bronze-usage")
    raw = raw_text(spark, sf_dir, USAGE.name, USAGE.columns)
    written = raw.drop("num_products").withColumns(
        {"customer_id": F.col("customer_id").cast("long"), "extra": F.lit(1)}
    )
    written.write.json(path)
    return read_json(spark, path, USAGE.columns, multi_line=False)


# Text that a reader must not take for structure.
AWKWARD = '"}, {[\\" \\\\ ]}\n}'


@query
def bronze_json_array_scan(spark, sf_dir):
    """Usage as one file of one array, or a few if it is large, cut into many blocks; a
    note holds brackets, quotes, escapes and a line feed, and an inner object its
    customer again."""
    path = new_dir(spark, "bronze-array")
    raw = RAW["usage"](spark, sf_dir)
    note = F.concat(F.lit(AWKWARD), F.col("usage_log_id"))
    written = raw.withColumns(
        {"note": note, "inner": F.struct(F.struct("customer_id").alias("of"), F.lit(1).alias("n"))}
    )
    write_array(written.drop("num_products"), SOURCE_ID, path)
    with small_splits(spark, path):
        return read_json_array(spark, path, [*USAGE.columns, "note", "inner"]).drop(SOURCE_ID)


@query
def bronze_arrival_ids(spark, sf_dir):
    """The first file came last; every file is cut into several blocks."""
    path = write_late_first(spark, sf_dir)
    with small_splits(spark, path, 16 << 10):
        scanned = with_source_id(read_csv(spark, path, CUSTOMERS.columns, header=False))
        stored = stage(scanned.select(*CUSTOMERS.columns, SOURCE_ID), "arrivals")
    numbered = number_arrivals(stored)
    return numbered.select("RowNumber", "CustomerId", F.col(SOURCE_ID).alias("arrival_id"))


class _Stopped(RuntimeError):
    pass


@query
def stream_landing_replace(spark, sf_dir):
    """Events as 23 files, some of which are first dropped with other rows; the
    second batch fails half way and the run is started again."""
    events = table(spark, sf_dir, "events")
    schema = ", ".join(f"{name} {kind}" for name, kind in events.dtypes)
    folder = new_dir(spark, "landing")
    drop = f"{folder}/drop"
    for number in range(23):
        rows = events.where(F.col("event_id") % 23 == number)
        if number % 4 == 0:
            rows = rows.withColumn("value", F.col("value") + 1).where("event_id % 2 = 0")
        drop_file(rows, f"{drop}/day={number % 3}/events-{number}.parquet")
    wanted = (spark, drop, "*.parquet", "parquet", schema, f"{folder}/bronze")

    def fail(batch: int) -> None:
        if batch == 2:
            raise _Stopped

    try:
        landing.land_changes(*wanted, before_record=fail)
    except _Stopped:
        landing.land_changes(*wanted)
    for number in range(0, 23, 4):
        rows = events.where(F.col("event_id") % 23 == number)
        drop_file(rows, f"{drop}/day={number % 3}/events-{number}.parquet")
    landing.land_changes(*wanted)
    return landing.landed_versions(spark, f"{folder}/bronze", schema).select(*events.columns)


@query
def stream_landing(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    schema = ", ".join(f"{name} {kind}" for name, kind in events.dtypes)
    files = landing.watch_files(
        spark, f"{sf_dir}/events.parquet", "*.parquet", "parquet", schema
    )
    folder = new_dir(spark, "landing")
    landing.land(files, f"{folder}/bronze", f"{folder}/checkpoint").awaitTermination()
    return landing.landed_rows(spark, f"{folder}/bronze").select(*events.columns)


# --- standardizers ------------------------------------------------------


@query
def std_text(spark, sf_dir):
    return RAW["customers"](spark, sf_dir).select(
        F.col(SOURCE_ID).alias("row_id"),
        text(F.col("Surname")).alias("surname"),
        title(F.col("Geography")).alias("geography"),
        lower_text(F.col("Gender")).alias("gender"),
    )


@query
def std_currency(spark, sf_dir):
    return RAW["usage"](spark, sf_dir).select(
        F.col(SOURCE_ID).alias("row_id"), currency(F.col("monthly_balance")).alias("balance")
    )


@query
def std_cast(spark, sf_dir):
    return RAW["customers"](spark, sf_dir).select(
        F.col(SOURCE_ID).alias("row_id"),
        whole_number(F.col("Age")).alias("age"),
        whole_number(F.col("CustomerId"), "long").alias("customer_id"),
        decimal(F.col("CreditScore")).alias("credit_score"),
        whole_number(F.col("IsActiveMember")).alias("is_active"),
    )


@query
def std_date(spark, sf_dir):
    return RAW[TICKETS.name](spark, sf_dir).select(
        "ticket_id", "created_at", date(F.col("created_at")).alias("created_on")
    )


@query
def std_bool(spark, sf_dir):
    return RAW["offers"](spark, sf_dir).select(
        "offer_id", F.col("accepted").alias("answer"), flag(F.col("accepted")).alias("accepted")
    )


@query
def std_month(spark, sf_dir):
    return RAW["usage"](spark, sf_dir).select(
        F.col(SOURCE_ID).alias("row_id"), month(F.col("usage_month")).alias("usage_month")
    )


@query
def month_bucket(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", month_of(F.col("o_orderdate")).alias("order_month")
    )


@query
def row_fingerprint(spark, sf_dir):
    rows = lake.standardized(spark, sf_dir, USAGE)
    return rows.select(
        F.col(SOURCE_ID).alias("row_id"), fingerprint(USAGE.columns).alias("row_hash")
    )


# --- deduplication, foreign keys, validation ----------------------------


@query
def dedupe_exact(spark, sf_dir):
    collapsed = dedupe.collapse_copies(
        lake.standardized(spark, sf_dir, USAGE), USAGE.columns, SOURCE_ID
    )
    first = collapsed.select(*USAGE.columns, F.lit(None).cast("string").alias(REASON))
    return first.unionByName(dedupe.surplus_copies(collapsed, USAGE.columns))


@query
def source_lines(spark, sf_dir):
    """Every line item is a row of one source."""
    return line_counts(spark, sf_dir)


@query
def dedupe_key(spark, sf_dir):
    distinct = dedupe.collapse_copies(
        lake.standardized(spark, sf_dir, TICKETS), TICKETS.columns, SOURCE_ID
    ).withColumn(REASON, F.lit(None).cast("string"))
    return dedupe.mark_key_duplicates(
        distinct,
        TICKETS.key,
        SOURCE_ID,
        TICKETS.duplicate_reason,
        F.col(TICKETS.key).isNotNull(),
    ).select(*TICKETS.columns, REASON)


@query
def fk_reference(spark, sf_dir):
    clean = lake.silver_table(spark, sf_dir, CUSTOMERS).clean
    return keys.key_reference(clean, CUSTOMERS.key)


@query
def fk_check(spark, sf_dir):
    rows = lake.standardized(spark, sf_dir, TICKETS)
    flagged = keys.flag_known_keys(
        rows, "customer_id", lake.customer_ids(spark, sf_dir), F.col(SOURCE_ID), KNOWN_CUSTOMER
    )
    return flagged.select(
        "ticket_id", "customer_id", F.col(KNOWN_CUSTOMER).alias("customer_exists")
    )


@query
def fk_semi(spark, sf_dir):
    pairs = gold.monthly_measures(lake.rollup(spark, sf_dir), "offers").select(*gold.ACTIVITY_KEY)
    ids = lake.customer_ids(spark, sf_dir).withColumnRenamed("CustomerId", "customer_id")
    return keys.keep_known_keys(pairs, "customer_id", ids)


def _validated(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    ids = None if spec.foreign_key is None else lake.customer_ids(spark, sf_dir)
    judged = judged_rows(lake.standardized(spark, sf_dir, spec), spec, as_of(), ids)
    return judged.select(*spec.columns, F.col(dedupe.COPIES).alias("copies"), REASON)


@query
def validate_customers(spark, sf_dir):
    return _validated(spark, sf_dir, CUSTOMERS)


@query
def validate_tickets(spark, sf_dir):
    return _validated(spark, sf_dir, TICKETS)


@query
def validate_offers(spark, sf_dir):
    return _validated(spark, sf_dir, OFFERS)


@query
def validate_usage(spark, sf_dir):
    return _validated(spark, sf_dir, USAGE)


# --- silver -------------------------------------------------------------

SPECS = (CUSTOMERS, TICKETS, OFFERS, USAGE)


@query
def silver_customers(spark, sf_dir):
    return lake.build_silver(spark, sf_dir, CUSTOMERS).all_rows


@query
def silver_tickets(spark, sf_dir):
    return lake.build_silver(spark, sf_dir, TICKETS).all_rows


@query
def silver_offers(spark, sf_dir):
    return lake.build_silver(spark, sf_dir, OFFERS).all_rows


@query
def silver_usage(spark, sf_dir):
    return lake.build_silver(spark, sf_dir, USAGE).all_rows


@query
def rejected_union(spark, sf_dir):
    parts = [
        lake.silver_table(spark, sf_dir, spec).rejected.select(
            F.lit(spec.name).alias("dataset"),
            F.col(spec.key).cast("string").alias("business_key"),
            REASON,
        )
        for spec in SPECS
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def rejection_report(spark, sf_dir):
    return accounting.rejection_report(lake.silver_table(spark, sf_dir, TICKETS).rejected)


@query
def reconcile(spark, sf_dir):
    parts = []
    for spec in SPECS:
        silver = lake.silver_table(spark, sf_dir, spec)
        source = RAW[spec.name](spark, sf_dir)
        parts.append(accounting.reconcile(spec.name, source, silver.clean, silver.rejected))
    return reduce(DataFrame.unionByName, parts)


# --- gold ---------------------------------------------------------------


@query
def clv(spark, sf_dir):
    return rounded(gold.customer_measures(lake.rollup(spark, sf_dir), "usage"), "CLV_LTV")


@query
def ticket_avg(spark, sf_dir):
    measures = gold.customer_measures(lake.rollup(spark, sf_dir), "tickets")
    return rounded(measures, "avg_ticket_res_time_hrs")


@query
def usage_monthly(spark, sf_dir):
    months = gold.monthly_measures(lake.rollup(spark, sf_dir), "usage")
    return rounded(months, "total_balance", "avg_balance")


@query
def tickets_monthly(spark, sf_dir):
    months = gold.monthly_measures(lake.rollup(spark, sf_dir), "tickets")
    return rounded(months, "avg_resolution_time")


@query
def offers_monthly(spark, sf_dir):
    months = gold.monthly_measures(lake.rollup(spark, sf_dir), "offers")
    return rounded(months, "acceptance_rate")


@query
def activity_spine(spark, sf_dir):
    """Every (customer, month) with any activity of a known customer."""
    keyed = gold.build_keyed_fact(lake.rollup(spark, sf_dir), lake.dim_table(spark, sf_dir))
    return keyed.select(*gold.ACTIVITY_KEY)


@query
def surrogate_key(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return keys.dense_key(customers, ["c_custkey"], "cust_key")


@query
def surrogate_key_multi(spark, sf_dir):
    pairs = table(spark, sf_dir, "orders").select(
        "o_custkey", month_of(F.col("o_orderdate")).alias("order_month")
    )
    return keys.dense_key(pairs.distinct(), ["o_custkey", "order_month"], "activity_key")


@query
def gold_dim_customer(spark, sf_dir):
    customers = lake.silver_table(spark, sf_dir, CUSTOMERS).clean
    dim = gold.build_dim(customers, lake.rollup(spark, sf_dir))
    return rounded(dim, "CLV_LTV", "avg_ticket_res_time_hrs")


@query
def gold_fact_activity(spark, sf_dir):
    fact = gold.build_keyed_fact(lake.rollup(spark, sf_dir), lake.dim_table(spark, sf_dir))
    return rounded(
        fact.drop("is_churned"),
        "total_balance",
        "avg_balance",
        "avg_resolution_time",
        "acceptance_rate",
    )


@query
def gold_monthly_churn(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    mart = gold.build_mart(gold.with_churn_flag(tables.fact, tables.dim))
    return rounded(mart, "churn_rate")


@query
def gold_row_counts(spark, sf_dir):
    return gold.row_counts(lake.gold_tables(spark, sf_dir))


@query
def gold_tables_register(spark, sf_dir):
    """External tables in a database of their own, read through SQL."""
    tables = lake.gold_tables(spark, sf_dir)
    layout = Layout(new_dir(spark, "registered"))
    for name, df in zip(gold.TABLES, (tables.dim, tables.fact, tables.mart), strict=True):
        df.write.parquet(layout.gold(name))
    database = f"churn_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{layout.root}/database'")
    gold.register_gold(spark, layout, database)
    return spark.sql(
        "SELECT f.activity_month, count(*) AS fact_rows, sum(d.is_churned) AS churned_rows, "
        "max(m.active_customers) AS active_customers "
        f"FROM {database}.fact_customer_activity_gold f "
        f"JOIN {database}.dim_customer_gold d ON f.cust_key = d.cust_key "
        f"JOIN {database}.monthly_churn_rate_gold m ON f.activity_month = m.activity_month "
        "GROUP BY f.activity_month"
    )


@query
def gold_published(spark, sf_dir):
    """Rows of the gold tables as readers see them after a set was published, after
    a run that failed between two tables, and after a set that came through."""
    tables = lake.gold_tables(spark, sf_dir)
    folder = new_dir(spark, "published")
    churned = tables.dim.where("is_churned = 1")
    of_churned = tables.fact.join(churned.select("customer_id"), "customer_id", "left_semi")
    mart = gold.build_mart(gold.with_churn_flag(of_churned, churned))
    small = dict(zip(gold.TABLES, (churned, of_churned, mart), strict=True))
    whole = dict(zip(gold.TABLES, (tables.dim, tables.fact, tables.mart), strict=True))

    def seen(when: str) -> DataFrame:
        found = current(spark, folder)
        rows = gold.row_counts(gold.Gold(*[found.read(spark, name) for name in gold.TABLES]))
        return stage(rows.select(F.lit(when).alias("seen"), "*"), "seen")

    publish(spark, folder, small, keep=1)
    first = seen("first")
    broken = tables.mart.withColumn("churn_rate", F.raise_error(F.lit("stopped")).cast("double"))
    try:
        publish(spark, folder, {**whole, "monthly_churn_rate": broken}, keep=1)
    except Exception as error:
        if "stopped" not in str(error):
            raise
    failed = seen("failed")
    publish(spark, folder, whole, keep=1)
    return first.unionByName(failed).unionByName(seen("second"))


# --- jobs ---------------------------------------------------------------


@query
def job_silver(spark, sf_dir):
    """Every row of all four sources after the silver job, from raw files."""
    layout = lake.job_lake(spark, sf_dir)
    parts = []
    for spec in SPECS:
        key = F.col(spec.key).cast("string").alias("business_key")
        clean = spark.read.parquet(layout.silver(spec.name))
        clean = clean.withColumn(REASON, F.lit(None).cast("string"))
        for rows in (clean, spark.read.parquet(layout.rejected(spec.name))):
            parts.append(rows.select(F.lit(spec.name).alias("dataset"), key, REASON))
    return reduce(DataFrame.unionByName, parts)


@query
def job_gold_dim(spark, sf_dir):
    dim = spark.read.parquet(lake.job_lake(spark, sf_dir).gold("dim_customer"))
    return rounded(dim, "CLV_LTV", "avg_ticket_res_time_hrs")


@query
def job_gold_fact(spark, sf_dir):
    fact = spark.read.parquet(lake.job_lake(spark, sf_dir).gold("fact_customer_activity"))
    return rounded(fact, "total_balance", "avg_balance", "avg_resolution_time", "acceptance_rate")


@query
def job_gold_mart(spark, sf_dir):
    mart = spark.read.parquet(lake.job_lake(spark, sf_dir).gold("monthly_churn_rate"))
    return rounded(mart, "churn_rate")


# --- what changes -------------------------------------------------------

# Activity that comes late, and activity that is first there with other values.
LATE_MONTHS = ("1997-03", "1998-07")


def _dated(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Clean usage, tickets and offers, each with its month."""
    _, tickets, offers, usage = lake.clean_tables(spark, sf_dir)
    month_named = F.col("usage_month")
    return [
        usage.withColumn("_month", month_named),
        tickets.withColumn("_month", month_of(F.col("created_at"))),
        offers.withColumn("_month", month_of(F.col("date_offered"))),
    ]


@query
def rollup_merge(spark, sf_dir):
    """The rollup after rows came late, wrong rows went and others were replaced."""
    rows = _dated(spark, sf_dir)
    late = F.col("customer_id") % 10 == 3
    replaced = F.col("customer_id") % 10 == 5
    wrong = [
        rows[0].where(replaced).withColumn("monthly_balance", F.col("monthly_balance") + 100),
        rows[1].where(replaced).withColumn("created_at", F.add_months("created_at", 1)),
        rows[2].where(replaced).withColumn("accepted", 1 - F.col("accepted")),
    ]
    # Rows of customers that are in no clean row at all: they go without trace.
    stray = [part.withColumn("customer_id", F.col("customer_id") + UNKNOWN) for part in wrong]
    removed = [one.unionByName(two) for one, two in zip(wrong, stray, strict=True)]
    kept = [part.where(~late & ~replaced) for part in rows]
    first = [one.unionByName(two) for one, two in zip(kept, removed, strict=True)]
    state = stage(gold.activity_rollup(*first), "rollup-before")
    added = [part.where(late | replaced) for part in rows]
    merged = increment.update_rollup(state, added, removed)
    return rounded(
        gold.monthly_measures(merged),
        "total_balance", "avg_balance", "avg_resolution_time", "acceptance_rate",
    )


@query
def gold_fact_increment(spark, sf_dir):
    """The fact after late rows in two months: only those are built again, and keys
    that were there stay."""
    rows = _dated(spark, sf_dir)
    late = F.col("_month").isin(*LATE_MONTHS) & (F.col("customer_id") % 3 == 0)
    folder, dim = new_dir(spark, "fact"), lake.dim_table(spark, sf_dir)
    early = [part.where(~late) for part in rows]
    added = [part.where(late) for part in rows]
    before = stage(gold.activity_rollup(*early), "rollup-before")
    first = increment.store_fact(spark, folder, before, dim)
    months = increment.changed_months(added)
    after = stage(increment.update_rollup(before, added), "rollup-after")
    second = increment.update_fact(spark, folder, after, dim, months)
    rebuilt = {name for name in second.tables if second.tables[name] != first.tables.get(name)}
    fact = read_parts(spark, second)
    was = read_parts(spark, first).select(*gold.ACTIVITY_KEY, F.col("activity_key").alias("was"))
    size = fact.agg(F.count("*").alias("n"), F.countDistinct("activity_key").alias("keys")).first()
    return rounded(
        fact.join(was, list(gold.ACTIVITY_KEY), "left")
        .withColumn("key_kept", F.col("activity_key") == F.col("was"))
        .withColumn("keys_dense", (F.col("activity_key").between(1, size.n)) & F.lit(size.n == size.keys))
        .withColumn("rebuilt", F.col("activity_month").isin(*rebuilt))
        .drop("was", "activity_key"),
        "total_balance", "avg_balance", "avg_resolution_time", "acceptance_rate",
    )


# --- quality ------------------------------------------------------------


@query
def dq_report(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    return quality.quality_report(tables.dim, tables.fact, tables.mart)


@query
def dq_report_defects(spark, sf_dir):
    """The same checks over gold tables in which every check has offenders."""
    tables = lake.gold_tables(spark, sf_dir)
    return quality.quality_report(
        defects.with_defects(tables.dim, defects.DIM),
        defects.with_defects(tables.fact, defects.FACT),
        defects.with_defects(tables.mart, defects.MART),
    )


@query
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_groups(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def dq_orphans(spark, sf_dir):
    clean = lake.silver_table(spark, sf_dir, CUSTOMERS).clean
    parents = clean.select(F.col("CustomerId").alias("customer_id"))
    return keys.orphan_keys(lake.standardized(spark, sf_dir, USAGE), parents, "customer_id")


@query
def dq_orphan_rows(spark, sf_dir):
    clean = lake.silver_table(spark, sf_dir, CUSTOMERS).clean
    parents = clean.select(F.col("CustomerId").alias("customer_id"))
    return keys.orphan_row_count(lake.standardized(spark, sf_dir, USAGE), parents, "customer_id")


# --- business questions -------------------------------------------------


@query
def bi_q01(spark, sf_dir):
    return rounded(bi.highest_value_customers(lake.gold_tables(spark, sf_dir).dim), "CLV_LTV")


@query
def bi_q02(spark, sf_dir):
    return bi.churn_by_value_segment(lake.gold_tables(spark, sf_dir).dim)


@query
def bi_q03(spark, sf_dir):
    return bi.worst_churn_months(lake.gold_tables(spark, sf_dir).mart)


@query
def bi_q04(spark, sf_dir):
    return bi.churn_trend(lake.gold_tables(spark, sf_dir).mart)


@query
def bi_q05(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    return rounded(bi.most_supported_customers(tables.fact, tables.dim), "CLV_LTV")


@query
def bi_q06(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    return bi.churn_by_resolution_time(tables.fact, tables.dim)


@query
def bi_q07(spark, sf_dir):
    return bi.offer_effectiveness(lake.gold_tables(spark, sf_dir).fact)


@query
def bi_q08(spark, sf_dir):
    return bi.value_by_products(lake.gold_tables(spark, sf_dir).dim)


@query
def bi_q09(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    return bi.churn_by_balance(tables.fact, tables.dim)


@query
def bi_q10(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    return bi.churn_by_engagement(tables.fact, tables.dim)


@query
def bi_q11(spark, sf_dir):
    return bi.churn_by_products(lake.gold_tables(spark, sf_dir).dim)


@query
def bi_q12(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    return rounded(bi.retention_priorities(tables.fact, tables.dim), "CLV_LTV")


@query
def bi_q13(spark, sf_dir):
    tables = lake.gold_tables(spark, sf_dir)
    return bi.risk_segments(tables.fact, tables.dim)


# The same questions over tables that are laid out by customer.


@query
def bucketed_q05(spark, sf_dir):
    dim, fact = lake.bucketed_tables(spark, sf_dir)
    return rounded(bi.most_supported_customers(fact, dim), "CLV_LTV")


@query
def bucketed_q06(spark, sf_dir):
    dim, fact = lake.bucketed_tables(spark, sf_dir)
    return bi.churn_by_resolution_time(fact, dim)


@query
def bucketed_q09(spark, sf_dir):
    dim, fact = lake.bucketed_tables(spark, sf_dir)
    return bi.churn_by_balance(fact, dim, gold.JOIN_KEY)


@query
def bucketed_q10(spark, sf_dir):
    dim, fact = lake.bucketed_tables(spark, sf_dir)
    return bi.churn_by_engagement(fact, dim, gold.JOIN_KEY)


@query
def bucketed_q13(spark, sf_dir):
    dim, fact = lake.bucketed_tables(spark, sf_dir)
    return bi.risk_segments(fact, dim)


# --- churn model --------------------------------------------------------

MEANS = tuple(
    name for name in features.FEATURES if name == "CLV_LTV" or name.startswith("avg_")
) + ("last_total_balance",)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = lake.gold_tables(spark, sf_dir)
    return features.customer_features(tables.dim, tables.fact)


@query
def ml_features(spark, sf_dir):
    return rounded(_features(spark, sf_dir), *MEANS)


@query
def ml_last_activity(spark, sf_dir):
    last = features.last_activity(lake.gold_tables(spark, sf_dir).fact)
    return rounded(last, "last_total_balance")


@query
def ml_class_balance(spark, sf_dir):
    return rounded(features.class_balance(_features(spark, sf_dir)), "share")


@query
def ml_corr(spark, sf_dir):
    return rounded(features.label_correlation(_features(spark, sf_dir)), "correlation")


@query
def ml_missing(spark, sf_dir):
    return features.missing_values(_features(spark, sf_dir))


@query
def ml_split(spark, sf_dir):
    split = features.stratified_split(_features(spark, sf_dir))
    return split.select("customer_id", "is_churned", "split")


@query
def ml_train(spark, sf_dir):
    """Importance of every feature of the baseline model."""
    baseline, _, _ = lake.trained(spark, sf_dir)
    return spark.createDataFrame(
        model.importances(baseline), "feature string, importance double"
    )


@query
def ml_importance(spark, sf_dir):
    """Importance of the features kept for the final model."""
    _, final, _ = lake.trained(spark, sf_dir)
    return spark.createDataFrame(model.importances(final), "feature string, importance double")


@query
def ml_score(spark, sf_dir):
    _, final, _ = lake.trained(spark, sf_dir)
    return model.ranked_by_risk(model.predict(final, _features(spark, sf_dir)))


@query
def ml_score_nodes(spark, sf_dir):
    """Predictions from the model as a table, and whether they are the model's."""
    nodes, inputs = lake.final_nodes(spark, sf_dir)
    _, final, _ = lake.trained(spark, sf_dir)
    found = forest.score_with_nodes(_features(spark, sf_dir), nodes, inputs, model.DEPTH)
    own = model.predict(final, _features(spark, sf_dir)).select(
        "customer_id",
        F.col("churn_probability").alias("p"),
        F.col("predicted_churn").alias("predicted"),
        F.col("prediction_label").alias("label"),
    )
    same = (
        (F.abs(F.col("churn_probability") - F.col("p")) < 1e-9)
        & (F.col("predicted_churn") == F.col("predicted"))
        & (F.col("prediction_label") == F.col("label"))
    )
    return found.join(own, "customer_id").select("customer_id", "actual_churn", same.alias("same"))


def _test_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, final, _ = lake.trained(spark, sf_dir)
    _, test = lake.split_features(spark, sf_dir)
    return model.score(final, test)


@query
def ml_eval(spark, sf_dir):
    _, final, _ = lake.trained(spark, sf_dir)
    _, test = lake.split_features(spark, sf_dir)
    return spark.createDataFrame(
        list(model.evaluate(final, test).items()), "metric string, value double"
    )


@query
def ml_compare(spark, sf_dir):
    baseline, final, _ = lake.trained(spark, sf_dir)
    _, test = lake.split_features(spark, sf_dir)
    before, after = model.evaluate(baseline, test), model.evaluate(final, test)
    rows = [(name, before[name], after[name], after[name] - before[name]) for name in before]
    return spark.createDataFrame(
        rows, "metric string, baseline double, final double, difference double"
    )


@query
def ml_confusion(spark, sf_dir):
    return model.confusion_matrix(_test_predictions(spark, sf_dir))


@query
def ml_class_report(spark, sf_dir):
    return model.class_report(_test_predictions(spark, sf_dir))


def _rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions without a forest: few accepted offers mean a risk. SQL can
    state them, so the metrics can be compared value by value."""
    accepted = F.coalesce("total_accepted_offers", F.lit(0))
    return _features(spark, sf_dir).select(
        F.col("is_churned").alias("actual_churn"),
        F.when(accepted < 6, 1).otherwise(0).alias("predicted_churn"),
        (-accepted).alias("churn_probability"),
    )


@query
def ml_confusion_rule(spark, sf_dir):
    return model.confusion_matrix(_rule_predictions(spark, sf_dir))


@query
def ml_class_report_rule(spark, sf_dir):
    report = model.class_report(_rule_predictions(spark, sf_dir))
    return rounded(report, "precision", "recall", "f1")


@query
def ml_eval_rule(spark, sf_dir):
    predictions = _rule_predictions(spark, sf_dir)
    area = model.roc_auc(predictions)
    return rounded(
        model.accuracy(predictions).withColumn("roc_auc", F.lit(area)), "accuracy", "roc_auc"
    )


@query
def ml_class_weights(spark, sf_dir):
    training, _ = lake.split_features(spark, sf_dir)
    weighted = model.with_class_weights(training)
    weights = weighted.groupBy("is_churned", "weight").agg(F.count(F.lit(1)).alias("customers"))
    return rounded(weights, "weight")


@query
def ml_scaler(spark, sf_dir):
    """Mean and sample deviation that the baseline's scaler learned."""
    baseline, _, _ = lake.trained(spark, sf_dir)
    assembler, scaler = baseline.stages[:2]
    learned = zip(assembler.getInputCols(), scaler.mean.tolist(), scaler.std.tolist(), strict=True)
    rows = spark.createDataFrame(list(learned), "feature string, mean double, deviation double")
    return rows.select(
        "feature", *[F.round(F.col(name) + NUDGE, 3).alias(name) for name in ("mean", "deviation")]
    )


@query
def ml_score_rules(spark, sf_dir):
    """Whether each prediction of the final model agrees with its probability."""
    _, final, _ = lake.trained(spark, sf_dir)
    likely = F.col("churn_probability") > 0.5
    text_of = F.when(likely, "Likely to churn").otherwise("Likely to stay")
    return model.predict(final, _features(spark, sf_dir)).select(
        "customer_id",
        "actual_churn",
        (
            F.col("churn_probability").between(0, 1)
            & (F.col("predicted_churn") == likely.cast("int"))
            & (F.col("prediction_label") == text_of)
        ).alias("consistent"),
    )


@query
def ml_importance_total(spark, sf_dir):
    """The names of the baseline's importances, and what they add up to."""
    baseline, _, _ = lake.trained(spark, sf_dir)
    weights = model.importances(baseline)
    total = sum(weight for _, weight in weights)
    rows = [(name, weight >= 0, round(total, 6)) for name, weight in weights]
    return spark.createDataFrame(rows, "feature string, not_negative boolean, total double")


@query
def ml_separable_score(spark, sf_dir):
    """How sure the forest is depends on the features its nodes draw; what SQL can
    state is that it is a probability on the right side of a half."""
    split, final, _ = lake.separable(spark, sf_dir)
    ranked = model.ranked_by_risk(model.predict(final, split))
    sure = F.col("churn_probability")
    right = sure.between(0, 1) & ((sure > 0.5) == (F.col("predicted_churn") == 1))
    return ranked.withColumn("probability_is_right", right).drop("churn_probability")


def _separable_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    split, final, _ = lake.separable(spark, sf_dir)
    return model.score(final, split.where("split = 'test'"))


@query
def ml_separable_confusion(spark, sf_dir):
    return model.confusion_matrix(_separable_test(spark, sf_dir))


@query
def ml_separable_class_report(spark, sf_dir):
    return model.class_report(_separable_test(spark, sf_dir))


@query
def ml_separable_eval(spark, sf_dir):
    split, final, _ = lake.separable(spark, sf_dir)
    found = model.evaluate(final, split.where("split = 'test'"))
    rows = [(metric, round(value, 6)) for metric, value in found.items()]
    return spark.createDataFrame(rows, "metric string, value double")


@query
def ml_separable_first(spark, sf_dir):
    """The most important feature, and whether the final model has it."""
    _, final, weights = lake.separable(spark, sf_dir)
    first = weights[0][0]
    kept = first in final.stages[0].getInputCols()
    return spark.createDataFrame([(first, kept)], "feature string, kept boolean")
