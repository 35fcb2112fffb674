import datetime

import pytest
from pyspark.sql import functions as F

from churnlake.operators import quality
from churnlake.plans import gold
from churnlake.scratch import stage

CUSTOMERS = "CustomerId long, Exited int, NumOfProducts int"
TICKETS = "ticket_id string, customer_id long, resolution_time_hrs double, created_at date"
OFFERS = "offer_id string, customer_id long, accepted int, date_offered date"
USAGE = "usage_log_id string, customer_id long, usage_month string, monthly_balance double"


def day(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="module")
def silver(spark):
    customers = [(10, 0, 1), (20, 1, 2), (30, 0, 3), (40, 0, 1)]
    tickets = [("t1", 20, 10.0, day("2025-02-03")), ("t2", 20, 20.0, day("2025-03-04"))]
    offers = [
        ("o1", 10, 1, day("2025-01-05")),
        ("o2", 10, 0, day("2025-01-06")),
        ("o3", 99, 1, day("2025-01-07")),
    ]
    usage = [
        ("u1", 10, "2025-01", 100.0),
        ("u2", 10, "2025-01", 300.0),
        ("u3", 10, "2025-02", 200.0),
        ("u4", 20, "2025-01", 50.0),
        ("u5", 40, "2025-04", 5.0),
    ]
    return (
        spark.createDataFrame(customers, CUSTOMERS),
        spark.createDataFrame(tickets, TICKETS),
        spark.createDataFrame(offers, OFFERS),
        spark.createDataFrame(usage, USAGE),
    )


@pytest.fixture(scope="module")
def built(silver):
    tables = gold.build_gold(*silver)
    return gold.Gold(tables.dim.persist(), tables.fact.persist(), tables.mart.persist())


def test_dimension(built):
    rows = {row.customer_id: row for row in built.dim.collect()}
    assert [rows[n].cust_key for n in (10, 20, 30, 40)] == [1, 2, 3, 4]
    # Mean of 100, 300 and 200 over three rows, times two active months.
    assert rows[10].CLV_LTV == 400.0
    assert rows[20].avg_ticket_res_time_hrs == 15.0
    assert (rows[30].CLV_LTV, rows[30].avg_ticket_res_time_hrs) == (0.0, 0.0)
    assert rows[30].dw_end_date == day("9999-12-31")
    assert rows[30].dw_start_date == day("2026-09-03")


def test_fact(built):
    rows = {(row.customer_id, row.activity_month): row for row in built.fact.collect()}
    assert set(rows) == {
        (10, "2025-01"),
        (10, "2025-02"),
        (20, "2025-01"),
        (20, "2025-02"),
        (20, "2025-03"),
        (40, "2025-04"),
    }
    january = rows[10, "2025-01"]
    assert (january.usage_events, january.total_balance, january.avg_balance) == (2, 400.0, 200.0)
    assert (january.offer_count, january.accepted_offers, january.acceptance_rate) == (2, 1, 0.5)
    only_ticket = rows[20, "2025-03"]
    assert (only_ticket.usage_events, only_ticket.total_balance, only_ticket.offer_count) == (
        0,
        0.0,
        0,
    )
    assert [rows[key].activity_key for key in sorted(rows)] == list(range(1, 7))
    assert built.fact.columns == list(gold.FACT_COLUMNS)


def test_mart(built):
    rows = {row.activity_month: row for row in built.mart.collect()}
    assert (rows["2025-01"].active_customers, rows["2025-01"].churned_customers) == (2, 1)
    assert rows["2025-01"].churn_rate == 0.5
    assert rows["2025-04"].churn_rate == 0.0
    stored = gold.build_mart(gold.with_churn_flag(built.fact, built.dim))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.values()))


def test_rollup_equals_separate_rollups(spark, silver):
    for name, rows in zip(("customers", "tickets", "offers", "usage"), silver, strict=True):
        rows.createOrReplaceTempView(f"separate_{name}")
    _, tickets, offers, usage = silver
    rollup = gold.activity_rollup(usage, tickets, offers)
    by_month = "FROM separate_{} GROUP BY customer_id, activity_month"
    separate = {
        "usage": "SELECT customer_id, usage_month AS activity_month, count(usage_log_id), "
        "sum(monthly_balance), avg(monthly_balance)",
        "tickets": "SELECT customer_id, date_format(created_at, 'yyyy-MM') AS activity_month, "
        "count(ticket_id), avg(resolution_time_hrs)",
        "offers": "SELECT customer_id, date_format(date_offered, 'yyyy-MM') AS activity_month, "
        "count(offer_id), count_if(accepted = 1), avg(accepted)",
    }
    months = set()
    for source, query in separate.items():
        rows = sorted(map(tuple, spark.sql(f"{query} {by_month.format(source)}").collect()))
        assert sorted(map(tuple, gold.monthly_measures(rollup, source).collect())) == rows
        months.update(row[:2] for row in rows)
    spine = gold.monthly_measures(rollup).select(*gold.ACTIVITY_KEY).collect()
    assert sorted(map(tuple, spine)) == sorted(months)
    overall = {
        "usage": "SELECT customer_id, avg(monthly_balance) * count(DISTINCT usage_month)",
        "tickets": "SELECT customer_id, avg(resolution_time_hrs)",
    }
    for source, query in overall.items():
        rows = spark.sql(f"{query} FROM separate_{source} GROUP BY customer_id").collect()
        measures = {row[0]: row[1] for row in gold.customer_measures(rollup, source).collect()}
        assert measures == {row[0]: pytest.approx(row[1]) for row in rows}


def test_rollup_takes_one_shuffle(silver):
    _, tickets, offers, usage = silver
    plan = gold.activity_rollup(usage, tickets, offers)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_usage_month_date_is_preferred(spark):
    usage = spark.createDataFrame(
        [("u", 1, "junk", day("2024-05-06"), 1.0)],
        "usage_log_id string, customer_id long, usage_month string, usage_month_date date, "
        "monthly_balance double",
    )
    assert gold.dated_rows(usage, "usage").first().activity_month == "2024-05"
    raw = usage.drop("usage_month", "usage_month_date").crossJoin(
        spark.createDataFrame([("10/2025",), ("2025/10",)], "usage_month string")
    )
    assert {row.activity_month for row in gold.dated_rows(raw, "usage").collect()} == {"2025-10"}


def test_customer_columns_in_lower_case(spark):
    customers = spark.createDataFrame(
        [(1, 0, 2), (None, 0, 1), (1, 1, 1)], "customerid long, exited int, numofproducts int"
    )
    assert [tuple(row) for row in gold.customer_base(customers).collect()] == [(1, 0, 2)]


def report(dim, fact, mart):
    rows = quality.quality_report(dim, fact, mart).collect()
    return {(row.table_name, row.check_name): row.offenders for row in rows}


def test_quality_passes(built):
    rows = quality.quality_report(built.dim, built.fact, built.mart)
    assert rows.count() == 23
    quality.require_passed(rows)


def spoil(df, column, value, condition):
    return df.withColumn(column, F.when(F.expr(condition), F.expr(value)).otherwise(F.col(column)))


DEFECTS = [
    ("dim", "cust_key", "NULL", "null_cust_key", {"orphan_cust_key"}),
    ("dim", "customer_id", "NULL", "null_customer_id", set()),
    ("dim", "is_churned", "2", "invalid_is_churned", set()),
    ("dim", "is_churned", "NULL", "invalid_is_churned", set()),
    ("dim", "CLV_LTV", "-1.0", "negative_clv_ltv", set()),
    ("dim", "avg_ticket_res_time_hrs", "-1.0", "negative_avg_ticket_res_time", set()),
    ("fact", "activity_key", "NULL", "null_activity_key", set()),
    ("fact", "cust_key", "NULL", "null_cust_key", {"orphan_cust_key"}),
    ("fact", "cust_key", "77", "orphan_cust_key", set()),
    ("fact", "customer_id", "NULL", "null_customer_id", set()),
    ("fact", "activity_month", "'2025-13'", "invalid_activity_month", set()),
    ("fact", "activity_month", "NULL", "invalid_activity_month", set()),
    ("fact", "acceptance_rate", "1.5", "invalid_acceptance_rate", set()),
    ("fact", "usage_events", "-1", "negative_usage_events", set()),
    ("fact", "total_balance", "-1.0", "negative_total_balance", set()),
    ("fact", "ticket_count", "-1", "negative_ticket_count", set()),
    ("fact", "offer_count", "-1", "negative_offer_count", {"accepted_above_offered"}),
    ("fact", "accepted_offers", "-1", "negative_accepted_offers", set()),
    ("fact", "accepted_offers", "offer_count + 1", "accepted_above_offered", set()),
    ("mart", "churn_rate", "1.5", "invalid_churn_rate", set()),
    ("mart", "churned_customers", "active_customers + 1", "churned_above_active", set()),
]


@pytest.mark.parametrize(("table", "column", "value", "check", "also"), DEFECTS)
def test_each_row_check_fires(built, table, column, value, check, also):
    condition = {
        "dim": "customer_id = 10",
        "fact": "activity_key = 6",
        "mart": "activity_month = '2025-04'",
    }[table]
    tables = {"dim": built.dim, "fact": built.fact, "mart": built.mart}
    tables[table] = spoil(tables[table], column, value, condition)
    found = report(**tables)
    fired = {name for (_, name), offenders in found.items() if offenders}
    assert fired == {check} | also


def test_failed_report_raises(built):
    bad = spoil(built.dim, "is_churned", "2", "customer_id = 10")
    with pytest.raises(quality.QualityError, match="dim_customer.invalid_is_churned=1"):
        quality.require_passed(quality.quality_report(bad, built.fact, built.mart))


@pytest.mark.parametrize(
    ("table", "columns", "check"),
    [
        ("dim", {"customer_id": "customer_id + 1"}, "duplicate_cust_key"),
        ("dim", {"cust_key": "cust_key + 100"}, "duplicate_customer_id"),
        ("fact", {"activity_month": "'2030-01'"}, "duplicate_activity_key"),
        ("fact", {"activity_key": "activity_key + 100"}, "duplicate_customer_month"),
    ],
)
def test_each_uniqueness_check_fires(built, table, columns, check):
    tables = {"dim": built.dim, "fact": built.fact, "mart": built.mart}
    again = tables[table].limit(1)
    for name, value in columns.items():
        again = again.withColumn(name, F.expr(value).cast(again.schema[name].dataType))
    tables[table] = tables[table].unionByName(again)
    found = report(**tables)
    assert {name for (_, name), offenders in found.items() if offenders} == {check}


def test_row_checks_take_one_pass(built):
    df = quality.row_offenders(stage(built.fact, "fact"), quality.fact_checks())
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
