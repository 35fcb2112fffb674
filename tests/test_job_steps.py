"""What the batch jobs read, move and store no more often than they must."""

import datetime
import json

import pytest
from churnlake.functions import month_of
from churnlake.plans import gold, silver
from churnlake.scratch import stage
from churnlake.sources.arrival import SOURCE_ID, number_arrivals
from churnlake.sources.json_array import array_records
from churnlake.sources.readers import read_csv, with_source_id
from churnlake.sources.specs import CUSTOMERS, TICKETS
from churnlake.workload import dropped, raw
from pyspark.sql import functions as F
from silver_rows import AS_OF
from test_jobs import layout  # noqa: F401


def plan_of(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def settings(spark):
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


def test_rows_are_numbered_without_a_shuffle(spark, settings, tmp_path):
    lines = [f"{n},{n * 7919 % 100_003:08d}{n * 104_729:010d}" for n in range(30_000)]
    (tmp_path / "x.csv").write_text("\n".join(lines))
    stored = stage(with_source_id(read_csv(spark, str(tmp_path), ["n", "t"], header=False)), "rows")
    settings("spark.sql.autoBroadcastJoinThreshold", "40000")
    numbered = number_arrivals(stored)
    plan = plan_of(numbered, "executedPlan")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    rows = numbered.orderBy(SOURCE_ID).collect()
    assert [(row[SOURCE_ID], row.n) for row in rows] == [(n + 1, str(n)) for n in range(30_000)]


def lines(spark, tmp_path):
    """Line items with lines and parts that come again, and some without a date."""
    day = datetime.datetime(1995, 3, 1)
    rows = [
        (n * 37 % 40, n * 11 % 5, n % 3, n % 4, float(n % 50 + 1), "R" if n % 2 else "A", "F",
         None if n % 41 == 0 else day + datetime.timedelta(days=n * 17 % 90))
        for n in range(300)
    ]
    spark.createDataFrame(
        rows,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))


def test_lines_are_ordered_by_numbers_as_by_their_ids(spark, tmp_path):
    lines(spark, tmp_path)
    source = raw.RAW[TICKETS.name]
    rows = source.rows(spark, str(tmp_path))
    expected = [row[0] for row in rows.orderBy(SOURCE_ID).select(SOURCE_ID).collect()]
    found = [row[0] for row in rows.orderBy(*source.order()).select(SOURCE_ID).collect()]
    assert found == expected and None in found and len(set(found)) > 100


def test_cells_are_made_of_rows_that_are_in_order(spark, tmp_path):
    lines(spark, tmp_path)
    rows = dropped.in_arrival_order(spark, str(tmp_path), TICKETS)
    moved = plan_of(rows).split("RepartitionByExpression", 1)[1]
    assert "app_bug" in plan_of(rows) and "app_bug" not in moved
    expected = raw.RAW[TICKETS.name](spark, str(tmp_path)).drop(SOURCE_ID)
    assert sorted(map(str, rows.collect())) == sorted(map(str, expected.collect()))


def test_a_file_is_found_by_halving_the_bounds(spark):
    bounds = [float(n * 3) for n in range(113)]
    rows = spark.range(-5, 400).select("id", dropped._file_number(F.col("id"), bounds).alias("n"))
    assert all(row.n == sum(row.id > bound for bound in bounds) for row in rows.collect())
    assert str(dropped._file_number(F.col("id"), bounds)).count("WHEN") <= 113


def test_nothing_is_summed_over_the_pieces_of_flat_records(spark, settings, tmp_path):
    records = [{"a": str(n), "b": f"x,{n}", "c": None} for n in range(2000)]
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        settings(name, "9000")
    (tmp_path / "x.json").write_text("[" + "\n,".join(map(json.dumps, records)) + "\n]\n")
    found = array_records(spark, str(tmp_path))
    assert "Window" not in plan_of(found)
    rows = found.orderBy("arrival").collect()
    assert [json.loads(row.record) for row in rows] == records
    assert [row.arrival.place for row in rows] == list(range(2000))


def test_the_fact_is_not_stored_again_before_it_is_published(spark, layout, monkeypatch):  # noqa: F811
    silver.run_silver(spark, layout, F.to_date(F.lit(AS_OF)))
    labels, plain = [], gold.stage
    monkeypatch.setattr(gold, "stage", lambda df, label: labels.append(label) or plain(df, label))
    gold.run_gold(spark, layout)
    assert labels == ["dim"]


def test_only_copies_are_moved_to_be_published(spark, layout, monkeypatch):  # noqa: F811
    tables, step = {}, silver.step

    def keep(spark, folder, inputs, build, **options):
        assert not options.get("rebalance")

        def kept():
            tables.update(build())
            return tables

        return step(spark, folder, inputs, kept, **options)

    monkeypatch.setattr(silver, "step", keep)
    silver.run_source(spark, CUSTOMERS, layout, F.to_date(F.lit(AS_OF)))
    below = plan_of(tables["rejected"]).split("RebalancePartitions", 1)[1]
    assert "_copies" in below
    assert tables["rejected"].count() == 2


def test_months_of_dates_and_times(spark):
    texts = ["2001-02-03", "0044-03-15", "9999-12-31", "10000-01-01", None]
    dates = spark.createDataFrame([(text,) for text in texts], "t string").select(
        F.when(F.col("t") == "10000-01-01", F.date_add(F.lit("9999-12-31").cast("date"), 1))
        .otherwise(F.col("t").cast("date"))
        .alias("d")
    )
    for value in (F.col("d"), F.col("d").cast("timestamp")):
        both = dates.select(month_of(value), F.date_format(value, "yyyy-MM")).collect()
        assert all(row[0] == row[1] for row in both)
        assert both[0][0] == "2001-02" and both[-1][0] is None
