import json
import os

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from silver_rows import AS_OF, GOOD

from churnlake import jobs
from churnlake.layout import Layout
from churnlake.plans.gold import build_gold, read_gold, register_gold, run_gold
from churnlake.plans.silver import run_silver
from churnlake.scratch import application_dir, shared_dir
from churnlake.sources.readers import (
    import_table,
    read_bronze,
    read_csv,
    read_json,
    require_absent,
    require_inputs,
)
from churnlake.sources.specs import CUSTOMERS, OFFERS, TICKETS, USAGE


def write_csv(folder, spec, changes, header):
    os.makedirs(folder)
    with open(f"{folder}/part.csv", "w") as file:
        if header:
            file.write(",".join(f"h{n}" for n in range(len(spec.columns))) + "\n")
        for change in changes:
            row = {**GOOD[spec.name], **change}
            file.write(",".join(f'"{row[name]}"' for name in spec.columns) + "\n")


@pytest.fixture
def layout(tmp_path):
    lake = Layout(str(tmp_path))
    write_csv(
        lake.bronze(CUSTOMERS.name),
        CUSTOMERS,
        [{}, {}, {"RowNumber": "3", "CustomerId": "200", "Exited": "1"}, {"Age": "9"}],
        header=False,
    )
    write_csv(
        lake.bronze(TICKETS.name), TICKETS, [{}, {"ticket_id": "T2", "customer_id": "1"}], True
    )
    write_csv(
        lake.bronze(OFFERS.name), OFFERS, [{}, {"offer_id": "O2", "customer_id": "1"}], True
    )
    os.makedirs(lake.bronze(USAGE.name))
    usage = [GOOD[USAGE.name] | {"customer_id": 100}, {"usage_log_id": "U2", "extra": 1}]
    with open(f"{lake.bronze(USAGE.name)}/usage.json", "w") as file:
        json.dump(usage, file, indent=2)
    return lake


def test_pipeline(spark, layout):
    as_of = F.to_date(F.lit(AS_OF))
    status = run_silver(spark, layout, as_of)
    assert status == {spec.name: "SUCCESS" for spec in (CUSTOMERS, TICKETS, OFFERS, USAGE)}
    rejected = spark.read.parquet(layout.rejected(CUSTOMERS.name))
    assert sorted(row.rejection_reason for row in rejected.collect()) == [
        "exact_duplicate",
        "invalid_age",
    ]
    assert spark.read.parquet(layout.customer_ids).count() == 2
    assert spark.read.parquet(layout.rejected(USAGE.name)).first().rejection_reason == (
        "missing_customer_id"
    )
    report = run_gold(spark, layout, valid_from="2024-01-01")
    assert report.count() == 23
    tables = read_gold(spark, layout)
    assert (tables.dim.count(), tables.fact.count(), tables.mart.count()) == (2, 1, 1)
    assert str(tables.dim.first().dw_start_date) == "2024-01-01"
    with pytest.raises(FileExistsError):
        run_gold(spark, layout)
    run_gold(spark, layout, replace=True)
    spark.sql("DROP DATABASE IF EXISTS churn_test CASCADE")
    spark.sql("CREATE DATABASE churn_test")
    register_gold(spark, layout, "churn_test")
    assert spark.sql("SELECT count(*) FROM churn_test.dim_customer_gold").first()[0] == 2
    spark.sql("DROP DATABASE churn_test CASCADE")


def test_gold_needs_silver(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="usage"):
        run_gold(spark, Layout(str(tmp_path)))


def test_failed_customers_end_the_run(spark, tmp_path):
    status = run_silver(spark, Layout(str(tmp_path)), F.current_date())
    assert list(status) == [CUSTOMERS.name]
    assert status[CUSTOMERS.name].startswith("FAILED")


def test_another_failed_source_leaves_the_rest(spark, layout, tmp_path):
    os.rename(layout.bronze(TICKETS.name), str(tmp_path / "elsewhere"))
    status = run_silver(spark, layout)
    assert status[TICKETS.name].startswith("FAILED")
    assert (status[OFFERS.name], status[USAGE.name]) == ("SUCCESS", "SUCCESS")


def test_command_line(spark, layout):
    assert jobs.main(["silver", layout.root, "--as-of", AS_OF]) == 0
    assert jobs.main(["gold", layout.root]) == 0
    assert jobs.main(["silver", f"{layout.root}/nowhere"]) == 1


def test_csv_width_is_checked_in_every_file(spark, layout, tmp_path):
    with pytest.raises((PySparkException, Py4JError), match="MALFORMED"):
        read_csv(spark, layout.bronze(TICKETS.name), OFFERS.columns, header=True).collect()
    for name, text in (("a", "1,2,3\n"), ("b", "4,5\n"), ("c", "6,7,8,9\n")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.csv").write_text(text)
    read = lambda *names: read_csv(
        spark, f"{tmp_path}/{{{','.join(names)}}}", ["x", "y", "z"], header=False
    ).collect()
    assert [tuple(row) for row in read("a")] == [("1", "2", "3")]
    for narrow_or_wide in ("b", "c"):
        with pytest.raises((PySparkException, Py4JError), match="MALFORMED"):
            read("a", narrow_or_wide)


def test_jobs_leave_no_staging_tables(spark, layout):
    def staged():
        folder = spark._jvm.org.apache.hadoop.fs.Path(application_dir(spark))
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        return {str(s.getPath()) for s in system.listStatus(folder)} if system.exists(folder) else set()

    before = staged()
    assert jobs.main(["silver", layout.root, "--as-of", AS_OF]) == 0
    assert jobs.main(["gold", layout.root]) == 0
    assert jobs.main(["silver", f"{layout.root}/nowhere"]) == 1
    assert staged() == before


def test_a_failed_check_leaves_the_stored_tables(spark, layout, monkeypatch):
    assert jobs.main(["silver", layout.root, "--as-of", AS_OF]) == 0
    run_gold(spark, layout)
    before = read_gold(spark, layout).dim.count()

    def fail(report):
        raise ValueError("check failed")

    monkeypatch.setattr("churnlake.plans.gold.require_passed", fail)
    with pytest.raises(ValueError, match="check failed"):
        run_gold(spark, layout, valid_from="1999-01-01", replace=True)
    dim = read_gold(spark, layout).dim
    assert dim.count() == before
    assert dim.where("cast(dw_start_date as string) like '1999%'").count() == 0


def test_json_fields_and_lines(spark, tmp_path):
    lines = [{"a": 15634602, "b": 1.5, "other": True}, {"a": 2.25}]
    (tmp_path / "x.json").write_text("\n".join(json.dumps(line) for line in lines))
    rows = read_json(spark, str(tmp_path), ["a", "b", "c"], multi_line=False).collect()
    assert sorted(map(tuple, rows)) == [("15634602", "1.5", None), ("2.25", None, None)]


def test_import_keeps_cells(spark, tmp_path):
    table = spark.createDataFrame([(1, " x ", None), (2, 'a,"b', "z")], "n int, s string, t string")
    import_table(table, ["n", "s", "t", "absent"], str(tmp_path / "landed"))
    rows = read_csv(spark, str(tmp_path / "landed"), ["n", "s", "t", "u"], header=False).collect()
    assert sorted(map(tuple, rows)) == [("1", " x ", None, None), ("2", 'a,"b', "z", None)]


def test_source_ids_are_unique(spark, layout):
    rows = read_bronze(spark, CUSTOMERS, layout.bronze(CUSTOMERS.name))
    assert rows.select("_source_id").distinct().count() == 4


def test_path_guards(spark, layout, tmp_path):
    require_inputs(spark, [layout.bronze(USAGE.name)])
    require_absent(spark, [str(tmp_path / "none")])
    with pytest.raises(FileNotFoundError, match="none"):
        require_inputs(spark, [str(tmp_path / "none")])


class FakeSession:
    """The part of a session that names the shared folder."""

    def __init__(self, master, **settings):
        self.sparkContext = self
        self.conf = settings
        self.master = master

    def getCheckpointDir(self):
        return None


def test_staging_uses_the_named_folder():
    named = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_dir(named) == "hdfs:///shared"
    stored = FakeSession("yarn", **{"spark.sql.warehouse.dir": "hdfs:///warehouse"})
    assert shared_dir(stored) == "hdfs:///warehouse"


def test_gold_from_empty_silver(spark):
    customers = spark.createDataFrame([], "CustomerId long, Exited int, NumOfProducts int")
    tickets = spark.createDataFrame(
        [], "ticket_id string, customer_id long, resolution_time_hrs double, created_at date"
    )
    offers = spark.createDataFrame(
        [], "offer_id string, customer_id long, accepted int, date_offered date"
    )
    usage = spark.createDataFrame(
        [], "usage_log_id string, customer_id long, usage_month string, monthly_balance double"
    )
    tables = build_gold(customers, tickets, offers, usage)
    assert (tables.dim.count(), tables.fact.count(), tables.mart.count()) == (0, 0, 0)
