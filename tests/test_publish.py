"""Sets of tables that change together, jobs that go on, files that land again."""

import os

import pytest
from pyspark.sql import functions as F
from silver_rows import AS_OF
from test_jobs import layout  # noqa: F401

from churnlake import publish as publishing
from churnlake.plans import gold, silver
from churnlake.publish import PublishConflict, current, publish, step
from churnlake.sources.specs import OFFERS, TICKETS
from churnlake.streaming.landing import land_changes, landed_versions, manifest


def seen(spark, folder):
    commit = current(spark, folder)
    return {name: sorted(r[0] for r in commit.read(spark, name).collect()) for name in commit.tables}


def numbers(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "n int")


def test_all_tables_or_none(spark, tmp_path):
    folder = f"{tmp_path}/set"
    assert current(spark, folder) is None
    publish(spark, folder, {"a": numbers(spark, 1), "b": numbers(spark, 2)})
    assert seen(spark, folder) == {"a": [1], "b": [2]}
    broken = numbers(spark, 4).select(F.raise_error(F.lit("stopped")).cast("int").alias("n"))
    with pytest.raises(Exception, match="stopped"):
        publish(spark, folder, {"a": numbers(spark, 3), "b": broken})
    assert seen(spark, folder) == {"a": [1], "b": [2]}

    def refuse(stored):
        assert stored["a"].count() == 1
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        publish(spark, folder, {"a": numbers(spark, 3), "b": numbers(spark, 4)}, check=refuse)
    assert seen(spark, folder) == {"a": [1], "b": [2]}
    publish(spark, folder, {"a": numbers(spark, 3), "b": numbers(spark, 4)})
    assert seen(spark, folder) == {"a": [3], "b": [4]}


def test_old_sets_and_what_failed_are_deleted(spark, tmp_path):
    folder = f"{tmp_path}/set"
    for value in range(4):
        publish(spark, folder, {"a": numbers(spark, value)}, keep=2)
        # Who reads the set before can go on.
        if value:
            assert before.read(spark, "a").collect()[0][0] == value - 1  # noqa: F821
        before = current(spark, folder)
    assert len(os.listdir(f"{folder}/_versions")) == 2
    with pytest.raises(Exception, match="stopped"):
        publish(spark, folder, {"a": numbers(spark, 1).select(F.raise_error(F.lit("stopped")).alias("n"))})
    publish(spark, folder, {"a": numbers(spark, 9)}, keep=1)
    assert len(os.listdir(f"{folder}/_versions")) == 1
    assert seen(spark, folder) == {"a": [9]}


def test_two_jobs_do_not_publish_one_number(spark, tmp_path):
    folder = f"{tmp_path}/set"

    def other(stored):
        publish(spark, folder, {"a": numbers(spark, 7)})

    with pytest.raises(PublishConflict):
        publish(spark, folder, {"a": numbers(spark, 1)}, check=other)
    assert seen(spark, folder) == {"a": [7]}


def test_a_step_runs_once_for_its_inputs(spark, tmp_path):
    folder, calls = f"{tmp_path}/set", []

    def build():
        calls.append(1)
        return {"a": numbers(spark, len(calls))}

    for inputs, done in (("x", True), ("x", False), ("y", True), ("y", False)):
        commit, now = step(spark, folder, inputs, build)
        assert now == done
    assert len(calls) == 2 and commit.number == 2 and seen(spark, folder) == {"a": [2]}


def test_a_killed_run_goes_on_where_it_stopped(spark, layout, monkeypatch):  # noqa: F811
    as_of = F.to_date(F.lit(AS_OF))
    cleaned, clean_source = [], silver.clean_source

    def counting(standardized, spec, *rest):
        cleaned.append(spec.name)
        if spec is OFFERS and cleaned.count(spec.name) == 1:
            raise KeyboardInterrupt
        return clean_source(standardized, spec, *rest)

    monkeypatch.setattr(silver, "clean_source", counting)
    with pytest.raises(KeyboardInterrupt):
        silver.run_silver(spark, layout, as_of)
    assert cleaned == ["customers", TICKETS.name, OFFERS.name]
    assert current(spark, layout.silver_set(OFFERS.name)) is None
    status = silver.run_silver(spark, layout, as_of)
    assert set(status.values()) == {"SUCCESS"}
    assert cleaned[3:] == [OFFERS.name, "usage"]
    gold.run_gold(spark, layout)
    first = current(spark, layout.gold_set)
    # Nothing new: nothing is done.
    silver.run_silver(spark, layout, as_of)
    gold.run_gold(spark, layout, replace=True)
    assert len(cleaned) == 5 and current(spark, layout.gold_set) == first
    # A late file: its source is done again, and gold; the others stay.
    path = f"{layout.bronze(OFFERS.name)}/part.csv"
    with open(path) as file:
        lines = file.readlines()
    with open(f"{layout.bronze(OFFERS.name)}/late.csv", "w") as file:
        file.write("".join([lines[0], lines[1].replace("O1", "O9")]))
    silver.run_silver(spark, layout, as_of)
    assert cleaned[5:] == [OFFERS.name]
    gold.run_gold(spark, layout, replace=True)
    assert current(spark, layout.gold_set).number == first.number + 1


def test_rows_that_do_not_reconcile_are_not_published(spark, layout, monkeypatch):  # noqa: F811
    as_of = F.to_date(F.lit(AS_OF))
    assert set(silver.run_silver(spark, layout, as_of).values()) == {"SUCCESS"}
    before = current(spark, layout.silver_set("customers"))
    clean_source = silver.clean_source

    def losing(*arguments):
        found = clean_source(*arguments)
        return silver.Silver(found.clean.limit(1), found.rejected)

    monkeypatch.setattr(silver, "clean_source", losing)
    later = F.to_date(F.lit("2030-01-01"))
    assert "unaccounted" in silver.run_silver(spark, layout, later)["customers"]
    assert current(spark, layout.silver_set("customers")) == before


SCHEMA = "a string, b string"


def drop(tmp_path, name, text, age):
    path = tmp_path / "drop" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (age, age))


def landed(spark, tmp_path):
    rows = landed_versions(spark, f"{tmp_path}/bronze", SCHEMA)
    return sorted((row.a, row.b) for row in rows.collect())


def test_a_path_dropped_again_replaces_its_rows(spark, tmp_path):
    def run(**options):
        return land_changes(
            spark, f"{tmp_path}/drop", "*.csv", "csv", SCHEMA, f"{tmp_path}/bronze", **options
        )

    drop(tmp_path, "other.txt", "9,9\n", 900)
    (tmp_path / "drop" / "x").mkdir()
    assert run() == 0 and landed(spark, tmp_path) == []
    for number in range(12):
        drop(tmp_path, f"deep/{number % 2}/f{number}.csv", f"{number},x\n{number},y\n", 1000 + number)
    drop(tmp_path, "odd [1] {a}*.csv", "odd,z\n", 3000)
    whole = sorted([(str(n), c) for n in range(12) for c in "xy"] + [("odd", "z")])

    def fail(batch):
        raise RuntimeError("between rows and record")

    with pytest.raises(RuntimeError, match="between"):
        run(before_record=fail)
    assert manifest(spark, f"{tmp_path}/bronze").count() == 0
    assert run() == 2 and landed(spark, tmp_path) == whole
    assert run() == 0 and landed(spark, tmp_path) == whole
    counts = manifest(spark, f"{tmp_path}/bronze").groupBy("batch").count().orderBy("batch").collect()
    assert [tuple(row) for row in counts] == [(1, 10), (2, 3)]
    # Other rows, none at all, a file that is being written and one that went away.
    drop(tmp_path, "deep/0/f0.csv", "new,1\n", 5000)
    drop(tmp_path, "deep/1/f1.csv", "\n", 5001)
    drop(tmp_path, "deep/1/f3.csv", "", 5002)
    os.remove(tmp_path / "drop" / "deep/0/f2.csv")
    assert run() == 1
    expected = sorted([pair for pair in whole if pair[0] not in ("0", "1")] + [("new", "1")])
    assert landed(spark, tmp_path) == expected
    assert run() == 0
    assert publishing.small_files(spark, str(tmp_path)).names(f"{tmp_path}/nowhere") == []
