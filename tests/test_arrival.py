"""JSON arrays read in blocks, and arrival order."""

import json
import os
import random

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from silver_rows import AS_OF, GOOD

from churnlake.layout import Layout
from churnlake.plans.silver import clean_source, standardize
from churnlake.scratch import stage
from churnlake.sources.arrival import SOURCE_ID, number_arrivals
from churnlake.sources.json_array import array_records, read_json_array
from churnlake.sources.readers import read_bronze, read_csv, with_source_id
from churnlake.sources.specs import OFFERS, USAGE
from pyspark.sql import functions as F

TRICKY = ["}{", '"]}', "\\", '\\"}', "a\nb", "[[{", "é}日", "", "}}}}", '\\\\}"', "\\\\"]


@pytest.fixture
def blocks(spark):
    """Sets the size of file blocks; puts it back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def cut(size, cores=8):
        for name in names:
            spark.conf.set(name, str(size))
        # What a scan takes for the number of cores.
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(cores))

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def records(size, seed=1):
    rng = random.Random(seed)
    return [
        {
            "a": n,
            "b": "".join(rng.choices(TRICKY, k=4)),
            "c": {"x": [{"y": rng.choice(TRICKY)}]} if n % 3 == 0 else None,
        }
        for n in range(size)
    ]


@pytest.mark.parametrize("size", [37, 700, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_an_array_is_the_same_whatever_its_blocks(spark, blocks, tmp_path, size, indent):
    expected = records(120 if size < 100 else 400)
    half = len(expected) // 2
    for name, part, age in (("later", expected[half:], 2000), ("first", expected[:half], 1000)):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(part, indent=indent, ensure_ascii=indent is None))
        os.utime(path, (age, age))
    (tmp_path / "empty.json").write_text(" [\n ] ")
    blocks(size)
    stored = stage(read_json_array(spark, str(tmp_path), ["a", "b", "c", "none"]), "array")
    rows = number_arrivals(stored).orderBy(SOURCE_ID).collect()
    assert [row[SOURCE_ID] for row in rows] == list(range(1, len(expected) + 1))
    assert [(row.a, row.b) for row in rows] == [(str(r["a"]), r["b"]) for r in expected]
    assert [json.loads(row.c) if row.c else None for row in rows] == [r["c"] for r in expected]
    assert all(row.none is None for row in rows)


def test_blocks_of_one_file_are_read_by_several_tasks(spark, blocks, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(records(3000)))
    blocks(20_000)
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() >= 5
    assert array_records(spark, str(tmp_path)).count() == 3000


@pytest.mark.parametrize(
    "text",
    ['[{"a": 1}', '[{"a": "x}]', '{"a": 1}\n{"a": 2}', '[{"a": 1}]]', '{"a": [1, 2]}', '[{"a": {"b": 1}'],
)
def test_what_is_no_whole_array_is_refused(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ValueError, match="x.json"):
        read_json_array(spark, str(tmp_path), ["a"])


@pytest.mark.parametrize("text", ['[1, {"a": 1}]', '[{"a" 1}]', '["x", {"a": 1}]', '[[{"a": 1}], {"a": 2}]'])
def test_elements_that_are_no_objects_stop_the_job(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises((PySparkException, Py4JError)):
        read_json_array(spark, str(tmp_path), ["a"]).collect()


def test_the_surviving_duplicate_does_not_depend_on_blocks(spark, blocks, tmp_path):
    """Offers with one key all over three files; the oldest file's first row stays."""
    folder = Layout(str(tmp_path)).bronze(OFFERS.name)
    os.makedirs(folder)
    for number, age in ((0, 3000), (1, 1000), (2, 2000)):
        with open(f"{folder}/part{number}.csv", "w") as file:
            file.write(",".join(OFFERS.columns) + "\n")
            for n in range(400):
                row = GOOD[OFFERS.name] | {"offer_id": f"O{n % 50}", "customer_id": f"{number}{n:04d}"}
                file.write(",".join(f'"{row[name]}"' for name in OFFERS.columns) + "\n")
        os.utime(f"{folder}/part{number}.csv", (age, age))
    found, splits = [], []
    for size, cores in ((300, 2), (5000, 8), (1 << 20, 3), (1 << 20, 40)):
        blocks(size, cores)
        raw = read_bronze(spark, OFFERS, folder)
        splits.append(raw.rdd.getNumPartitions())
        stored = number_arrivals(stage(standardize(raw, OFFERS), "offers"))
        assert [row[0] for row in stored.select(SOURCE_ID).orderBy(SOURCE_ID).collect()] == list(range(1, 1201))
        clean = clean_source(stored, OFFERS, F.to_date(F.lit(AS_OF))).clean
        found.append(sorted((row.offer_id, row.customer_id) for row in clean.collect()))
    assert len(set(splits)) >= 3
    assert all(one == found[0] for one in found)
    assert dict(found[0]) == {f"O{n}": 10000 + n for n in range(50)}


def test_lines_and_arrays_give_the_same_rows(spark, tmp_path):
    rows = [GOOD[USAGE.name] | {"usage_log_id": f"U{n}"} for n in range(20)]
    for name, text in (("lines", "\n".join(map(json.dumps, rows))), ("array", json.dumps(rows))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text(text)
    both = [
        number_arrivals(stage(read_bronze(spark, USAGE, f"{tmp_path}/{name}", name == "array"), name))
        .orderBy(SOURCE_ID)
        .collect()
        for name in ("lines", "array")
    ]
    assert both[0] == both[1] and len(both[0]) == 20


def test_no_files_no_numbers(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    raw = with_source_id(read_csv(spark, str(tmp_path), ["x"], header=False))
    assert number_arrivals(stage(raw, "empty")).count() == 0
