"""Files written as a source would drop them, and how they are cut."""

import json

from churnlake.sources.arrival import number_arrivals
from churnlake.sources.json_array import read_json_array
from churnlake.scratch import stage
from churnlake.workload import dropped, raw
from pyspark.sql import functions as F


def usage(spark, size):
    return spark.range(size).select(
        F.col("id").alias("at"), F.concat(F.lit("]},{\n"), F.col("id")).alias("note")
    )


def test_no_file_of_arrays_holds_more_rows_than_a_task_should_write(spark, tmp_path):
    path = str(tmp_path / "array")
    dropped.write_array(usage(spark, 1000), "at", path, rows_per_file=100)
    dropped.set_age(spark, path)
    files = sorted(tmp_path.glob("array/*/part-*"))
    sizes = [len(json.loads(file.read_text())) for file in files]
    assert len(files) == 10 and sum(sizes) == 1000 and max(sizes) <= 130
    read = number_arrivals(stage(read_json_array(spark, path, ["note"]), "dropped-array"))
    notes = [row.note for row in read.orderBy("_source_id").collect()]
    assert notes == [f"]}},{{\n{number}" for number in range(1000)]


def test_few_rows_are_one_file_of_one_array(spark, tmp_path):
    path = str(tmp_path / "array")
    twice = usage(spark, 10).union(usage(spark, 10))
    dropped.write_array(twice, "at", path)
    (file,) = tmp_path.glob("array/*/part-*")
    assert len(json.loads(file.read_text())) == 20


def test_files_and_blocks_grow_with_the_rows(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(n, f"c{n}", n % 25, 1.0) for n in range(60)],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double",
    ).write.parquet(str(tmp_path / "customer.parquet"))
    rows = dropped.in_arrival_order(spark, str(tmp_path), dropped.CUSTOMERS)
    assert rows.rdd.getNumPartitions() == 5
    monkeypatch.setattr(dropped.file_count, "__defaults__", (4,))
    rows = dropped.in_arrival_order(spark, str(tmp_path), dropped.CUSTOMERS)
    assert rows.rdd.getNumPartitions() > 10
    (tmp_path / "large").mkdir()
    (tmp_path / "large" / "file").write_bytes(b"x" * (1 << 20))
    assert dropped.block_size(spark, str(tmp_path / "large"), 1 << 10) == (1 << 20) // 256
    assert dropped.block_size(spark, str(tmp_path / "large"), 64 << 10) == 64 << 10

def test_customers_are_dealt_out_over_all_tasks(spark, tmp_path):
    spark.createDataFrame([(n, f"c{n}", n % 25, 1.0) for n in range(60)],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double",
    ).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    assert raw.raw_customers(spark, str(tmp_path)).rdd.getNumPartitions() == 8
