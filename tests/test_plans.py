"""The plans are the ones wanted, not only the results."""

import contextlib
import io
import re

import pytest

from churnlake.plans.silver import standardize
from churnlake.scratch import stage
from churnlake.sources.readers import SOURCE_ID
from churnlake.sources.specs import SOURCES
from churnlake.workload import lake
from churnlake.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

# HotSpot leaves longer methods to the interpreter.
COMPILED_METHOD = 8000


def explained(df, mode):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("spec", SOURCES, ids=lambda spec: spec.name)
def test_parsers_fit_in_a_compiled_method(spark, spec):
    schema = ", ".join(f"{name} string" for name in spec.columns) + f", {SOURCE_ID} long"
    raw = stage(spark.createDataFrame([], schema), "raw")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", explained(standardize(raw, spec), "codegen"))
    assert sizes
    assert max(int(size) for size in sizes) < COMPILED_METHOD


def test_dimension_queries_read_only_their_columns(spark):
    plan = explained(QUERIES["bi_q02"](spark, SF_DIR), "formatted")
    assert "ReadSchema: struct<is_churned:int,CLV_LTV:double>" in plan


def test_retention_filter_reaches_the_scan(spark):
    plan = explained(QUERIES["bi_q12"](spark, SF_DIR), "formatted")
    assert "EqualTo(is_churned,0), GreaterThanOrEqual(CLV_LTV,1000.0)" in plan
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("bi_", "gold_"))))
def test_no_nested_loops_or_row_level_single_partitions(spark, name):
    plan = explained(QUERIES[name](spark, SF_DIR), "simple")
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # Only offsets of a dense key and finished totals may meet in one partition.
    for window in re.findall(r"Window \[.*", plan):
        assert "_offset" in window or "_rows" in window, window


def test_copies_combine_before_the_shuffle(spark):
    plan = explained(QUERIES["dedupe_exact"](spark, SF_DIR), "simple")
    assert plan.count("HashAggregate") >= 2
    assert "SortAggregate" not in plan
    assert "Window" not in plan


def test_first_of_key_join_is_not_on_the_key_alone(spark):
    ids = lake.customer_ids(spark, SF_DIR)
    assert ids.columns == ["CustomerId"]
    plan = explained(QUERIES["dedupe_key"](spark, SF_DIR), "simple")
    joins = re.findall(r"Join \[([^\]]*)\]", plan)
    assert joins
    assert all(SOURCE_ID in keys for keys in joins)


def test_hot_keys_are_not_capped(spark):
    plan = explained(QUERIES["fk_check"](spark, SF_DIR), "simple")
    assert "Limit" not in plan
    assert "TakeOrdered" not in plan


def test_customers_are_joined_after_the_top_ten(spark):
    plan = explained(QUERIES["bi_q05"](spark, SF_DIR), "simple")
    assert plan.index("Join") < plan.rindex("TakeOrderedAndProject(limit=10")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("bucketed_")))
def test_tables_by_customer_are_joined_without_shuffles(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    QUERIES[name](spark, SF_DIR).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = explained(QUERIES[name](spark, SF_DIR), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plan
    join = plan.splitlines()
    at = next(n for n, line in enumerate(join) if "Join" in line)
    below = [line for line in join[at + 1 :] if "Exchange" in line]
    if name == "bucketed_q05":
        # Ten rows are dealt out to the buckets of the dimension; the fact stays.
        assert len(below) <= 1 and not any("partial_sum" in line for line in below)
    else:
        assert below == [], plan
