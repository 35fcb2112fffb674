import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from churnlake.operators import dedupe, keys, skew
from churnlake.operators.rules import REASON


def test_surplus_copies_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "COPIES_PER_CHUNK", 10)
    counts = {"a": 1, "b": 2, "c": 10, "d": 11, "e": 12, "f": 137, None: 21}
    rows = [(name,) for name, count in counts.items() for _ in range(count)]
    df = spark.createDataFrame(rows, "x string").withColumn("id", F.monotonically_increasing_id())
    collapsed = dedupe.collapse_copies(df, ["x"], "id")
    surplus = dedupe.surplus_copies(collapsed, ["x"]).collect()
    assert Counter(row.x for row in surplus) == Counter(
        {name: count - 1 for name, count in counts.items() if count > 1}
    )
    assert {row[REASON] for row in surplus} == {dedupe.EXACT_DUPLICATE}


def test_collapse_keeps_the_first_arrival(spark):
    df = spark.createDataFrame([("a", 5), ("a", 3), ("b", 9)], "x string, id long")
    rows = dedupe.collapse_copies(df, ["x"], "id").collect()
    assert sorted((row.x, row.id, row[dedupe.COPIES]) for row in rows) == [
        ("a", 3, 2),
        ("b", 9, 1),
    ]


def test_key_duplicates_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(n, rng.choice(["k1", "k2", "k3"]), rng.random() < 0.3) for n in range(200)]
    df = spark.createDataFrame(rows, "id long, key string, bad boolean").withColumn(
        REASON, F.when(F.col("bad"), "bad")
    )
    marked = dedupe.mark_key_duplicates(df, "key", "id", "dup", F.col(REASON).isNull())
    got = {row.id: row[REASON] for row in marked.collect()}
    seen, expected = set(), {}
    for number, key, bad in rows:
        expected[number] = "bad" if bad else "dup" if key in seen else None
        if not bad:
            seen.add(key)
    assert got == expected


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_dense_key_is_the_row_number(spark, partitions):
    rng = random.Random(partitions)
    # Clustered ids, an outlier, and one leading value with a third of the rows.
    leading = [7] * 200 + [rng.randrange(1000) for _ in range(399)] + [10**15]
    rows = sorted({(number, rng.randrange(10**6)) for number in leading})
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "a long, b long").repartition(partitions)
    keyed = keys.dense_key(df, ["a", "b"], "k").collect()
    assert sorted((row.k, row.a, row.b) for row in keyed) == [
        (n, a, b) for n, (a, b) in enumerate(rows, start=1)
    ]


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.range(0), ["id"], "k").count() == 0


def test_dense_key_has_no_single_partition_sort_of_rows(spark):
    plan = keys.dense_key(spark.range(1000), ["id"], "k")
    text = plan._jdf.queryExecution().executedPlan().toString()
    # One exchange to a single partition: the offsets, a row per partition.
    assert text.count("SinglePartition") == 1
    assert "Window" in text


def test_spread_lookup_deals_out_hot_and_null_keys(spark):
    rows = [(n, 1) for n in range(300)] + [(300 + n, None) for n in range(200)]
    rows += [(500 + n, n % 50) for n in range(100)]
    df = spark.createDataFrame(rows, "id long, key long")
    lookup = spark.createDataFrame([(n, f"v{n}") for n in range(0, 40)], "key long, v string")
    hot = skew.hot_keys(df, "key", width=20)
    assert [tuple(row) for row in hot.collect()] == [(1, 16)]
    joined = skew.spread_lookup(df, lookup, "key", F.col("id"), hot)
    expected = {n: f"v{key}" if key is not None and key < 40 else None for n, key in rows}
    assert {row.id: row.v for row in joined.collect()} == expected
    assert joined.count() == len(rows)
    assert sorted(joined.columns) == ["id", "key", "v"]


def test_spread_lookup_balances_the_shuffle(spark):
    """With broadcasts off, the hot key's rows arrive in many partitions."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("key")
        )
        lookup = spark.range(20_000).select(F.col("id").alias("key"), F.lit(1).alias("v"))
        hot = skew.hot_keys(df, "key", width=200)
        joined = skew.spread_lookup(df, lookup, "key", F.col("id"), hot)
        sizes = [
            row["count"]
            for row in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
        assert sum(sizes) == 20_000
        assert max(sizes) < 2 * 20_000 / 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_every_hot_key_is_split(spark):
    """1,500 of 2,500 keys are hot, and none is left out."""
    df = spark.range(16_000).select(
        F.when(F.col("id") < 15_000, F.col("id") % 1500).otherwise(F.col("id")).alias("key")
    )
    hot = {row.key: row["_splits"] for row in skew.hot_keys(df, "key", width=3200).collect()}
    assert hot == dict.fromkeys(range(1500), 2)


def test_foreign_key_operators(spark):
    child = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, 9), (5, None)], "id long, k long")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    flagged = keys.flag_known_keys(child, "k", parent, F.col("id"), "known")
    assert {row.id: row.known for row in flagged.collect()} == {
        1: True,
        2: True,
        3: None,
        4: None,
        5: None,
    }
    assert {row.k for row in keys.orphan_keys(child, parent, "k").collect()} == {9, None}
    assert keys.orphan_row_count(child, parent, "k").first().orphan_rows == 3
    assert keys.orphan_row_count(parent, parent, "k").first().orphan_rows == 0
    assert {row.id for row in keys.keep_known_keys(child, "k", parent).collect()} == {1, 2}
    assert keys.key_reference(child, "k").count() == 3
