"""Rollups that are merged, a fact by month, and a model as a table."""

import random

import pytest
from pyspark.sql import functions as F

from churnlake.layout import Layout
from churnlake.plans import forest, gold, increment, model
from churnlake.plans.features import FEATURES
from churnlake.publish import current, publish, read_parts

SCHEMAS = (
    "usage_log_id string, customer_id long, usage_month string, monthly_balance double",
    "ticket_id string, customer_id long, resolution_time_hrs double, created_at string",
    "offer_id string, customer_id long, accepted int, date_offered string",
)


def rows(seed, size, months=("2024-01", "2024-02", "2024-03")):
    rng = random.Random(seed)

    def one(kind, n):
        customer = rng.choice([1, 2, 3, 4, 5, 6, None]) if rng.random() < 0.9 else 99
        month = rng.choice(months)
        if kind == 0:
            return (f"U{n}", customer, rng.choice([month, None]), rng.choice([None, 1.5, 100.25]))
        if kind == 1:
            return (f"T{n}", customer, rng.choice([None, 3.0, 20.5]), f"{month}-05")
        return (f"O{n}", customer, rng.choice([None, 0, 1]), f"{month}-07")

    return [[one(kind, f"{seed}-{n}") for n in range(size)] for kind in range(3)]


def frames(spark, data):
    tickets_date = "to_date(created_at) AS created_at"
    offers_date = "to_date(date_offered) AS date_offered"
    usage, tickets, offers = (
        spark.createDataFrame(part, schema) for part, schema in zip(data, SCHEMAS, strict=True)
    )
    return [
        usage,
        tickets.selectExpr("ticket_id", "customer_id", "resolution_time_hrs", tickets_date),
        offers.selectExpr("offer_id", "customer_id", "accepted", offers_date),
    ]


def content(rollup):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rollup.collect()),
        key=str,
    )


def split(data, keep):
    return [[row for n, row in enumerate(part) if keep(n)] for part in data]


def test_merged_rollups_equal_one_from_all_rows(spark):
    data = rows(1, 60)
    first, gone, came = (split(data, lambda n, k=k: n % 3 == k) for k in range(3))
    both = [a + b for a, b in zip(first, gone, strict=True)]
    state = gold.activity_rollup(*frames(spark, both))
    merged = increment.update_rollup(state, frames(spark, came), frames(spark, gone))
    expected = gold.activity_rollup(*frames(spark, [a + b for a, b in zip(first, came, strict=True)]))
    assert content(merged.select(*expected.columns)) == content(expected)
    nothing = increment.update_rollup(state, frames(spark, [[], [], []]), frames(spark, both))
    assert nothing.count() == 0


def test_only_changed_months_are_built_and_keys_stay(spark, tmp_path):
    folder, data = f"{tmp_path}/fact", rows(2, 80)
    dim = spark.createDataFrame([(n, n + 10) for n in range(1, 7)], "customer_id long, cust_key long")
    early, late = (split(data, lambda n, k=k: (n % 5 == 0) == k) for k in (False, True))
    late = [[row for row in part if "2024-02" in str(row)] for part in late]
    rollup = gold.activity_rollup(*frames(spark, early))
    first = increment.store_fact(spark, folder, rollup, dim)
    before = {(r.customer_id, r.activity_month): r.activity_key for r in read_parts(spark, first).collect()}
    assert sorted(before.values()) == list(range(1, len(before) + 1))
    # A customer's February goes altogether, and a new month comes.
    lost = [[row for row in part if row[1] == 2 and "2024-02" in str(row)] for part in early]
    new = [("U-new", 3, "2024-04", 5.0)], [], []
    added = frames(spark, [a + b for a, b in zip(late, new, strict=True)])
    removed = frames(spark, lost)
    months = increment.changed_months(added, removed)
    assert months == ["2024-02", "2024-04"]
    after = increment.update_rollup(rollup, added, removed)
    second = increment.update_fact(spark, folder, after, dim, months)
    assert {n for n in second.tables if second.tables[n] != first.tables.get(n)} == set(months)
    fact = read_parts(spark, second)
    whole = [
        [row for row in part if row not in gone] + came
        for part, gone, came in zip(early, lost, [a + b for a, b in zip(late, new, strict=True)], strict=True)
    ]
    expected = gold.build_keyed_fact(
        gold.activity_rollup(*frames(spark, whole)), dim.withColumn("is_churned", F.lit(0))
    ).drop("is_churned", "activity_key")
    assert content(fact.select(*expected.columns)) == content(expected)
    keys = {(r.customer_id, r.activity_month): r.activity_key for r in fact.collect()}
    assert len(set(keys.values())) == len(keys)
    assert all(keys[pair] == key for pair, key in before.items() if pair in keys)
    if len(keys) >= len(before):
        assert sorted(keys.values()) == list(range(1, len(keys) + 1))
    # Who reads the set before still can.
    assert read_parts(spark, first).count() == len(before)
    # A month that loses all its rows has no part any more.
    only = [[row for row in part if "2024-04" in str(row)] for part in whole]
    emptied = increment.update_rollup(after, frames(spark, [[], [], []]), frames(spark, only))
    third = increment.update_fact(spark, folder, emptied, dim, ["2024-04"])
    assert "2024-04" not in third.tables and read_parts(spark, third).count() == len(keys) - 1


def test_a_fact_must_be_there_to_be_updated(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        increment.update_fact(spark, f"{tmp_path}/none", None, None, [])


def customers(spark, size=300):
    columns = [(F.rand(n) * 10).alias(name) for n, name in enumerate(FEATURES)]
    label = (F.col("id") % 3 == 0).cast("int").alias("is_churned")
    return spark.range(size).select(F.col("id").alias("customer_id"), label, *columns)


def test_nodes_predict_what_the_model_does(spark, tmp_path):
    features = customers(spark)
    trained = model.train(features, trees=7, depth=5)
    path = f"{tmp_path}/model"
    model.save_model(trained, path)
    loaded = model.load_model(path)
    nodes = forest.forest_nodes(spark, path, loaded)
    assert nodes.select("tree").distinct().count() == 7
    # Scoring also takes NULLs and single nodes.
    asked = features.withColumn(FEATURES[0], F.when(F.col("customer_id") % 7 != 0, F.col(FEATURES[0])))
    found = forest.score_with_nodes(asked, nodes, forest.scaled_inputs(loaded), 5)
    own = model.score(loaded, asked)
    assert found.columns == own.columns
    both = found.join(own.select("customer_id", F.col("churn_probability").alias("p"), F.col("predicted_churn").alias("c")), "customer_id")
    assert both.count() == 300
    assert both.where("abs(churn_probability - p) > 1e-9 or predicted_churn != c").count() == 0
    stump = model.train(features.withColumn("is_churned", F.lit(1)).limit(20), trees=1)
    model.save_model(stump, path)
    only = forest.forest_nodes(spark, path, stump)
    assert only.count() == 1


def test_a_forest_of_too_many_nodes_is_refused(spark, monkeypatch):
    monkeypatch.setattr(forest, "MAX_NODES", 2)
    nodes = spark.createDataFrame([(0, n, None, None, None, None, 0.5) for n in range(3)], forest.NODE_SCHEMA)
    with pytest.raises(ValueError, match="more than 2 nodes"):
        forest.score_with_nodes(customers(spark, 1), nodes, [], 1)


def test_train_and_score_are_jobs(spark, tmp_path):
    layout = Layout(str(tmp_path))
    dim = spark.range(200).selectExpr(
        "id + 1 AS cust_key", "id AS customer_id", "int(id % 4 = 0) AS is_churned",
        "double(id % 4) AS CLV_LTV", "1.0D AS avg_ticket_res_time_hrs", "int(id % 3) AS num_products",
    )
    measures = ", ".join(f"double(id % 5) AS {name}" for name in gold.FACT_COLUMNS[2:10])
    fact = spark.sql(f"SELECT id AS customer_id, '2024-01' AS activity_month, {measures}, id + 1 AS cust_key, id + 1 AS activity_key FROM range(200)")
    mart = spark.createDataFrame([("2024-01", 200, 50, 0.25)], "activity_month string, active_customers long, churned_customers long, churn_rate double")
    with pytest.raises(FileNotFoundError, match="train first"):
        forest.run_score(spark, layout)
    publish(spark, layout.gold_set, dict(zip(gold.TABLES, (dim, fact, mart), strict=True)))
    first = forest.run_train(spark, layout, trees=10)
    scored = forest.run_score(spark, layout)
    assert scored.count() == 200
    assert scored.where("predicted_churn = actual_churn").count() > 190
    # Nothing new: the model and the predictions stay.
    assert forest.run_train(spark, layout, trees=10) == first
    before = current(spark, layout.score_set)
    forest.run_score(spark, layout)
    assert current(spark, layout.score_set) == before
