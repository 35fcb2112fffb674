import random

import pytest
from pyspark.sql import functions as F

from churnlake.plans import features, model
from churnlake.plans.features import FEATURES, LABEL


@pytest.fixture(scope="module")
def customers(spark):
    """Churn follows CLV_LTV and total_usage_events; the rest is noise."""
    rng = random.Random(3)
    rows = []
    for number in range(400):
        churned = int(rng.random() < 0.3)
        values = {name: rng.random() for name in FEATURES}
        values["CLV_LTV"] = rng.gauss(100 - 80 * churned, 15)
        values["total_usage_events"] = rng.gauss(20 - 12 * churned, 4)
        rows.append((number, churned, *[float(values[name]) for name in FEATURES]))
    schema = f"customer_id long, {LABEL} int, " + ", ".join(f"{name} double" for name in FEATURES)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def split(customers):
    parts = features.stratified_split(customers).persist()
    return parts.where("split = 'train'"), parts.where("split = 'test'")


def test_split_is_stratified_and_stable(customers, split):
    train, test = split
    assert train.count() + test.count() == 400
    whole, held = features.class_counts(customers), features.class_counts(test)
    assert held == {value: round(count * 0.2) for value, count in whole.items()}
    again = features.stratified_split(customers.repartition(5)).where("split = 'test'")
    assert {row.customer_id for row in again.collect()} == {
        row.customer_id for row in test.collect()
    }
    other = features.stratified_split(customers, seed=7).where("split = 'test'")
    assert {row.customer_id for row in other.collect()} != {
        row.customer_id for row in test.collect()
    }


def test_weights_balance_the_classes(customers):
    weighted = model.with_class_weights(customers).groupBy(LABEL).agg(F.sum("weight").alias("w"))
    assert [row.w for row in weighted.collect()] == pytest.approx([200.0, 200.0])


def test_label_with_many_values_is_refused(spark):
    df = spark.range(200).withColumnRenamed("id", LABEL)
    with pytest.raises(ValueError, match="more than 100"):
        features.class_counts(df)


def test_train_select_score_and_reload(split, tmp_path):
    train, test = split
    chosen = model.select_features(train, keep=2, trees=20, depth=4)
    assert set(chosen.features) == {"CLV_LTV", "total_usage_events"}
    ranked = model.importances(chosen.baseline)
    assert len(ranked) == 16
    assert sum(weight for _, weight in ranked) == pytest.approx(1.0)
    quality = model.evaluate(chosen.final, test)
    assert quality["accuracy"] > 0.85
    assert quality["roc_auc"] > 0.9
    model.save_model(chosen.final, str(tmp_path / "final"))
    loaded = model.load_model(str(tmp_path / "final"))
    scored = model.ranked_by_risk(model.predict(loaded, test)).collect()
    assert scored == model.ranked_by_risk(model.score(chosen.final, test)).collect()
    probabilities = [row.churn_probability for row in scored]
    assert probabilities == sorted(probabilities, reverse=True)
    for row in scored:
        assert (row.prediction_label == "Likely to churn") == (row.predicted_churn == 1)


def test_predictions_of_joined_rows_are_made_in_many_tasks(spark, split):
    train, test = split
    fitted = model.train(train, ("CLV_LTV", "num_products"), trees=5, depth=3)
    ids = spark.range(100_000).withColumnRenamed("id", "customer_id")
    # As many tasks as scored rows are as many files; the join is by a shuffle of its own,
    # small enough to be merged.
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = ids.join(test.drop("split"), "customer_id", "left")
        predictions = model.predict(fitted, joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert len(predictions.inputFiles()) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert predictions.count() == predictions.select("customer_id").distinct().count() == 100_000


def test_training_needs_no_activity(split):
    train, test = split
    unknown = test.withColumn("CLV_LTV", F.lit(None).cast("double"))
    fitted = model.train(train, ("CLV_LTV", "num_products"), trees=5, depth=3)
    assert model.score(fitted, unknown).count() == test.count()


def test_class_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame(
        [(0, 0), (0, 0), (1, 0), (2, 2)], "actual_churn int, predicted_churn int"
    )
    rows = {row["class"]: row for row in model.class_report(df).collect()}
    assert (rows[0].precision, rows[0].recall, rows[0].support) == (
        pytest.approx(2 / 3),
        1.0,
        2,
    )
    assert (rows[1].precision, rows[1].recall, rows[1].f1) == (0.0, 0.0, 0.0)
    assert rows[2].f1 == 1.0
    assert model.accuracy(df).first().accuracy == 0.75
    assert model.confusion_matrix(df).count() == 3


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame(
        [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "actual_churn int, churn_probability double"
    )
    assert model.roc_auc(df) == pytest.approx(0.875)


def test_feature_table_of_an_inactive_customer(spark):
    dim = spark.createDataFrame(
        [(1, 0, 5.0, 1.0, 2), (2, 1, 0.0, 0.0, 1)],
        "customer_id long, is_churned int, CLV_LTV double, avg_ticket_res_time_hrs double, "
        "num_products int",
    )
    fact = spark.createDataFrame(
        [(1, "2025-02", 3, 9.0, 9.0, 0, 0.0, 0, 0, 0.0), (1, "2025-01", 1, 1.0, 1.0, 4, 2.0, 2, 1, 0.5)],
        "customer_id long, activity_month string, usage_events long, total_balance double, "
        "avg_balance double, ticket_count long, avg_resolution_time double, offer_count long, "
        "accepted_offers long, acceptance_rate double",
    )
    table = features.customer_features(dim, fact)
    rows = {row.customer_id: row for row in table.collect()}
    assert (rows[1].last_usage_events, rows[1].last_total_balance, rows[1].last_ticket_count) == (
        3,
        9.0,
        0,
    )
    assert (rows[1].months_active, rows[1].total_usage_events, rows[1].avg_usage_events) == (2, 4, 2.0)
    assert rows[2].months_active is None
    assert features.missing_values(table).first().missing_values == 13
    assert model.complete(table).where("customer_id = 2").first().months_active == 0
    shares = {row.is_churned: row.share for row in features.class_balance(table).collect()}
    assert shares == {0: 0.5, 1: 0.5}


def test_forest_does_not_depend_on_the_shuffle_width(spark, split):
    training, test = split
    width = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for partitions in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            fitted = model.train(training, trees=10, depth=4)
            scored = model.score(fitted, test).orderBy("customer_id").collect()
            seen.append((fitted.stages[-1].featureImportances.toArray().tolist(), scored))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    assert seen[0][0] == pytest.approx(seen[1][0])
    assert [row.predicted_churn for row in seen[0][1]] == [
        row.predicted_churn for row in seen[1][1]
    ]
