"""Customers are scored in batches, each of which gets the trees once."""

from churnlake.plans import forest
from churnlake.plans.features import FEATURES, LABEL
from pyspark.sql import functions as F

# Two trees over two features: a root with two leaves, and a lone leaf.
NODES = [
    (0, 0, "CLV_LTV", 1.5, 1, 2, 0.5),
    (0, 1, None, None, None, None, 0.25),
    (0, 2, None, None, None, None, 0.75),
    (1, 0, None, None, None, None, 0.5),
]


def scored(spark, size):
    customers = spark.range(size).select(
        F.col("id").alias("customer_id"),
        F.lit(1).alias(LABEL),
        *[(F.col("id") % 4).cast("double").alias(name) for name in FEATURES[:2]],
    )
    nodes = spark.createDataFrame(NODES, forest.NODE_SCHEMA)
    return forest.score_with_nodes(customers, nodes, [(name, 0.0, 1.0) for name in FEATURES[:2]], 8)


def test_leaves_hold_a_walk_and_every_customer_is_scored_once(spark):
    rows = scored(spark, 500).collect()
    assert sorted(row.customer_id for row in rows) == list(range(500))
    for row in rows:
        right = row.customer_id % 4 >= 2
        assert row.churn_probability == (0.625 if right else 0.375)
        assert row.predicted_churn == int(right) and row.actual_churn == 1


def test_the_trees_are_joined_to_batches_not_to_customers(spark):
    plan = scored(spark, 50)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode") < plan.index("Join") < plan.index("collect_list(struct(customer_id")
