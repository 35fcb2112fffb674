"""A forest as a table: its nodes as rows, its predictions in SQL functions.

A saved model can only be read by the library that wrote it. As a table (tree,
node, feature, threshold, children, probability) it can be queried, compared with
the next one and scored by anything that runs SQL. Scoring walks all trees of a row
in one expression: a tree is arrays over its nodes, and each step looks up the node
it is at and goes to one of its children. Customers are dealt out once, in batches
that meet the trees together; no row is multiplied.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.layout import Layout
from churnlake.plans.features import LABEL, customer_features, stratified_split
from churnlake.plans.gold import read_gold
from churnlake.plans.model import DEPTH, complete, save_model, select_features
from churnlake.publish import Commit, current, step
from churnlake.scratch import stage

NODE_SCHEMA = (
    "tree int, node int, feature string, threshold double, left int, right int, probability double"
)

# Batches of customers a task of the shuffle scores. A row that is joined to the trees
# gets a copy of them all, so that is done once a batch.
BATCHES = 16

# A forest of more nodes is not sent to every task.
MAX_NODES = 1 << 20


def scaled_inputs(model: PipelineModel) -> list[tuple[str, float, float]]:
    """(feature, shift, factor) as the model's scaler applies them."""
    assembler, scaler = model.stages[:2]
    pairs = zip(scaler.mean.tolist(), scaler.std.tolist(), strict=True)
    return [
        (name, mean, 1 / deviation if deviation != 0 else 0.0)
        for name, (mean, deviation) in zip(assembler.getInputCols(), pairs, strict=True)
    ]


def forest_nodes(spark: SparkSession, path: str, model: PipelineModel) -> DataFrame:
    """The nodes of the forest that ``save_model`` stored at ``path``.

    A leaf has no feature; its probability is the share of class 1 among the
    weighted training rows that ended there. Thresholds are on the scaled features.
    """
    forest = f"{path}/stages/{len(model.stages) - 1}_{model.stages[-1].uid}/data"
    names = F.array(*[F.lit(name) for name in model.stages[0].getInputCols()])
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    stats = node["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda sum_, one: sum_ + one)
    return spark.read.parquet(forest).select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, F.get(names, node["split"]["featureIndex"])).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"),
        (F.get(stats, F.lit(1)) / total).alias("probability"),
    )


def require_small(nodes: DataFrame) -> None:
    found = nodes.limit(MAX_NODES + 1).count()
    if found > MAX_NODES:
        raise ValueError(f"a forest of more than {MAX_NODES} nodes")


def _trees(nodes: DataFrame, features: list[str]) -> DataFrame:
    """One row: the trees, each as arrays over its nodes in their order.

    A leaf has no children; in the arrays both are the leaf itself, so a walk that has
    come to it stays there without being asked.
    """
    index = F.array_position(F.array(*[F.lit(name) for name in features]), F.col("feature"))
    leaf = F.col("left").isNull()
    itself = F.col("node").cast("int")
    packed = F.struct(
        F.col("node"),
        F.when(leaf, 1).otherwise(index.cast("int")).alias("feature"),
        F.when(leaf, 0.0).otherwise(F.col("threshold")).alias("threshold"),
        (F.when(leaf, itself).otherwise(F.col("left")) + 1).alias("left"),
        (F.when(leaf, itself).otherwise(F.col("right")) + 1).alias("right"),
        "probability",
    )
    return (
        nodes.groupBy("tree")
        .agg(F.sort_array(F.collect_list(packed)).alias("_nodes"))
        .select(
            "tree",
            *[
                F.col(f"_nodes.{name}").alias(name)
                for name in ("feature", "threshold", "left", "right", "probability")
            ],
        )
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("tree", "feature", "threshold", "left", "right", "probability")
                )
            ).alias("trees")
        )
    )


def score_with_nodes(
    features: DataFrame,
    nodes: DataFrame,
    inputs: list[tuple[str, float, float]],
    depth: int,
) -> DataFrame:
    """(customer_id, actual_churn, predicted_churn, churn_probability, prediction_label)
    of every customer, from a table of nodes of at most ``depth`` steps.

    The trees are one row of at most ``MAX_NODES`` nodes, joined to every batch of
    customers by a constant, hence the broadcast. A NULL feature counts as 0, as in training.
    """
    require_small(nodes)
    names = [name for name, _, _ in inputs]
    scaled = [(F.col(name).cast("double") - F.lit(shift)) * F.lit(factor) for name, shift, factor in inputs]
    # After ``depth`` steps every walk stands at a leaf, where it stays. A step is all
    # that is done hundreds of times a row, so it has no more than five lookups.
    walk = (
        "aggregate(trees, 0D, (total, t) -> total + element_at(t.probability, aggregate("
        f"sequence(1, {depth}), 1, (at, step) ->"
        " if(element_at(r.scaled, element_at(t.feature, at)) <= element_at(t.threshold, at),"
        " element_at(t.left, at), element_at(t.right, at))))) / size(trees)"
    )
    tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batch = F.pmod(F.xxhash64("customer_id"), F.lit(tasks * BATCHES))
    row = F.struct(
        "customer_id", F.col(LABEL).cast("int").alias("actual_churn"), F.array(*scaled).alias("scaled")
    )
    rows = (
        complete(features)
        .repartition(tasks, batch)
        .groupBy(batch.alias("_batch"))
        .agg(F.collect_list(row).alias("rows"))
        .withColumn("_one", F.lit(0))
    )
    trees = F.broadcast(_trees(nodes, names).withColumn("_one", F.lit(0)))
    scored = F.expr(
        "transform(rows, r -> named_struct('customer_id', r.customer_id,"
        f" 'actual_churn', r.actual_churn, 'churn_probability', {walk}))"
    )
    return (
        rows.join(trees, "_one")
        .select(F.explode(scored).alias("row"))
        .select("row.*")
        .withColumn("predicted_churn", (F.col("churn_probability") > 0.5).cast("int"))
        .withColumn(
            "prediction_label",
            F.when(F.col("predicted_churn") == 1, "Likely to churn").otherwise("Likely to stay"),
        )
        .select("customer_id", "actual_churn", "predicted_churn", "churn_probability", "prediction_label")
    )


# --- jobs ---------------------------------------------------------------


def run_train(spark: SparkSession, layout: Layout, **forest: int) -> Commit:
    """Train on the gold tables, save the final model and publish it as a table.

    A model that was made of the same gold tables stays.
    """
    inputs = "; ".join([layout.gold("dim_customer"), layout.gold("fact_customer_activity"), str(forest)])

    def build() -> dict[str, DataFrame]:
        gold = read_gold(spark, layout)
        split = stage(stratified_split(customer_features(gold.dim, gold.fact)), "split")
        final = select_features(split.where("split = 'train'"), **forest).final
        save_model(final, layout.model("final"))
        scaled = [(n, *values) for n, values in enumerate(scaled_inputs(final))]
        return {
            "nodes": forest_nodes(spark, layout.model("final"), final),
            "inputs": spark.createDataFrame(
                scaled, "place int, feature string, shift double, factor double"
            ).coalesce(1),
        }

    return step(spark, layout.model_set, inputs, build)[0]


def run_score(spark: SparkSession, layout: Layout, depth: int = DEPTH) -> DataFrame:
    """Score every customer with the published model and publish the predictions."""
    model = current(spark, layout.model_set)
    if model is None:
        raise FileNotFoundError("no model is published; train first")
    inputs = "; ".join(
        [model.tables["nodes"], layout.gold("dim_customer"), layout.gold("fact_customer_activity")]
    )

    def build() -> dict[str, DataFrame]:
        gold = read_gold(spark, layout)
        scaled = model.read(spark, "inputs").orderBy("place").collect()
        named = [(row.feature, row.shift, row.factor) for row in scaled]
        features = customer_features(gold.dim, gold.fact)
        return {"predictions": score_with_nodes(features, model.read(spark, "nodes"), named, depth)}

    commit, _ = step(spark, layout.score_set, inputs, build)
    return commit.read(spark, "predictions")
