"""Churn classifier: train, evaluate, select features, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.plans.features import FEATURES, LABEL, class_counts
from churnlake.scratch import stage

# The forest of the model.
TREES = 300
DEPTH = 8
SEED = 42

# Node statistics a task may hold; enough for a whole level of the forest, so
# that each level takes one pass over the rows.
LEVEL_MEMORY_MB = 512

# Partitions the training rows are dealt out to. The forest draws its samples
# partition by partition, so this is a parameter of the model and must not
# depend on the cluster or the settings; raise it for larger training sets.
TRAINING_PARTITIONS = 32

PREDICTION_COLUMNS = (
    "customer_id",
    "actual_churn",
    "predicted_churn",
    "churn_probability",
)


@dataclass(frozen=True)
class Selection:
    """The model on all features, and the one on the most important of them."""

    baseline: PipelineModel
    final: PipelineModel
    features: tuple[str, ...]


def complete(features: DataFrame) -> DataFrame:
    """Customers without activity have no activity: their measures are zero."""
    return features.fillna(0)


def with_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add ``weight`` such that every class weighs the same in total."""
    members = class_counts(df, label)
    total = sum(members.values())
    weight = F.lit(None).cast("double")
    for value, count in members.items():
        weight = F.when(F.col(label) == value, total / (len(members) * count)).otherwise(weight)
    return df.withColumn("weight", weight)


def training_rows(
    df: DataFrame, row_id: str = "customer_id", partitions: int = TRAINING_PARTITIONS
) -> DataFrame:
    """The rows dealt out by id and sorted, the same on every cluster."""
    return df.repartition(partitions, row_id).sortWithinPartitions(row_id)


def train(
    training: DataFrame,
    columns: Sequence[str] = FEATURES,
    label: str = LABEL,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
) -> PipelineModel:
    """Scaler and forest, fitted on the training rows only."""
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
        RandomForestClassifier(
            featuresCol="scaled",
            labelCol=label,
            weightCol="weight",
            numTrees=trees,
            maxDepth=depth,
            seed=seed,
            maxMemoryInMB=LEVEL_MEMORY_MB,
            cacheNodeIds=True,
        ),
    ]
    rows = training_rows(complete(training)).persist()
    try:
        return Pipeline(stages=stages).fit(with_class_weights(rows, label))
    finally:
        rows.unpersist()


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """One prediction per customer."""
    probability = vector_to_array("probability")[1]
    return model.transform(complete(features)).select(
        "customer_id",
        F.col(LABEL).cast("int").alias("actual_churn"),
        F.col("prediction").cast("int").alias("predicted_churn"),
        probability.alias("churn_probability"),
        F.when(F.col("prediction") == 1, "Likely to churn")
        .otherwise("Likely to stay")
        .alias("prediction_label"),
    )


def dealt_out(features: DataFrame) -> DataFrame:
    """The rows over all tasks of a shuffle. A row costs hundreds of trees, but is
    small, so partitions that fit a task by size would leave most cores idle; AQE
    leaves a given number of partitions as it is. They are dealt by a hash of the id:
    rows that a join on the id has shuffled would not be dealt out again by the id
    itself, and the join's partitions may be merged into one."""
    tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return features.repartition(tasks, F.xxhash64("customer_id"))


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The stored predictions of all customers.

    Hundreds of trees make a row expensive, so the predictions are stored: a
    sort by risk would otherwise score every row once to find its ranges and
    once more to sort.
    """
    return stage(score(model, dealt_out(features)), "predictions")


def ranked_by_risk(predictions: DataFrame) -> DataFrame:
    return predictions.select(*PREDICTION_COLUMNS, "prediction_label").orderBy(
        F.desc("churn_probability"), "customer_id"
    )


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """(feature, importance), most important first; one entry per feature."""
    columns = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return sorted(zip(columns, weights, strict=True), key=lambda pair: (-pair[1], pair[0]))


def select_features(training: DataFrame, keep: int = 5, **forest: int) -> Selection:
    """Train on all features, then again on the ``keep`` most important."""
    baseline = train(training, **forest)
    kept = tuple(name for name, _ in importances(baseline)[:keep])
    return Selection(baseline, train(training, kept, **forest), kept)


def confusion_matrix(
    predictions: DataFrame, actual: str = "actual_churn", predicted: str = "predicted_churn"
) -> DataFrame:
    return (
        predictions.groupBy(actual, predicted)
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(actual, predicted)
    )


def class_report(
    predictions: DataFrame, actual: str = "actual_churn", predicted: str = "predicted_churn"
) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    cells = confusion_matrix(predictions, actual, predicted)
    hit = F.when(F.col("class") == F.col("other"), F.col("customers")).otherwise(0)
    by_actual = cells.select(
        F.col(actual).alias("class"), F.col(predicted).alias("other"), "customers"
    )
    by_predicted = cells.select(
        F.col(predicted).alias("class"), F.col(actual).alias("other"), "customers"
    )
    supported = by_actual.groupBy("class").agg(
        F.sum(hit).alias("hits"), F.sum("customers").alias("support")
    )
    claimed = by_predicted.groupBy("class").agg(F.sum("customers").alias("claimed"))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "claimed"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    return (
        supported.join(claimed, "class", "left")
        .select("class", precision.alias("precision"), recall.alias("recall"), "support")
        .withColumn(
            "f1",
            F.coalesce(
                F.try_divide(
                    2 * F.col("precision") * F.col("recall"),
                    F.col("precision") + F.col("recall"),
                ),
                zero,
            ),
        )
        .orderBy("class")
    )


def accuracy(
    predictions: DataFrame, actual: str = "actual_churn", predicted: str = "predicted_churn"
) -> DataFrame:
    hits = F.count_if(F.col(actual) == F.col(predicted))
    return predictions.agg((hits / F.count(F.lit(1))).alias("accuracy"))


def roc_auc(
    predictions: DataFrame,
    actual: str = "actual_churn",
    score_col: str = "churn_probability",
) -> float:
    """Area under the ROC curve over all distinct scores."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(
        predictions.select(
            F.col(score_col).cast("double").alias("score"),
            F.col(actual).cast("double").alias("label"),
        )
    )


def evaluate(model: PipelineModel, test: DataFrame) -> dict[str, float]:
    predictions = score(model, test).persist()
    try:
        return {
            "accuracy": accuracy(predictions).first()[0],
            "roc_auc": roc_auc(predictions),
        }
    finally:
        predictions.unpersist()


def save_model(model: PipelineModel, path: str) -> None:
    """Assembler, scaler and forest are stages of one saved pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
