"""Silver and gold tables of the workload, built once per session and folder."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.layout import Layout
from churnlake.operators.keys import key_reference
from churnlake.plans.forest import forest_nodes, scaled_inputs
from churnlake.plans.features import LABEL, customer_features, stratified_split
from churnlake.plans.gold import (
    Gold,
    activity_rollup,
    build_dim,
    build_facts,
    run_gold,
    store_bucketed,
)
from churnlake.plans.model import importances, load_model, save_model, select_features
from churnlake.plans.silver import Silver, clean_source, run_silver, standardize
from churnlake.scratch import new_dir, stage
from churnlake.sources.specs import CUSTOMERS, OFFERS, TICKETS, USAGE, SourceSpec
from churnlake.workload.dropped import write_bronze
from churnlake.workload.raw import RAW, as_of

_BUILT: dict[tuple[str, str, str], object] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, name


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    """The stored result of ``build``, which runs the first time it is needed."""
    key = _key(spark, sf_dir, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def standardized(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    return standardize(RAW[spec.name](spark, sf_dir), spec)


def customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        clean = silver_table(spark, sf_dir, CUSTOMERS).clean
        return stage(key_reference(clean, CUSTOMERS.key), "customer-ids")

    return _once(spark, sf_dir, "customer_ids", build)


def build_silver(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> Silver:
    """Clean one source anew; later queries read the tables this stored."""
    ids = None if spec.foreign_key is None else customer_ids(spark, sf_dir)
    silver = clean_source(standardized(spark, sf_dir, spec), spec, as_of(), ids)
    _BUILT[_key(spark, sf_dir, spec.name)] = silver
    return silver


def silver_table(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> Silver:
    """The clean and rejected rows of one source, on the tables its build stored."""
    return _once(spark, sf_dir, spec.name, lambda: build_silver(spark, sf_dir, spec))


def clean_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Clean customers, tickets, offers and usage."""
    return tuple(
        silver_table(spark, sf_dir, spec).clean for spec in (CUSTOMERS, TICKETS, OFFERS, USAGE)
    )


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity of every customer and month, which all of gold is made from."""

    def build() -> DataFrame:
        _, tickets, offers, usage = clean_tables(spark, sf_dir)
        return stage(activity_rollup(usage, tickets, offers), "activity-rollup")

    return _once(spark, sf_dir, "rollup", build)


def dim_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        clean = silver_table(spark, sf_dir, CUSTOMERS).clean
        return stage(build_dim(clean, rollup(spark, sf_dir)), "dim")

    return _once(spark, sf_dir, "dim", build)


def gold_tables(spark: SparkSession, sf_dir: str) -> Gold:
    def build() -> Gold:
        dim = dim_table(spark, sf_dir)
        fact, mart = build_facts(rollup(spark, sf_dir), dim)
        return Gold(dim, stage(fact, "fact"), stage(mart, "mart"))

    return _once(spark, sf_dir, "gold", build)


def bucketed_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dimension and fact as tables laid out by customer."""

    def build() -> tuple[DataFrame, DataFrame]:
        folder, database = new_dir(spark, "bucketed"), f"churn_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/database'")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return store_bucketed(spark, gold_tables(spark, sf_dir), folder, database, buckets)

    return _once(spark, sf_dir, "bucketed", build)


def job_lake(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake that the jobs built from raw files, each in a run of its own; a second
    run of the silver job finds nothing to do."""

    def build() -> Layout:
        layout = write_bronze(spark, sf_dir)
        for _ in range(2):
            status = run_silver(spark, layout, as_of())
            failed = {name: outcome for name, outcome in status.items() if outcome != "SUCCESS"}
            if failed:
                raise RuntimeError(f"the silver job failed: {failed}")
        run_gold(spark, layout)
        return layout

    return _once(spark, sf_dir, "job-lake", build)


def split_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test customers."""

    def build() -> DataFrame:
        gold = gold_tables(spark, sf_dir)
        return stage(stratified_split(customer_features(gold.dim, gold.fact)), "split")

    split = _once(spark, sf_dir, "split", build)
    return split.where("split = 'train'"), split.where("split = 'test'")


def trained(
    spark: SparkSession, sf_dir: str
) -> tuple[PipelineModel, PipelineModel, tuple[str, ...]]:
    """Baseline model, final model and the features of the latter; saved and
    loaded again, as scoring does."""

    def build() -> tuple[PipelineModel, PipelineModel, tuple[str, ...]]:
        training, _ = split_features(spark, sf_dir)
        chosen = select_features(training)
        folder = _once(spark, sf_dir, "model-folder", lambda: new_dir(spark, "models"))
        save_model(chosen.baseline, f"{folder}/baseline")
        save_model(chosen.final, f"{folder}/final")
        return (
            load_model(f"{folder}/baseline"),
            load_model(f"{folder}/final"),
            chosen.features,
        )

    return _once(spark, sf_dir, "model", build)


def final_nodes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple[str, float, float]]]:
    """The final model as a stored table, and how its features are scaled."""

    def build() -> tuple[DataFrame, list[tuple[str, float, float]]]:
        _, final, _ = trained(spark, sf_dir)
        folder = _BUILT[_key(spark, sf_dir, "model-folder")]
        nodes = forest_nodes(spark, f"{folder}/final", final)
        return stage(nodes, "nodes"), scaled_inputs(final)

    return _once(spark, sf_dir, "nodes", build)


def separable(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, PipelineModel, list[tuple[str, float]]]:
    """The model on a label that num_products decides, so that SQL can state what
    it predicts: the split customers, the final model, saved and loaded again, and
    the importances of the baseline."""

    def build() -> tuple[DataFrame, PipelineModel, list[tuple[str, float]]]:
        gold = gold_tables(spark, sf_dir)
        labelled = customer_features(gold.dim, gold.fact).withColumn(
            LABEL, (F.col("num_products") >= 3).cast("int")
        )
        split = stage(stratified_split(labelled), "separable")
        chosen = select_features(split.where("split = 'train'"))
        path = new_dir(spark, "models")
        save_model(chosen.final, path)
        return split, load_model(path), importances(chosen.baseline)

    return _once(spark, sf_dir, "separable", build)
