"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.count_trees import divergence
from churnlake.llm.factorization import fit, score
from churnlake.llm.graph_search import build_index, nearest, usable
from churnlake.llm.host_rules import judge_documents
from churnlake.llm.minhash import near_duplicates
from churnlake.llm.mixing import mix_sources
from churnlake.llm.oracles import ORACLES as ORACLES
from churnlake.llm.pair_merges import encode_merges
from churnlake.llm.sentence_pieces import encode_pieces
from churnlake.llm.sharding import shard_documents
from churnlake.llm.spelling_forms import spelling_forms
from churnlake.llm.substrings import remove_repeats
from churnlake.llm.token_counts import section_tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(_table(spark, sf_dir, "documents"), 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(_table(spark, sf_dir, "documents"), window=50)
    return cleaned.select(
        "doc.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def _held_out(folds: int, out: int) -> Column:
    """Whether a doc_id is in the fold that no label is learned from."""
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    return F.coalesce(fold == out, F.lit(False))


def _classified(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    folds: int,
    out: int,
    structure: bool,
    metadata: tuple[str, ...] = (),
) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learned = labels.where(~_held_out(folds, out)).select("doc_id", F.col(label).alias("label"))
    machine = fit(docs, learned, structure=structure, metadata=metadata)
    return (
        score(docs, machine, structure=structure, metadata=metadata)
        .select("doc.doc_id", "score")
        .select(
            "doc_id",
            _held_out(folds, out).alias("held_out"),
            "score",
            F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        )
    )


def op4_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, "quality", 5, 0, True, metadata=("n_chars",))


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(_table(spark, sf_dir, "documents"))


def op6_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc.doc_id",
        "doc.source",
        "doc.lang",
        "topic",
        "tokens",
        "weight",
        "probability",
        "kept",
    )


def op7_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(_table(spark, sf_dir, "embeddings"))
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return nearest(queries, build_index(vectors, k=5), k=5)


def op8_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(_table(spark, sf_dir, "documents"))


def op9_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, "toxic", 4, 2, False)


def op10_viterbi_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(_table(spark, sf_dir, "documents"))
    ids = F.concat_ws(",", F.col("piece_ids").cast("array<string>"))
    return encoded.select(
        "doc.doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.crc32(ids).alias("ids_crc32"),
        "round_trip",
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


def op12_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(_table(spark, sf_dir, "documents"))


def op13_pair_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    # One pass through Python; two in a row would be buffered on disk in between.
    encoded = encode_merges(docs, keep=("doc_id",), packed=True, decoded=True)
    return encoded.select(
        "doc.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_ring_shards": op1_ring_shards,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_machine": op4_quality_machine,
    "op5_host_rules": op5_host_rules,
    "op6_raked_mixture": op6_raked_mixture,
    "op7_pruned_graph": op7_pruned_graph,
    "op8_section_tokens": op8_section_tokens,
    "op9_toxicity_machine": op9_toxicity_machine,
    "op10_viterbi_pieces": op10_viterbi_pieces,
    "op11_source_divergence": op11_source_divergence,
    "op12_spelling_forms": op12_spelling_forms,
    "op13_pair_merges": op13_pair_merges,
}
