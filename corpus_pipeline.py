"""From documents to token ids: a corpus pipeline of five stages.

Each stage takes what its predecessor kept and is stored before the next one
starts. All but the last return the columns of ``documents``. A null text is one
without words: it is clean, a copy of nothing, keeps no passage and has no pieces.
Null lang and source count as '' where tokens are mixed and are passed on as they
are. Rows without doc_id are never copies, and repeat nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm.factorization import fit, score
from churnlake.llm.minhash import near_duplicates
from churnlake.llm.mixing import mix_sources
from churnlake.llm.sentence_pieces import encode_pieces
from churnlake.llm.substrings import remove_repeats
from churnlake.scratch import stage

TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a machine learned from ``labels`` scores below ``TOXIC``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = fit(docs, labels.select("doc_id", F.col("toxic").alias("label")), structure=False)
    scored = score(docs, machine, structure=False)
    return scored.where(F.col("score") < TOXIC).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group, by five words and 0.8."""
    dropped = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that an earlier one has.

    A text that loses words is its other words, joined by one space, and n_chars
    tells its length; any other row stays as it is.
    """
    cut = remove_repeats(docs)
    shorter = F.col("n_removed") > 0
    edited = {
        "text": F.when(shorter, F.col("kept_text")).otherwise(F.col("doc.text")),
        "n_chars": F.when(shorter, F.length("kept_text").cast("long")).otherwise(F.col("doc.n_chars")),
    }
    return cut.select(
        *[edited.get(name, F.col(f"doc.`{name}`")).alias(name) for name in docs.columns]
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens follow the target shares, as far as there
    are tokens for them."""
    return mix_sources(docs).where("kept").select("doc.*")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces and the piece ids."""
    return encode_pieces(docs).select(
        "doc.doc_id",
        "doc.lang",
        "doc.source",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        "piece_ids",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("source mixture", mix),
    ("piece ids", to_pieces),
]

# The classifier and the sketches are beyond SQL; tests/llm/test_pipeline.py compares
# the rows of each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``; no rows give no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
