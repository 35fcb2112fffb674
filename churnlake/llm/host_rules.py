"""Quality rules judged by host.

Each document gets counts and base rules; the failures are added up by host. A
host's failure rate is shrunk towards the rate of all hosts with a beta prior
whose mean and strength are fitted to the hosts' rates by their moments, so a
host of few documents is not condemned for one of them. A host whose shrunk rate
is above ``limit`` loses all its documents. DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.scratch import stage

# As SQL escapes: space, tab, line feed, vertical tab, form feed, carriage return.
_BLANKS = r" \t\n\u000B\u000C\r"
_SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUPLICATE_LINE_PERCENT = 30
LIMIT = 0.5

# Strength of the prior where the hosts' rates do not differ.
STRONGEST = 1e6


def _repeated_words(positions: str) -> Column:
    """Words covered by the three-word windows at the sorted positions."""
    return F.expr(
        f"aggregate({positions}, named_struct('last', -3, 'words', 0L),"
        " (s, p) -> named_struct('last', p, 'words', s.words + least(3, p - s.last)),"
        " s -> s.words)"
    )


def text_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and
    n_repeat_words of its column text; a null text counts as empty.

    The windows of a text are compared by hash; only texts in which one occurs
    twice are sorted, so the work per text is n log n.
    """
    text = F.coalesce("text", F.lit(""))
    return (
        docs.withColumn("_text", text)
        .withColumn("_trimmed", F.expr(rf"trim(BOTH '{_BLANKS}' FROM _text)"))
        .withColumn(
            "_words",
            F.expr(
                "CASE WHEN _trimmed = '' THEN cast(array() AS array<string>) "
                r"ELSE split(_trimmed, '[\\x20\\x09-\\x0D]+') END"
            ),
        )
        .withColumn(
            "_windows",
            F.expr(
                "CASE WHEN size(_words) < 3 THEN cast(array() AS array<bigint>) ELSE "
                "transform(sequence(0, size(_words) - 3),"
                " i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) END"
            ),
        )
        .withColumn(
            "_order",
            F.expr(
                "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN"
                " sort_array(transform(_windows, (h, i) -> struct(h, i)))"
                " ELSE cast(array() AS array<struct<h: bigint, i: int>>) END"
            ),
        )
        .withColumn(
            "_positions",
            F.expr(
                "sort_array(transform(filter(_order, (x, j) ->"
                " get(_order, j - 1).h <=> x.h OR get(_order, j + 1).h <=> x.h), x -> x.i))"
            ),
        )
        .withColumn(
            "_lines",
            F.expr(rf"filter(split(_text, '\\n'), x -> trim(BOTH '{_BLANKS}' FROM x) != '')"),
        )
        .select(
            *docs.columns,
            F.size("_words").cast("long").alias("n_words"),
            F.expr(rf"length(translate(_text, '{_BLANKS}', ''))").cast("long").alias("word_chars"),
            F.expr(f"length(_text) - length(translate(_text, '{_SYMBOLS}', ''))")
            .cast("long")
            .alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            _repeated_words("_positions").alias("n_repeat_words"),
        )
    )


def host_verdicts(judged: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, host_kept) from (host, failed).

    Two sums over the hosts give the prior; nothing else comes to the driver.
    A null host is a host of its own.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    seen = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread")).first()
    mean = seen["mean"] or 0.0
    spread = seen["spread"] or 0.0
    strength = min(mean * (1 - mean) / spread - 1, STRONGEST) if spread > 0 else STRONGEST
    strength = max(strength, 1.0)
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("host_rate", shrunk).withColumn(
        "host_kept", F.col("host_rate") <= limit
    )


def judge_documents(docs: DataFrame, *, host: str = "source", limit: float = LIMIT) -> DataFrame:
    """Counts, base_failed, host_rate and kept, one row per row of ``docs``.

    ``docs`` has doc_id, text (string) and the host column; other columns are
    ignored. base_failed: fewer than 50 words, or more than half of them in
    repeated three-word windows. A document also counts against its host if
    symbols or repeated lines are too frequent. kept: not base_failed, and the
    host is kept. Null and empty texts fail; no rows give no rows.
    """
    counted = text_counts(docs.select("doc_id", "text", F.col(host).alias("host"))).drop("text")
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    failed = (
        base
        | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
        | (100 * F.col("n_dup_lines") > MAX_DUPLICATE_LINE_PERCENT * F.col("n_lines"))
    )
    judged = stage(
        counted.withColumn("base_failed", base).withColumn("failed", failed), "host-rules"
    )
    hosts = host_verdicts(judged, limit).withColumnRenamed("host", "of_host")
    return judged.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"),
        "failed",
        "host_kept",
    )
