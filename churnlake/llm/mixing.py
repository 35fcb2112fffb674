"""Mixing sources to target weights by iterative proportional fitting.

The tokens of each cell (source, language, topic) get the weight a(source) *
b(language) * c(topic) whose marginals meet the targets. Sources may be many:
their factors are computed where their cells are, and only the (language, topic)
table, weighted by them, comes to the driver, which rakes it to the other two
marginals. A sweep is one job over the stored cells.

Documents are then drawn with a probability, at most 1, under which the expected
tokens are the given share of all and meet the same targets: the weights are
raked once more, with cells at 1 held there and the others making up for them.
A target beyond the tokens there are is met as far as they go; the others of its
kind share the rest. Such targets are logged with what was reached.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlake.scratch import stage

CELL = ("source", "lang", "topic")
SWEEPS = 40

# Pairs of language and topic that the driver rakes; more are refused.
MAX_PAIRS = 1 << 16
TOLERANCE = 1e-6
# Shares that differ by more are reported, the largest LISTED differences in the log.
REPORTED, LISTED = 1e-5, 20

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Targets:
    """Target shares: those given by name for ``lang`` and ``topic``, else in
    proportion to the tokens to the power ``temper``. Values without tokens
    drop out and the others are scaled up."""

    keep: float = 0.5
    temper: dict[str, float] = field(
        default_factory=lambda: {"source": 0.7, "lang": 0.5, "topic": 0.7}
    )
    shares: dict[str, dict[str, float]] = field(default_factory=dict)


def n_words(text: Column) -> Column:
    """Words of a text; the token count used where none is given."""
    spaced = F.regexp_replace(text, r"[\x09-\x0D]", " ")
    return F.size(F.array_remove(F.split(spaced, " "), ""))


def genre(text: Column, words: Column) -> Column:
    """A topic by form, for corpora that bring none."""
    size = F.length(text)
    bars = size - F.length(F.replace(text, F.lit("|"), F.lit("")))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        F.when(bars * 10 > words, "table")
        .when(capitals * 2 > size, "loud")
        .when(words < 100, "note")
        .when(words < 400, "page")
        .when(words < 1500, "article")
        .otherwise("book")
    )


def _target(totals: dict[str, float], name: str, targets: Targets) -> dict[str, float]:
    given = targets.shares.get(name)
    if given is None:
        shares = {key: total ** targets.temper[name] if total else 0.0 for key, total in totals.items()}
    else:
        shares = {key: given.get(key, 0.0) if total else 0.0 for key, total in totals.items()}
    whole = sum(shares.values())
    if not whole:
        raise ValueError(f"no {name} with a target has tokens")
    return {key: share / whole for key, share in shares.items()}


def rake_table(table: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factors of rows and columns that give the table these marginals."""
    a, b = np.ones(len(rows)), np.ones(len(columns))
    for _ in range(1000):
        sums = table @ b
        a = np.divide(rows, sums, out=np.zeros(len(rows)), where=sums > 0)
        sums = a @ table
        new = np.divide(columns, sums, out=np.zeros(len(columns)), where=sums > 0)
        done = np.allclose(new, b, rtol=1e-12, atol=0)
        b = new
        if done:
            break
    return a, b


def _pair_table(rows: list, langs: list[str], topics: list[str], name: str) -> np.ndarray:
    at = {(row.lang, row.topic): row[name] for row in rows}
    return np.array([[at.get((x, y), 0) for y in topics] for x in langs], float)


def _pair_targets(plain: np.ndarray, langs: list[str], topics: list[str], targets: Targets) -> list[np.ndarray]:
    """Target shares of the languages and of the topics."""
    return [
        np.array(list(_target(dict(zip(names, plain.sum(axis=axis), strict=True)), name, targets).values()))
        for name, names, axis in (("lang", langs, 1), ("topic", topics, 0))
    ]


def _pairs(spark, langs: list[str], topics: list[str], factor: np.ndarray) -> DataFrame:
    rows = [(x, y, float(factor[i, j])) for i, x in enumerate(langs) for j, y in enumerate(topics)]
    return spark.createDataFrame(rows, "lang string, topic string, factor double")


def _source_factors(cells: DataFrame, pairs: DataFrame, temper: float) -> DataFrame:
    """The cells with ``mass``, their tokens times all factors. The pairs of
    language and topic are as few as the table on the driver."""
    by_source = Window.partitionBy("source")
    weighted = cells.join(F.broadcast(pairs), ["lang", "topic"]).withColumn(
        "part", F.col("tokens") * F.col("factor")
    )
    reached = F.sum("part").over(by_source)
    goal = F.pow(F.sum("tokens").over(by_source).cast("double"), F.lit(temper))
    return weighted.withColumn(
        "mass", F.when(reached > 0, F.col("part") / reached * goal).otherwise(F.lit(0.0))
    )


def cell_weights(cells: DataFrame, targets: Targets) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``, the target tokens
    of the cell for each of its tokens; the weighted tokens add up to all."""
    spark = cells.sparkSession
    pairs = cells.groupBy("lang", "topic").agg(F.sum("tokens").alias("tokens"))
    totals = pairs.limit(MAX_PAIRS + 1).collect()
    if len(totals) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of language and topic")
    langs = sorted({row.lang for row in totals})
    topics = sorted({row.topic for row in totals})
    plain = _pair_table(totals, langs, topics, "tokens")
    all_tokens = plain.sum()
    if not all_tokens:
        return cells.withColumn("weight", F.lit(1.0))
    want = _pair_targets(plain, langs, topics, targets)
    factor = np.ones(plain.shape)

    def weighted() -> DataFrame:
        pairs = _pairs(spark, langs, topics, factor)
        return _source_factors(cells, pairs, targets.temper["source"])

    for _ in range(SWEEPS):
        sums = weighted().groupBy("lang", "topic").agg(F.sum("mass").alias("mass")).collect()
        table = np.zeros(plain.shape)
        for row in sums:
            table[langs.index(row.lang), topics.index(row.topic)] = row.mass
        table /= table.sum()
        gap = max(np.abs(table.sum(axis=1 - axis) - want[axis]).max() for axis in (0, 1))
        if gap < TOLERANCE:
            break
        a, b = rake_table(table, *want)
        factor *= np.outer(a, b)
        factor /= factor.max()
    found = stage(weighted().select(*CELL, "tokens", "mass"), "mixing-cells")
    whole = found.agg(F.sum("mass")).first()[0]
    weight = F.col("mass") / F.lit(whole / all_tokens) / F.col("tokens")
    return found.withColumn("weight", F.when(F.col("tokens") > 0, weight).otherwise(0.0))


def calibration(weighted: DataFrame, keep: float) -> float:
    """The factor c with which min(1, c * weight) keeps this share of the tokens.

    Each step fixes the cells that have reached 1 and scales up the rest."""
    factor, before = keep, None
    while factor != before:
        sure = F.col("weight") * factor >= 1
        row = weighted.agg(
            F.sum("tokens").alias("total"),
            F.sum(F.when(sure, F.col("tokens")).otherwise(0)).alias("sure"),
            F.sum(F.when(sure, 0.0).otherwise(F.col("weight") * F.col("tokens"))).alias("rest"),
        ).first()
        before = factor
        if not row.rest or not row.total:
            break
        factor = max(factor, (keep * row.total - row.sure) / row.rest)
    return factor


def bounded_goals(shares: np.ndarray, limits: np.ndarray, total: float) -> np.ndarray:
    """Amounts in proportion to ``shares``, none above its limit, that add up to
    ``total`` or else to all that the limits allow."""
    rate = np.divide(shares, limits, out=np.zeros(len(limits)), where=limits > 0)
    return np.minimum(limits, fill(limits, rate, total) * shares)


def fill(tokens: np.ndarray, rate: np.ndarray, goal: float) -> float:
    """The least s with sum(tokens * min(1, s * rate)) = goal, or with all at 1.

    The sum is the least of the lines that take the k largest rates for 1."""
    there = (rate > 0) & (tokens > 0)
    order = np.argsort(-rate[there], kind="stable")
    size, part = tokens[there][order], (tokens * rate)[there][order]
    if not len(size):
        return 0.0
    sure = np.cumsum(size) - size
    rest = np.cumsum(part[::-1])[::-1]
    return max(0.0, float(((min(goal, size.sum()) - sure) / rest).max()))


def rake_bounded(
    tokens: np.ndarray, rate: np.ndarray, rows: np.ndarray, columns: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Factors a, b of (row, column, bin) for which tokens * min(1, a * b * rate)
    has these marginals, as far as they can be met together."""
    a, b = np.ones(len(rows)), np.ones(len(columns))
    for _ in range(200):
        before = a, b
        a = np.array([fill(tokens[i].ravel(), (rate[i] * b[:, None]).ravel(), rows[i]) for i in range(len(a))])
        b = np.array(
            [fill(tokens[:, j].ravel(), (rate[:, j] * a[:, None]).ravel(), columns[j]) for j in range(len(b))]
        )
        if all(np.allclose(x, y, rtol=1e-10, atol=0) for x, y in zip(before, (a, b), strict=True)):
            break
    return a, b


def _filled_sources(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """``cells`` (source, lang, topic, tokens, weight, goal) with ``rate``, for
    which tokens * min(1, rate) add up to the goal of each source; see ``fill``."""
    by_source = Window.partitionBy("source")
    falling = by_source.orderBy(F.desc("rate"), "lang", "topic")
    up_to = falling.rowsBetween(Window.unboundedPreceding, 0)
    onward = falling.rowsBetween(0, Window.unboundedFollowing)
    rows = cells.join(F.broadcast(pairs), ["lang", "topic"]).withColumn("rate", F.col("weight") * F.col("factor"))
    rows = rows.withColumn("sure", F.sum("tokens").over(up_to) - F.col("tokens"))
    rows = rows.withColumn("rest", F.sum(F.col("tokens") * F.col("rate")).over(onward))
    line = F.when(F.col("rest") > 0, (F.col("goal") - F.col("sure")) / F.col("rest"))
    scale = F.greatest(F.lit(0.0), F.max(line).over(by_source))
    return rows.withColumn("rate", F.col("rate") * F.coalesce(scale, F.lit(0.0))).drop("sure", "rest", "factor")


def cell_probabilities(weighted: DataFrame, targets: Targets) -> DataFrame:
    """``weighted``, as of ``cell_weights``, with ``probability``, at most 1.

    The expected tokens are ``keep`` of all and their marginals meet the targets.
    Cells of weight 0 stay at 0, so a value has at most its other tokens to give.
    """
    spark, temper = weighted.sparkSession, targets.temper["source"]
    open_tokens = F.when(F.col("weight") > 0, F.col("tokens")).otherwise(0)
    found = weighted.groupBy("lang", "topic").agg(
        F.sum("tokens").alias("tokens"), F.sum(open_tokens).alias("open")
    ).collect()
    langs, topics = sorted({row.lang for row in found}), sorted({row.topic for row in found})
    plain, free = (_pair_table(found, langs, topics, name) for name in ("tokens", "open"))
    if not plain.sum():
        return weighted.withColumn("probability", F.lit(targets.keep))
    want = _pair_targets(plain, langs, topics, targets)
    total = min(targets.keep * plain.sum(), free.sum())
    if not total:
        return weighted.withColumn("probability", F.lit(0.0))
    goals = [bounded_goals(share, free.sum(axis=1 - axis), total) for axis, share in enumerate(want)]

    by_source = Window.partitionBy("source")
    share = F.pow(F.sum("tokens").over(by_source).cast("double"), F.lit(temper))
    open_sum = F.sum(open_tokens).over(by_source)
    cells = weighted.select(*CELL, "tokens", "weight", share.alias("share"), open_sum.alias("open"))
    sources = cells.where("open > 0").groupBy("source").agg(
        F.first("open").alias("tokens"), F.first("share").alias("share")
    )
    whole = sources.agg(F.sum("tokens").alias("tokens"), F.sum("share").alias("share")).first()
    even = whole.tokens / whole.share
    rate = F.col("share") * even
    scale = calibration(sources.select("tokens", (rate / F.col("tokens")).alias("weight")), total / whole.tokens)
    cells = stage(
        cells.withColumn("goal", F.least(F.col("open").cast("double"), rate * scale)).drop("share", "open"),
        "mixing-cells",
    )

    factor, gaps = np.ones(plain.shape), []
    depth = F.greatest(F.lit(-64), F.least(F.lit(31), F.floor(F.log2("rate") * 4))) + 64
    for _ in range(SWEEPS):
        # A bin ends at rate 1, so that factors of 1 give the very sums of the cells.
        bins = (
            _filled_sources(cells, _pairs(spark, langs, topics, factor))
            .where("rate > 0 and tokens > 0")
            .groupBy("lang", "topic", depth.cast("int").alias("bin"))
            .agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("rate")).alias("mass"))
            .collect()
        )
        tokens, mass = np.zeros((*plain.shape, 96)), np.zeros((*plain.shape, 96))
        for row in bins:
            at = langs.index(row.lang), topics.index(row.topic), row.bin
            tokens[at], mass[at] = row.tokens, row.mass
        expected = np.minimum(tokens, mass).sum(axis=2)
        gap = max(np.abs(expected.sum(axis=1 - axis) - goals[axis]).max() / total for axis in (0, 1))
        gaps.append(gap)
        # Targets that contradict each other leave a gap that stays.
        if gap < TOLERANCE or (len(gaps) > 4 and gap > 0.98 * gaps[-5]):
            break
        rates = np.divide(mass, tokens, out=np.zeros(mass.shape), where=tokens > 0)
        a, b = rake_bounded(tokens, rates, *goals)
        factor *= np.outer(a, b)
        factor /= factor.max()
    log.info("mixture: gaps of the sweeps %s", gaps)
    filled = _filled_sources(cells, _pairs(spark, langs, topics, factor))
    chance = F.least(F.lit(1.0), F.col("rate")).alias("probability")
    return stage(filled.select(*CELL, "tokens", "weight", chance), "mixing-cells")


def unmet_targets(cells: DataFrame, targets: Targets) -> DataFrame:
    """(name, value, target, achieved) of the sources, languages and topics whose
    share of the expected tokens of ``cell_probabilities`` is not their target."""
    spark, found = cells.sparkSession, []
    expected = F.sum(F.col("tokens") * F.col("probability"))
    whole = cells.agg(expected).first()[0] or 1.0
    for name in ("lang", "topic"):
        rows = cells.groupBy(name).agg(F.sum("tokens").alias("tokens"), expected.alias("kept")).collect()
        if not sum(row.tokens for row in rows):
            continue
        want = _target({row[name]: row.tokens for row in rows}, name, targets)
        found += [(name, row[name], want[row[name]], row.kept / whole) for row in rows]
    schema = "name string, value string, target double, achieved double"
    sources = cells.groupBy("source").agg(F.sum("tokens").alias("tokens"), expected.alias("kept"))
    share = F.pow(F.col("tokens").cast("double"), F.lit(targets.temper["source"]))
    shares = sources.agg(F.sum(share)).first()[0] or 1.0
    rows = sources.select(
        F.lit("source").alias("name"),
        F.col("source").alias("value"),
        (share / F.lit(shares)).alias("target"),
        (F.col("kept") / F.lit(whole)).alias("achieved"),
    )
    every = spark.createDataFrame(found, schema).unionByName(rows)
    return every.where(F.abs(F.col("target") - F.col("achieved")) > REPORTED)


def _report(cells: DataFrame, targets: Targets) -> None:
    unmet = unmet_targets(cells, targets)
    gap = F.abs(F.col("target") - F.col("achieved"))
    worst = unmet.orderBy(F.desc(gap), "name", "value").limit(LISTED + 1).collect()
    for row in worst[:LISTED]:
        log.warning("mixture: %s %r has target %.6f, achieved %.6f", *row)
    if len(worst) > LISTED:
        log.warning("mixture: more targets are not met; unmet_targets lists them all")


def mix_sources(
    docs: DataFrame, targets: Targets = Targets(), *, seed: int = 17, topic: Column | None = None
) -> DataFrame:
    """(doc, topic, tokens, weight, probability, kept), one row per row of ``docs``.

    ``docs`` has doc_id, text, lang and source; ``doc`` is the whole row. Tokens
    are words. A null source, language or topic counts as ''. A document is kept
    if a hash of its doc_id, or of its text where that is null, lies below its
    probability, so a rerun keeps the same. A text without words has no weight
    of its own and is drawn with the probability ``keep``. More than ``MAX_PAIRS``
    pairs of language and topic are refused.
    """
    tokens = f"_tokens_{uuid.uuid4().hex}"
    text = F.coalesce("text", F.lit(""))
    words = n_words(text).cast("long")
    place = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(seed), "doc_id")).otherwise(
        F.xxhash64(F.lit(seed), text)
    )
    kind = genre(text, F.col(tokens)) if topic is None else F.coalesce(topic, F.lit(""))
    # A column of its own, so that a text is split once.
    rows = docs.withColumn(tokens, words).select(
        F.struct(*docs.columns).alias("doc"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        kind.alias("topic"),
        F.col(tokens).alias("tokens"),
        (F.shiftrightunsigned(place, 11) / F.lit(float(1 << 53))).alias("draw"),
    )
    cells = stage(rows.groupBy(*CELL).agg(F.sum("tokens").alias("tokens")), "mixing-cells")
    found = cell_probabilities(cell_weights(cells, targets), targets)
    _report(found, targets)
    chance = F.when(F.col("tokens") == 0, F.lit(targets.keep)).otherwise(F.col("probability"))
    return rows.join(found.select(*CELL, "weight", "probability"), list(CELL)).select(
        "doc",
        "topic",
        "tokens",
        "weight",
        chance.alias("probability"),
        (F.col("draw") < chance).alias("kept"),
    )
