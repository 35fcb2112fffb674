"""Near-duplicate documents by HyperMinHash sketches.

A document's distinct word shingles are hashed once. The top bits of a hash
choose one of 128 buckets; a bucket keeps its smallest value, compressed to the
number of leading zeros (6 bits) and the next 10 bits, the mantissa. Four
neighbouring registers make a band; documents that agree in a band are
candidates. A candidate pair whose estimate, corrected for registers that are
equal by chance, comes near the threshold is confirmed on the full sets, whose
shingles are told apart by the bytes of their words.

Nothing is done for all pairs of a group:

* Documents of equal sets are one class with one sketch.
* Round 1 compares the members of a band's bucket with the smallest of them.
* Round 2 looks only at buckets whose members are still in several components
  and tries the pairs across components. It estimates in blocks of at most
  ``BLOCK`` sketches, so a large bucket meets in no single task, and confirms in
  bundles of blocks that fetch each text once.

Two documents that reach the threshold t share
no band with a chance of (1 - t**4)**32, which is 5e-11 at 0.85 and 5e-8 at 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.components import components
from churnlake.llm.words import find_words, mix, pieces
from churnlake.scratch import stage

BUCKETS, BANDS, MANTISSA = 128, 32, 10

# Sketches compared with one another at a time in round 2.
BLOCK = 2048

# Pairs estimated at a time inside a task.
PAIRS = 1 << 18

# Shingles of the texts of a bundle, unless one block has more.
BUNDLE = 1 << 21

# Fixed value of the published estimator: the share of registers of two
# disjoint sets of one size that are equal by chance, times 2**MANTISSA.
CHANCE = 0.169919487159739

# A block pair of a bucket.
GROUP = ("key", "low", "high")

_EDGES = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(57)
# The order in which an empty bucket asks the others for a register.
_ASK = np.random.Generator(np.random.PCG64(7)).permuted(
    np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1
)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The registers of a sorted, non-empty array of distinct hashes."""
    starts = np.searchsorted(hashes, _EDGES)
    filled = np.diff(np.append(starts, len(hashes))) > 0
    least = hashes[np.minimum(starts, len(hashes) - 1)]
    value = (least & np.uint64((1 << 57) - 1)) >> np.uint64(4)
    zeros = 53 - np.frexp(value.astype(np.float64))[1]
    shifted = value << np.minimum(zeros, 52).astype(np.uint64)
    mantissa = (shifted >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    registers = ((zeros << MANTISSA) | mantissa.astype(np.int64)).astype(np.uint16)
    if not filled.all():
        source = _ASK[np.arange(BUCKETS), filled[_ASK].argmax(axis=1)]
        registers = np.where(filled, registers, registers[source])
    return registers


def corrected(equal: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers and the set sizes."""
    ratio = left / right
    chance = CHANCE * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA)
    return (equal - chance) / (1 - chance)


def fits(percent: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * np.minimum(left, right) >= percent * np.maximum(left, right)


def least_estimate(percent: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What a pair at the threshold stays above: five standard deviations."""
    threshold = percent / 100
    registers = np.minimum(BUCKETS, np.maximum(left, right))
    return threshold - 5 * np.sqrt(threshold * (1 - threshold) / registers)


def _sketches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, text="text"):
        sets = find_words(batch.column("text"), lower=True).shingles(length)
        digests = [xxhash.xxh3_128_digest(one.tobytes()) if len(one) else None for one in sets]
        rows = [sketch(one).tobytes() if len(one) else None for one in sets]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n_shingles": pa.array([len(one) for one in sets], pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "sketch": pa.array(rows, pa.binary()),
            }
        )


def _registers(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), BUCKETS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key per band; the four registers of a band make up 64 bits."""
    bands = np.ascontiguousarray(registers).view(np.uint64)
    return mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 4096):
        keys = band_keys(_registers(batch.column("sketch").to_pylist()))
        yield pa.record_batch(
            {
                "key": pa.array(keys.view(np.int64).ravel()),
                "id": pa.array(np.repeat(batch.column("id").to_numpy(), BANDS)),
            }
        )


def _estimated(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 4096):
        left, right = (_registers(batch.column(name).to_pylist()) for name in ("s_a", "s_b"))
        n_a, n_b = (batch.column(name).to_numpy() for name in ("n_a", "n_b"))
        score = corrected((left == right).mean(axis=1), n_a, n_b)
        near = fits(percent, n_a, n_b) & (score >= least_estimate(percent, n_a, n_b))
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(
    batches: Iterator[pa.RecordBatch], length: int, percent: int
) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256, text="t_b"):
        # A leader's text comes many times in a row; its set is made once. The
        # words of both sides are numbered together, by their bytes.
        both = pa.concat_arrays([batch.column("t_a"), batch.column("t_b")]).dictionary_encode()
        sets = find_words(both.dictionary, lower=True).numbered_shingles(length)
        at = both.indices.to_pylist()
        pairs = zip(at[: batch.num_rows], at[batch.num_rows :], strict=True)
        keep = [_reaches(sets[x], sets[y], percent) for x, y in pairs]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _whole_groups(
    batches: Iterator[pa.RecordBatch], rows: int = 16384
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Runs of whole groups of a partition sorted by group, with their starts."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(part.num_rows for part in waiting) < rows:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        starts = _starts(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts[:-1]
            waiting = table.slice(starts[-1]).to_batches()
    if waiting:
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield table, _starts(table)


def _starts(table: pa.Table) -> np.ndarray:
    new = np.ones(table.num_rows, bool)
    group = np.stack([table.column(name).to_numpy() for name in GROUP])
    new[1:] = (group[:, 1:] != group[:, :-1]).any(axis=0)
    return np.flatnonzero(new)


def _across(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Bundles of candidate pairs of different components, block by block.

    A pair belongs to the first band its sketches share, and pairs with the
    bucket's smallest member were tried before.
    """
    for table, starts in _whole_groups(batches):
        registers = _registers(table.column("sketch").to_pylist())
        keys = band_keys(registers)
        here = keys == table.column("key").to_numpy().view(np.uint64)[:, None]
        here = here.argmax(axis=1)
        ids, label, sizes, side, leader = (
            table.column(name).to_numpy()
            for name in ("id", "component", "n_shingles", "side", "leader")
        )
        counts = np.diff(np.append(starts, len(ids)))
        partners = np.repeat(starts + counts, counts) - np.arange(len(ids)) - 1
        partners[ids == leader] = 0
        before = np.cumsum(partners) - partners
        cuts = np.searchsorted(before, np.arange(0, partners.sum() + 1, PAIRS))
        found = [np.empty((2, 0), np.int64)]
        for first, last in zip(cuts, np.append(cuts[1:], len(ids)), strict=True):
            each = partners[first:last]
            left = np.repeat(np.arange(first, last), each)
            offset = np.arange(len(left)) - np.repeat(before[first:last] - before[first], each)
            right = left + 1 + offset
            use = (label[left] != label[right]) & (ids[left] != ids[right])
            use &= (ids[right] != leader[right]) & fits(percent, sizes[left], sizes[right])
            use &= (side[left] == 0) | (side[left] != side[right])
            left, right = left[use], right[use]
            use = (keys[left] == keys[right]).argmax(axis=1) == here[left]
            left, right = left[use], right[use]
            equal = (registers[left] == registers[right]).mean(axis=1)
            use = corrected(equal, sizes[left], sizes[right]) >= least_estimate(
                percent, sizes[left], sizes[right]
            )
            found.append(np.stack([left[use], right[use]]))
        left, right = np.concatenate(found, axis=1)
        group = starts.searchsorted(left, "right") - 1
        weight = np.bincount(group, sizes[left] + sizes[right], len(starts)).cumsum()
        bundle = (weight // BUNDLE)[group]
        for number in np.unique(bundle):
            chosen = bundle == number
            at = starts[group[chosen][0]]
            yield pa.record_batch(
                {
                    **{name: table.column(name).slice(at, 1).combine_chunks() for name in GROUP},
                    "a": pa.array([ids[left[chosen]]], pa.list_(pa.int64())),
                    "b": pa.array([ids[right[chosen]]], pa.list_(pa.int64())),
                }
            )


def _confirmed_bundle(
    pairs: pa.Table, texts: pa.Table, length: int, percent: int
) -> pa.Table:
    """The links among the pairs of a bundle, on the full sets of its texts."""
    names, sets = texts.column("id").to_pylist(), {}
    column = texts.column("text").combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    found = find_words(column, lower=True).numbered_shingles(length)
    for name, one in zip(names, found, strict=True):
        sets.setdefault(name, []).append(one)
    kept = [
        (a, b)
        for row in pairs.select(["a", "b"]).to_pylist()
        for a, b in zip(row["a"], row["b"], strict=True)
        if any(_reaches(x, y, percent) for x in sets.get(a, ()) for y in sets.get(b, ()))
    ]
    return pa.table(
        {
            "a": pa.array([pair[0] for pair in kept], pa.int64()),
            "b": pa.array([pair[1] for pair in kept], pa.int64()),
        }
    )


def _mixed_pairs(
    members: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int
) -> DataFrame:
    """Bundles of candidate pairs of buckets with members in several components."""
    labelled = members.join(labels, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    mixed = (
        labelled.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min("id").alias("leader"),
            F.count(F.lit(1)).alias("size"),
        )
        .where("low < high and size > 2")
        .select("key", "leader", F.ceil(F.col("size") / (BLOCK // 2)).alias("blocks"))
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = (
        labelled.join(mixed, "key")
        .withColumn("own", block)
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .withColumn(
            "side", F.when(F.expr("low = high"), 0).when(F.expr("own = low"), -1).otherwise(1)
        )
        .join(nodes, "id")
        .select("key", "low", "high", "side", "leader", "id", "component", "n_shingles", "sketch")
    )
    return (
        dealt.repartition(*GROUP)
        .sortWithinPartitions(*GROUP)
        .mapInArrow(
            partial(_across, percent=percent),
            "key long, low long, high long, a array<long>, b array<long>",
        )
    )


def near_duplicates(
    docs: DataFrame, *, words: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``docs`` has doc_id (long) and text (string); other columns are ignored.
    Words are lower-cased in A-Z. Two documents are linked if the sets of their
    distinct ``words``-word shingles have a Jaccard similarity of at least
    ``percent`` / 100; a text of fewer words is one shingle. component_id is the
    smallest doc_id reachable over links, and a row is kept if that is its own.

    A null, empty or blank text has no shingles and no links. Rows that share a
    doc_id are one document, which is linked through each of its texts. Rows
    without doc_id are linked with nothing, get no component and are kept.
    """
    texts = docs.select("doc_id", "text")
    sketches = stage(
        texts.mapInArrow(
            partial(_sketches, length=words),
            "doc_id long, n_shingles long, digest binary, sketch binary",
        ),
        "sketches",
    )
    known = sketches.where("doc_id is not null and n_shingles > 0")
    nodes = stage(
        known.groupBy("digest").agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    classes = nodes.select("digest", "id")
    bands = nodes.mapInArrow(_bands, "key long, id long")
    leaders = (
        bands.groupBy("key")
        .agg(F.min("id").alias("leader"), F.max("id").alias("last"))
        .where("leader < last")
        .select("key", "leader")
    )
    members = stage(bands.join(leaders, "key").select("key", "id", "leader"), "members")
    # Whole texts of the candidates, shuffled once for all rounds.
    candidates = stage(
        texts.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"),
        "candidates",
    )

    def confirm(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            text = candidates.select(
                F.col("doc_id").alias(side), F.col("text").alias(f"t_{side}")
            ).where(f"t_{side} is not null")
            pairs = pairs.join(text, side)
        return pairs.select("a", "t_a", "b", "t_b").mapInArrow(
            partial(_confirmed, length=words, percent=percent), "a long, b long"
        )

    def near(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            of = nodes.select(
                F.col("id").alias(side),
                F.col("n_shingles").alias(f"n_{side}"),
                F.col("sketch").alias(f"s_{side}"),
            )
            pairs = pairs.join(of, side)
        return pairs.mapInArrow(partial(_estimated, percent=percent), "a long, b long").distinct()

    stars = members.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    own = known.join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    several = known.groupBy("doc_id").agg(
        F.min("digest").alias("low"), F.max("digest").alias("high")
    )
    several = several.where("low < high").select(F.col("doc_id").alias("a"))
    of_several = own.join(several, "a", "left_semi").where("a != b").distinct()
    links = stage(confirm(near(stars.distinct())).union(of_several), "links")
    labels = components(links)
    bundles = stage(_mixed_pairs(members.select("key", "id"), nodes, labels, percent), "bundles")
    texts_of = [F.col(name).alias(f"of_{name}") for name in GROUP]
    wanted = bundles.select(*texts_of, F.explode(F.expr("array_union(a, b)")).alias("id"))
    fetched = wanted.join(candidates.withColumnRenamed("doc_id", "id"), "id")
    more = stage(
        bundles.groupBy(*GROUP)
        .cogroup(fetched.where("text is not null").groupBy(*[f"of_{name}" for name in GROUP]))
        .applyInArrow(
            lambda pairs, texts: _confirmed_bundle(pairs, texts, words, percent),
            "a long, b long",
        ),
        "links",
    )
    if not more.isEmpty():
        labels = components(links.union(more))
    reached = classes.join(labels, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component_id")
    )
    digest = F.when(F.col("doc_id").isNotNull(), F.col("digest"))
    component = F.coalesce("component_id", "doc_id")
    return sketches.select("doc_id", "n_shingles", digest.alias("digest")).join(reached, "digest", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
