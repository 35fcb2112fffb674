"""Divergence of sources by hash-consed segment trees over term ids.

The kept terms of a language are numbered from the most frequent on, so that
rare terms, whose counts are alike in most sources, lie together. A source is a
segment tree over the numbers with its counts as leaves. Trees are hash-consed:
nodes of one level with equal children are one node, whatever source or place
they come from. To price two sources both trees are gone through at once from the
roots, every pair of nodes is taken once however often it occurs, and prices are
added up on the way back.

A segment of ``SEGMENT`` numbers is a subtree of its own. A task gets one segment
of one language with up to ``BLOCK`` sources on either side; the levels above the
segments are a sum in Spark. So no task depends on how many rows, terms or
sources a language has. Sums and shares are exact integers.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.term_counts import TERMS, find_runs
from churnlake.operators.keys import dense_key
from churnlake.scratch import stage

SEGMENT = 4096
BLOCK = 128
# Pairs of nodes of a level that are priced at once.
CELLS = 1 << 21
LEAST_DOCUMENTS = 10
LISTED = 10

# Fixed value of the measure: shares are counted in parts of this.
PARTS = 1_000_000_000

# Bytes of terms: A-Z, a-z and whatever belongs to a character outside ASCII.
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")

# The source that stands for its whole language.
_WHOLE = -1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source."""

    def give() -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in groups.items():
            terms = list(occurrences)
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * len(terms), pa.string()),
                    "source": pa.array([source] * len(terms), pa.string()),
                    "term": pa.array(terms, pa.binary()).cast(pa.string()),
                    "n": pa.array([occurrences[term] for term in terms], pa.int64()),
                    "docs": pa.array([documents[term] for term in terms], pa.int64()),
                }
            )

    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("lang", "source"))
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(*columns, texts, strict=True):
            occurrences, documents = groups.setdefault((lang, source), (Counter(), Counter()))
            own = set()
            for terms in find_runs(_TERM, text.as_py().lower()):
                occurrences.update(terms)
                own.update(terms)
            documents.update(own)
        if sum(len(occurrences) for occurrences, _ in groups.values()) > TERMS:
            yield from give()
            groups = {}
    yield from give()


def part(count: int, total: int, terms: int) -> int:
    return 1 + PARTS * (count + 2) // (total + 2 * terms)


def distance(p: int, q: int) -> int:
    return (p - q) * (p - q) // (p + q)


def grow(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(root of each row, children of the nodes by level from the top, counts of
    the leaf nodes) of hash-consed trees over the rows of a table of counts, whose
    width is a power of two."""
    leaves, inverse = np.unique(counts, return_inverse=True)
    nodes = inverse.reshape(counts.shape).astype(np.int64)
    levels, size = [], len(leaves)
    while nodes.shape[1] > 1:
        keys, inverse = np.unique(nodes[:, ::2] * size + nodes[:, 1::2], return_inverse=True)
        levels.append((keys // size, keys % size))
        nodes = inverse.reshape(len(nodes), -1).astype(np.int64)
        size = len(keys)
    return nodes[:, 0], levels[::-1], leaves


def price_pairs(
    roots: np.ndarray,
    levels: list[tuple[np.ndarray, np.ndarray]],
    leaves: np.ndarray,
    scales: np.ndarray,
    left: np.ndarray,
    right: np.ndarray,
    prices,
) -> np.ndarray:
    """The prices of the pairs of rows ``left[i]``, ``right[i]``.

    Nodes stand for counts only; what a count is worth depends on the row, of which
    ``scales`` is the kind. So a pair of nodes is priced once for each pair of
    kinds. ``prices`` gives the prices of pairs of leaf counts of two kinds.
    """
    kinds, of_row = np.unique(scales, return_inverse=True)
    combined, group = np.unique(of_row[left] * len(kinds) + of_row[right], return_inverse=True)
    first, second = roots[left], roots[right]
    back = []
    # Down: the distinct (kinds, node, node) of each level, and where each came from.
    for lefts, rights in [*levels, (None, None)]:
        width = max(int(first.max()), int(second.max())) + 1
        keys, inverse = np.unique((group * width + first) * width + second, return_inverse=True)
        back.append(inverse)
        group, first, second = keys // width // width, keys // width % width, keys % width
        if lefts is None:
            break
        group = np.concatenate([group, group])
        first = np.concatenate([lefts[first], rights[first]])
        second = np.concatenate([lefts[second], rights[second]])
    kind = combined[group]
    values = prices(leaves[first], leaves[second], kinds[kind // len(kinds)], kinds[kind % len(kinds)])
    # Up: a node costs what its two children cost.
    for inverse in back[:0:-1]:
        values = values[inverse]
        half = len(values) // 2
        values = values[:half] + values[half:]
    return values[back[0]]


def _leaf_prices(terms: int):
    def prices(x: np.ndarray, y: np.ndarray, total_x: np.ndarray, total_y: np.ndarray) -> np.ndarray:
        if max(x.max(), y.max()) + 2 > np.iinfo(np.int64).max // PARTS:
            # A count times PARTS does not fit in 64 bits: Python's integers.
            x, y = x.astype(object), y.astype(object)
        return distance(part(x, total_x, terms), part(y, total_y, terms)).astype(np.int64)

    return prices


def _largest(
    root: int,
    whole: int,
    levels: list[tuple[np.ndarray, np.ndarray]],
    value,
    memo: list[dict[tuple[int, int], int]],
    listed: int,
) -> list[tuple[int, int]]:
    """(value, place) of the leaves of the largest positive values of a tree beside
    that of its language, and of all others that equal the last of them."""

    def bound(level: int, a: int, b: int) -> int:
        known = memo[level].get((a, b))
        if known is None:
            if level == len(levels):
                known = value(a, b)
            else:
                lefts, rights = levels[level]
                known = max(
                    bound(level + 1, int(lefts[a]), int(lefts[b])),
                    bound(level + 1, int(rights[a]), int(rights[b])),
                )
            memo[level][a, b] = known
        return known

    waiting = [(-bound(0, root, whole), 0, 0, root, whole)]
    found: list[tuple[int, int]] = []
    while waiting:
        least, level, place, a, b = heapq.heappop(waiting)
        if least > -1 or (len(found) >= listed and -least < found[listed - 1][0]):
            break
        if level == len(levels):
            found.append((-least, place))
            continue
        for side, children in enumerate(levels[level]):
            pair = int(children[a]), int(children[b])
            heapq.heappush(
                waiting, (-bound(level + 1, *pair), level + 1, 2 * place + side, *pair)
            )
    return found


def _segment(table: pa.Table, listed: int) -> pa.Table:
    """Partial sums of the pairs of sources of one block pair, and the candidates
    of the list of terms where the block is paired with itself."""
    rows = table.to_pylist()
    low, high, terms = rows[0]["low"], rows[0]["high"], rows[0]["terms"]
    counts = np.zeros((len(rows), SEGMENT), np.int64)
    for number, row in enumerate(rows):
        counts[number, np.array(row["places"], np.int64)] = row["counts"]
    # Numbers beyond the last term are no terms; the tree ends at a power of two.
    size = min(SEGMENT, max(0, terms - rows[0]["segment"] * SEGMENT))
    sources = np.array([row["number"] for row in rows])
    blocks = np.array([row["own"] for row in rows])
    totals = np.array([row["total"] for row in rows])
    out: list[tuple] = []
    one, two = np.triu_indices(len(rows), 1)
    pick = (sources[one] != _WHOLE) & (sources[two] != _WHOLE)
    pick &= (np.minimum(blocks[one], blocks[two]) == low) & (np.maximum(blocks[one], blocks[two]) == high)
    one, two = one[pick], two[pick]
    sums = np.zeros(len(one), np.int64)
    at_once = max(1, CELLS // SEGMENT)
    # A segment that is not full is a few smaller trees, of powers of two.
    start = 0
    while start < size:
        width = 1 << ((size - start).bit_length() - 1)
        roots, levels, leaves = grow(counts[:, start : start + width])
        for low_pair in range(0, len(one), at_once):
            some = slice(low_pair, low_pair + at_once)
            sums[some] += price_pairs(
                roots, levels, leaves, totals, one[some], two[some], _leaf_prices(terms)
            )
        if low == high:
            at = int(np.flatnonzero(sources == _WHOLE)[0])
            for number, row in enumerate(rows):
                if number == at:
                    continue

                def value(a: int, b: int, total=row["total"]) -> int:
                    p = part(int(leaves[a]), total, terms)
                    q = part(int(leaves[b]), rows[at]["total"], terms)
                    return distance(p, q) if leaves[a] > 0 and p > q else -1

                memo = [{} for _ in range(len(levels) + 1)]
                for price, place in _largest(int(roots[number]), int(roots[at]), levels, value, memo, listed):
                    place += start + rows[0]["segment"] * SEGMENT
                    out.append((row["source"], None, place, price))
        start += width
    for a, b, price in zip(one.tolist(), two.tolist(), sums.tolist(), strict=True):
        names = rows[a]["source"], rows[b]["source"]
        out += [(*names, None, int(price)), (*names[::-1], None, int(price))]
    columns = list(zip(*out, strict=True)) or [[]] * 4
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.table(
        [pa.array([rows[0]["lang"]] * len(out), pa.string()), *arrays],
        names=["lang", "source", "other", "place", "value"],
    )


def divergence(
    docs: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, listed: int = LISTED
) -> DataFrame:
    """(lang, source, part, item, value, rank) for each source of each language.

    ``docs`` has text, lang and source (string); other columns are ignored, and
    each row is a document, so repeated rows count as often as they are there.
    Null text, lang and source are ''. Terms are runs of letters of A-Z, a-z and
    characters outside ASCII, lower-cased in A-Z; a language keeps those in at
    least ``least_documents`` documents. Part ``pair``: every other source of the
    language with the summed distance of all kept terms, 0 where none is kept. Part
    ``term``: the ``listed`` terms the source has most beyond its language. Ranks
    order by value downwards, then by item in UTF-8. No rows give no rows.
    """
    given = docs.select(
        *[F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("lang", "source", "text")]
    )
    counted = stage(
        given.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "term-counts",
    )
    kept = (
        counted.groupBy("lang", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents)
        .select("lang", "term", (-F.col("n")).alias("_order"), "n")
    )
    # Dense over all languages, then from 0 in each; the first number of a
    # language is that of a table with one row per language.
    numbered = stage(dense_key(kept, ["lang", "_order", "term"], "number"), "terms")
    langs = numbered.groupBy("lang").agg(
        F.min("number").alias("least"), F.count("*").alias("terms"), F.sum("n").alias("total")
    )
    terms = numbered.join(langs.select("lang", "least"), "lang").select(
        "lang", "term", "n", (F.col("number") - F.col("least")).alias("place")
    )
    terms = stage(terms, "places")
    cells = counted.select("lang", "source", "term", "n").join(
        terms.select("lang", "term", "place"), ["lang", "term"]
    )
    cells = stage(cells.select("lang", "source", "place", "n"), "cells")
    # Each source by a number of its own in its language; -1 is the language.
    names = given.select("lang", "source").distinct()
    numbers = dense_key(names, ["lang", "source"], "number")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = stage(
        numbers.join(totals, ["lang", "source"], "left")
        .join(langs.select("lang", "terms"), "lang", "left")
        .fillna(0, ["total", "terms"]),
        "sources",
    )
    base = sources.groupBy("lang").agg(
        F.min("number").alias("least"), F.count("*").alias("sources"), F.max("terms").alias("terms")
    )
    last = F.greatest(F.lit(0), F.ceil(F.col("terms") / SEGMENT) - 1).cast("long")
    segments = F.explode(F.sequence(F.lit(0).cast("long"), last))
    spread = (
        sources.drop("terms")
        .join(base, "lang")
        .select(
            "lang",
            "source",
            (F.col("number") - F.col("least")).alias("number"),
            "total",
            "terms",
            F.ceil(F.col("sources") / BLOCK).alias("blocks"),
            segments.alias("segment"),
        )
    )
    in_segment = (F.floor(F.col("place") / SEGMENT)).cast("long").alias("segment")
    in_place = (F.col("place") % SEGMENT).cast("int").alias("place")
    listed_cells = F.collect_list(F.struct(in_place, F.col("n")))
    of_sources = (
        cells.groupBy("lang", "source", in_segment).agg(listed_cells.alias("cells"))
    )
    rows = spread.join(of_sources, ["lang", "source", "segment"], "left")
    own = F.floor(F.col("number") / BLOCK).cast("long")
    rows = (
        rows.withColumn("own", own)
        .withColumn("with", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .withColumn("low", F.least("own", "with"))
        .withColumn("high", F.greatest("own", "with"))
    )
    whole = (
        terms.groupBy("lang", in_segment)
        .agg(listed_cells.alias("cells"))
        .join(base.select("lang", "terms", F.ceil(F.col("sources") / BLOCK).alias("blocks")), "lang")
        .join(langs.select("lang", "total"), "lang")
        .withColumn("low", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .selectExpr(
            "lang", "segment", "low", "low as high", "low as own", f"{_WHOLE}L as number",
            "string(null) as source", "total", "terms", "cells",
        )
    )
    shape = [
        "lang", "segment", "low", "high", "own", "number", "source", "total", "terms",
        F.coalesce("cells.place", F.expr("cast(array() as array<int>)")).alias("places"),
        F.coalesce("cells.n", F.expr("cast(array() as array<long>)")).alias("counts"),
    ]
    partial_sums = stage(
        rows.select(*shape)
        .union(whole.select(*shape))
        .groupBy("lang", "segment", "low", "high")
        .applyInArrow(
            lambda table: _segment(table, listed),
            "lang string, source string, other string, place long, value long",
        ),
        "partial-sums",
    )
    pairs = (
        partial_sums.where("other is not null")
        .groupBy("lang", "source", F.col("other").alias("item"))
        .agg(F.sum("value").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    named = (
        partial_sums.where("other is null")
        .join(terms.select("lang", "place", F.col("term").alias("item")), ["lang", "place"])
        .select("lang", "source", F.lit("term").alias("part"), "item", "value")
    )
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [
        found.withColumn("rank", F.row_number().over(order)) for found in (pairs, named)
    ]
    return ranked[0].union(ranked[1].where(F.col("rank") <= listed))
