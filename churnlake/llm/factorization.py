"""Text classifiers by factorization machines over hashed features.

A text's features are the words, cut at anything but letters, and their
prefixes, hashed to ``HASH_BITS`` bits; with ``structure`` also how the text is
built (case, symbols, repetition, line and word lengths) and its length, each
cut into bins, and the numeric ``metadata`` columns that are named, in bins too.
The score is a sigmoid of a bias, a weight per feature and the
interaction of every two features, the product of their factors. With sums over
a text's features s, all interactions are (s**2 - sum of squares) / 2, so a text
costs time linear in its features.

Training takes at most ``sample`` labelled documents, those of the smallest hash
of doc_id, with at most ``cells`` features together. It runs in one task, as both
bounds fit there. Which features enter is decided without the labels, by the number of rows
they are in, so that those which matter only together are there; weights and
factors that do not help are shrunk to zero during the fit. The model has a
bounded size; every text is scored in a pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.words import find_words, mix, pieces
from churnlake.scratch import stage

HASH_BITS = 22
FEATURES = 1 << 18
FACTORS = 8
SAMPLE = 10_000
CELLS = 1 << 24
STEPS, BATCH = 1200, 128
# Of weights and factors: the step, the squared slope a sum starts with, which
# keeps a feature of few rows from large steps, and the pull to zero.
WEIGHT_STEP, FACTOR_STEP = 3.0, 0.2
PAST = 1e-4
WEIGHT_PULL, FACTOR_PULL = 3e-5, 3e-5
PREFIXES = (4, 5, 6)

# Everything but letters; bytes above 127 belong to letters outside ASCII.
_APART = np.ones(256, bool)
_APART[65:91] = _APART[97:123] = _APART[128:] = False

_UPPER, _DIGIT, _SYMBOL, _STOP, _LINE, _BYTE = range(6)
_KINDS = np.zeros((6, 256), bool)
_KINDS[_UPPER, 65:91] = True
_KINDS[_DIGIT, 48:58] = True
_KINDS[_SYMBOL, [ord(c) for c in "#*$%&|<>{}[]\\^~=+_@"]] = True
_KINDS[_STOP, [ord(c) for c in ".,;:!?"]] = True
_KINDS[_LINE, 10] = True
_KINDS[_BYTE] = True


@dataclass
class Machine:
    """``place`` maps a hashed feature to its row in ``weights`` and ``factors``,
    or -1; ``whole`` marks the features that count 1, as those of structure do.
    The others of a text share a length of 1."""

    bias: float
    place: np.ndarray
    whole: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def packed(self) -> dict[str, float | bytes]:
        """The machine without its places that no feature has; ``unpack`` undoes it."""
        return {
            "bias": self.bias,
            "chosen": np.flatnonzero(self.place >= 0).astype(np.uint32).tobytes(),
            "whole": self.whole.tobytes(),
            "weights": self.weights.astype(np.float32).tobytes(),
            "factors": self.factors.astype(np.float32).tobytes(),
        }

    @staticmethod
    def unpack(packed: dict[str, float | bytes]) -> Machine:
        chosen = np.frombuffer(packed["chosen"], np.uint32)
        place = np.full(1 << HASH_BITS, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        weights, factors = (np.frombuffer(packed[name], np.float32) for name in ("weights", "factors"))
        whole = np.frombuffer(packed["whole"], bool)
        return Machine(packed["bias"], place, whole, weights, factors.reshape(-1, FACTORS))

    def scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        at = self.place[features] if len(self.weights) else np.full(len(features), -1)
        rows, at = rows[at >= 0], at[at >= 0]
        values = feature_values(rows, self.whole[at], len(first) - 1)
        margins, _ = _margins(rows, at, values, len(first) - 1, self.weights, self.factors)
        return sigmoid(self.bias + margins)


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def feature_values(rows: np.ndarray, whole: np.ndarray, size: int) -> np.ndarray:
    scale = 1 / np.sqrt(np.bincount(rows, ~whole, size) + 1)
    return np.where(whole, 1.0, scale[rows])


def _margins(rows, at, values, size, weights, factors):
    """Scores without bias, and the sums of the rows' factors."""
    total = np.bincount(rows, weights[at] * values, size).astype(np.float64)
    sums = np.empty((factors.shape[1], size))
    for f, column in enumerate(factors.T):
        part = column[at] * values
        sums[f] = np.bincount(rows, part, size)
        total += (sums[f] ** 2 - np.bincount(rows, part * part, size)) / 2
    return total, sums


def _distinct_rows(rows: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row in order, and where each row starts."""
    key = np.sort((rows.astype(np.uint64) << np.uint64(32)) | values)
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    first = np.searchsorted(key, np.arange(size + 1, dtype=np.uint64) << np.uint64(32))
    return key & np.uint64(0xFFFFFFFF), first


def _hashed(values: np.ndarray) -> np.ndarray:
    return mix(values) >> np.uint64(64 - HASH_BITS)


def _binned(number: int, values: np.ndarray, edges: tuple[float, ...]) -> np.ndarray:
    bins = np.searchsorted(edges, values, "right") + 100 * (number + 1)
    return _hashed(mix(bins.astype(np.uint64)))


def structure_features() -> np.ndarray:
    """Every feature that ``_structure`` can give."""
    numbers = np.arange(100, 100 * 64, dtype=np.uint64)
    return _hashed(mix(numbers))


_SHARES = (0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
# Bin number of the first metadata column; below it are the statistics.
_METADATA = 40
_LENGTHS = (1, 5, 20, 50, 100, 200, 400, 800, 1600, 3200, 6400, 12800)


def _structure(column: pa.Array, words) -> list[np.ndarray]:
    """One binned feature per text and statistic."""
    size = len(column)
    texts = column.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + size + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    data, bounds = data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)
    counts = [
        np.diff(np.searchsorted(np.flatnonzero(kind[data]), bounds)) for kind in _KINDS[:_BYTE]
    ]
    n_bytes, n_words = np.diff(bounds), np.diff(words.first)
    some = np.maximum(n_bytes, 1)
    rows = words.rows()
    many = np.maximum(n_words, 1)
    again = np.zeros(len(rows), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (rows[1:] == rows[:-1])
    short = words.hashes >> np.uint64(32)
    _, one = _distinct_rows(rows, short, size)
    inside = np.arange(len(rows)) + 3 <= words.first[1:][rows]
    _, three = _distinct_rows(rows[inside], words.sequences(3)[inside] >> np.uint64(32), size)
    windows = np.maximum(n_words - 2, 1)
    shares = [
        *(count / some for count in counts),
        np.bincount(rows, again, size) / many,
        np.diff(one) / many,
        np.diff(three) / windows,
    ]
    lengths = [n_words, n_bytes / 8, n_bytes / (counts[_LINE] + 1) / 4, 4 * n_bytes / many]
    found = [_binned(n, share, _SHARES) for n, share in enumerate(shares)]
    return found + [_binned(50 + n, length, _LENGTHS) for n, length in enumerate(lengths)]


def text_features(
    column: pa.Array, structure: bool, metadata: list[pa.Array] = ()
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text, and where each text's start."""
    heads = () if structure else PREFIXES
    words = find_words(column, lower=True, apart=_APART, heads=heads, rolling=True)
    rows = words.rows()
    features, owners = [_hashed(words.hashes)], [rows]
    for length, prefix in words.heads.items() if not structure else ():
        long = (words.ends - words.starts) > length
        features.append(_hashed(prefix[long] + np.uint64(length)))
        owners.append(rows[long])
    if structure:
        for feature in _structure(column, find_words(column, rolling=True)):
            features.append(feature)
            owners.append(np.arange(len(column)))
    for number, values in enumerate(metadata):
        # Null and what is no number have a bin of their own, below that of 0.
        known = values.cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
        known = np.where(np.isfinite(known), known, -1)
        features.append(_binned(_METADATA + number, known, (0, *_LENGTHS)))
        owners.append(np.arange(len(column)))
    return _distinct_rows(np.concatenate(owners), np.concatenate(features), len(column))


def train(
    features: np.ndarray,
    first: np.ndarray,
    labels: np.ndarray,
    *,
    structure: bool = False,
    seed: int = 3,
) -> Machine:
    """Fit a machine to rows of features by AdaGrad on the logistic loss.

    All features in a few rows enter, of more than ``FEATURES`` those in most
    rows. A weight, and a feature's factors as a group, are pulled to zero.
    Without rows of both labels the score is the smoothed share of label 1.
    """
    size, place = len(labels), np.full(1 << HASH_BITS, -1, np.int32)
    share = (labels.sum() + 0.5) / (size + 1)
    bias = float(np.log(share / (1 - share)))
    # The task holds the features of all rows, four bytes each, a few times.
    seen = np.zeros(1 << HASH_BITS, np.int32)
    for low in range(0, len(features), 1 << 20):
        np.add.at(seen, features[low : low + (1 << 20)], 1)
    useful = np.flatnonzero(seen >= min(4, max(2, size // 100)))
    chosen = np.sort(useful[np.lexsort((useful, -seen[useful]))][:FEATURES])
    place[chosen] = np.arange(len(chosen))
    random = np.random.Generator(np.random.PCG64(seed))
    weights = np.zeros(len(chosen))
    factors = random.normal(0, 0.05, (len(chosen), FACTORS))
    whole = np.isin(chosen, structure_features()) & structure
    machine = Machine(bias, place, whole, weights, factors)
    if not 0 < labels.sum() < size or not len(chosen):
        return Machine(bias, place, whole[:0], weights[:0], factors[:0])
    at = place[features]
    used = at >= 0
    starts = np.append(0, np.cumsum(used, dtype=np.int32))[first]
    at = at[used]
    del used
    past, past_factors, past_bias = np.full(len(chosen), PAST), np.full(factors.shape, PAST), 1e-6
    slot = np.empty(len(chosen), np.int64)
    order = np.empty(0, np.int64)
    for _ in range(STEPS):
        if len(order) < BATCH:
            order = np.append(order, random.permutation(size))
        batch, order = order[:BATCH], order[BATCH:]
        each = starts[batch + 1] - starts[batch]
        local = np.repeat(np.arange(len(batch)), each)
        index = np.repeat(starts[batch] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        own = at[index]
        value = feature_values(local, whole[own], len(batch))
        touched = np.flatnonzero(np.bincount(own, minlength=len(chosen)))
        slot[touched] = np.arange(len(touched))
        own = slot[own]
        weight, factor = weights[touched], factors[touched]
        margin, sums = _margins(local, own, value, len(batch), weight, factor)
        error = (sigmoid(machine.bias + margin) - labels[batch]) / len(batch)
        step = error.sum()
        past_bias += step * step
        machine.bias -= 0.2 * step / np.sqrt(past_bias)
        pull = error[local] * value
        slope = np.bincount(own, pull, len(touched)) + 1e-6 * weight
        past[touched] += slope * slope
        rate = WEIGHT_STEP / np.sqrt(past[touched])
        weight = weight - rate * slope
        weights[touched] = np.sign(weight) * np.maximum(np.abs(weight) - WEIGHT_PULL * rate, 0)
        slopes = 1e-5 * factor
        for f, column in enumerate(factor.T):
            rest = sums[f][local] - column[own] * value
            slopes[:, f] += np.bincount(own, pull * rest, len(touched))
        past_factors[touched] += slopes * slopes
        factor = factor - FACTOR_STEP * slopes / np.sqrt(past_factors[touched])
        rate = FACTOR_STEP / np.sqrt(past_factors[touched].mean(axis=1))
        length = np.sqrt((factor * factor).sum(axis=1))
        left = np.maximum(1 - FACTOR_PULL * rate / np.maximum(length, 1e-12), 0)
        factors[touched] = factor * left[:, None]
    return machine


def _columns(batch: pa.RecordBatch, metadata: tuple[str, ...]) -> list[pa.Array]:
    return [batch.column(name) for name in metadata]


def _featured(
    batches: Iterator[pa.RecordBatch], structure: bool, metadata: tuple[str, ...]
) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, text="_text"):
        given = _columns(batch, metadata)
        features, first = text_features(batch.column("_text"), structure, given)
        features = features.astype(np.uint32)
        rows = [features[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "label": batch.column("_label"),
                "size": pa.array(np.diff(first), pa.int64()),
                "features": pa.array(rows, pa.binary()),
            }
        )


def _trained(batches: Iterator[pa.RecordBatch], structure: bool) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("label", "features"))
        rows += zip(*columns, strict=True)
    # In an order that does not depend on how the rows arrived.
    rows.sort()
    labels = np.array([label for label, _ in rows], np.float64)
    first = np.cumsum([0, *(len(features) // 4 for _, features in rows)])
    features = np.frombuffer(b"".join(features for _, features in rows), np.uint32)
    del rows
    machine = train(features, first, labels, structure=structure)
    yield pa.RecordBatch.from_pylist([machine.packed()])


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    *,
    structure: bool,
    metadata: tuple[str, ...] = (),
    sample: int = SAMPLE,
    cells: int = CELLS,
) -> DataFrame:
    """(doc_id, label, size, features) of the documents to learn from, one row per
    doc_id: at most ``sample`` of them, with at most ``cells`` features together.

    Null labels and ids are left out; of several labels of a doc_id the largest
    counts, of several texts that of the smallest hash. A document with more than
    a sixteenth of ``cells`` is not learned from.
    """
    known = (
        labels.where("label is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("_label"))
    )
    # Only about twice as many as are needed are sorted.
    share = min(1.0, (2 * sample + 1000) / max(known.count(), 1))
    chance = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 20))
    known = (
        known.where(chance < int(share * (1 << 20)) + 1)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers.
    given = [f"_given{number}" for number in range(len(metadata))]
    values = [F.col(name).alias(own) for name, own in zip(metadata, given, strict=True)]
    one = F.struct(F.xxhash64("_text"), "_text", *given)
    rows = (
        docs.select("doc_id", F.col("text").alias("_text"), *values)
        .join(F.broadcast(known), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(one).alias("_one"), F.first("_label").alias("_label"))
        .select("doc_id", "_label", "_one._text", *[f"_one.{name}" for name in given])
    )
    featured = stage(
        rows.mapInArrow(
            partial(_featured, structure=structure, metadata=tuple(given)),
            "doc_id long, label int, size long, features binary",
        ),
        "labelled",
    )
    # One row of two numbers per document of the sample, in one task.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    fitting = featured.where(F.col("size") <= cells // 16).select(
        "doc_id", F.sum("size").over(order).alias("_total")
    )
    return featured.join(
        F.broadcast(fitting.where(F.col("_total") <= cells).select("doc_id")), "doc_id", "left_semi"
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    structure: bool,
    metadata: tuple[str, ...] = (),
    sample: int = SAMPLE,
    cells: int = CELLS,
) -> Machine:
    """A machine fitted to ``docs`` (doc_id long, text, metadata) by ``labels``
    (doc_id, label), of which ``labelled_sample`` tells the bounds.

    It is fitted in one task; the driver gets the machine alone, of at most
    ``FEATURES`` rows.
    """
    chosen = labelled_sample(
        docs, labels, structure=structure, metadata=metadata, sample=sample, cells=cells
    )
    packed = (
        chosen.select("label", "features")
        .repartition(1)
        .mapInArrow(
            partial(_trained, structure=structure or bool(metadata)),
            "bias double, chosen binary, whole binary, weights binary, factors binary",
        )
        .first()
    )
    if packed is None:
        none = np.empty(0, np.uint32)
        return train(none, np.zeros(1, np.int64), np.empty(0), structure=structure)
    return Machine.unpack(packed.asDict())


def score(
    docs: DataFrame, machine: Machine, *, structure: bool, metadata: tuple[str, ...] = ()
) -> DataFrame:
    """(doc, score), one row per row of ``docs``; ``doc`` is the whole row.

    A null or empty text has no words and gets the score of that; a null in a
    metadata column counts as a value of its own.
    """
    # Of bounded size: FEATURES rows of a few numbers.
    shared = docs.sparkSession.sparkContext.broadcast(machine.packed())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine.unpack(shared.value)
        for batch in batches:
            for part in pieces([batch.append_column("_t", batch.column("doc").field("text"))], text="_t"):
                given = [part.column("doc").field(name) for name in metadata]
                features, first = text_features(part.column("_t"), structure, given)
                values = model.scores(features.astype(np.int64), first)
                yield pa.record_batch({"doc": part.column("doc"), "score": pa.array(values)})

    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    return rows.mapInArrow(scored, f"doc {rows.schema['doc'].dataType.simpleString()}, score double")
