"""Passages that repeat across documents, by prefix-partitioned suffix trees.

A suffix is a text from some word on. The trees are sparse: a suffix is entered
where its first ``SEED`` words have the smallest hash among the first
``OFFSETS`` places of a window, so every window of ``window`` words holds the
start of one, chosen by the window's own words and alike in every document.

Suffixes are grouped by a prefix. It has ``SEED`` words where that leaves at
most ``GROUP_ROWS`` suffixes; larger groups get the longest prefix on which equal
windows must agree. Prefixes of one document only are left out. A task builds the trees of its groups from the sorted suffixes and the lengths of
the prefixes that neighbours share; the suffixes below an internal node that is
deep enough, and which also agree on the words before them, are the places of a
repeated window.

The groups of the longest prefix may still be large, as for a passage in a third
of all documents, and are dealt out in chunks. Each chunk reduces its windows
to the distinct ones and the smallest document of each; only windows of several
chunks are compared across them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.words import find_words, mix, pieces
from churnlake.scratch import stage

SEED = 8

# Suffixes of a group that one task holds.
GROUP_ROWS = 4096

_INFO = (
    "doc_id long, mark long, digest binary, n_words long, positions array<int>, seeds array<long>"
)
_CONTEXTS = (
    "seed long, longest long, size long, doc_id long, digest binary,"
    " position int, before int, context binary"
)
_SPANS = "doc_id long, digest binary, low int, high int"


def _offsets(window: int) -> int:
    """Places of a window in which its suffix may start."""
    return max(1, min(window // 2, window - SEED + 1))


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _suffixes(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Each document's word sequence digest and the suffixes to enter."""
    offsets = _offsets(window)
    for batch in pieces(batches, text="text"):
        words = find_words(batch.column("text"))
        seeds = words.sequences(SEED)
        digests, positions, hashes = [], [], []
        for low, high in zip(words.first[:-1], words.first[1:], strict=True):
            digests.append(_digest(words.hashes[low:high]))
            own = seeds[low : high - window + offsets]
            if high - low < window:
                own = own[:0]
                chosen = np.empty(0, np.int64)
            else:
                view = np.lib.stride_tricks.sliding_window_view(own, offsets)
                chosen = np.unique(view.argmin(axis=1) + np.arange(len(view)))
            positions.append(chosen.astype(np.int32))
            hashes.append(own[chosen].view(np.int64))
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "mark": batch.column("mark"),
                "digest": pa.array(digests, pa.binary()),
                "n_words": pa.array(np.diff(words.first), pa.int64()),
                "positions": pa.array(positions, pa.list_(pa.int32())),
                "seeds": pa.array(hashes, pa.list_(pa.int64())),
            }
        )


def _contexts(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words around each suffix start that a window over it can reach."""
    offsets = _offsets(window)
    longest = window - offsets + 1
    for batch in pieces(batches, 64, text="text"):
        words = find_words(batch.column("text"))
        last = words.sequences(longest)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        rows = []
        for at, (text, entry) in enumerate(
            zip(texts, batch.select(["doc_id", "digest", "found"]).to_pylist(), strict=True)
        ):
            low, high = words.first[at], words.first[at + 1]
            if _digest(words.hashes[low:high]) != entry["digest"]:
                continue  # another text of the same doc_id
            for one in entry["found"]:
                start = low + one["position"]
                first = max(low, start - offsets + 1)
                stop = min(high, start + window)
                rows.append(
                    (
                        one["seed"],
                        int(last[start].view(np.int64)),
                        one["size"],
                        entry["doc_id"],
                        entry["digest"],
                        one["position"],
                        int(start - first),
                        text[words.starts[first] : words.ends[stop - 1]],
                    )
                )
        columns = list(zip(*rows, strict=True)) or [[]] * 8
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.int32(), pa.binary()]
        names = "seed longest size doc_id digest position before context".split()
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )


def _grid(table: pa.Table, window: int, numbered: bool = False) -> np.ndarray:
    """Words of each context, aligned at the suffix start; 0 is no word.

    Words are hashes, or ``numbered`` by their bytes within the table."""
    offsets = _offsets(window)
    context = table.column("context").combine_chunks()
    if isinstance(context, pa.ChunkedArray):
        context = pa.concat_arrays(context.chunks) if context.num_chunks else pa.array([], pa.binary())
    words = find_words(context)
    grid = np.zeros((table.num_rows, offsets - 1 + window), np.uint64)
    rows = words.rows()
    shift = offsets - 1 - table.column("before").to_numpy().astype(np.int64) - words.first[:-1]
    values = words.ids.astype(np.uint64) + np.uint64(1) if numbered else words.hashes | np.uint64(1)
    grid[rows, np.arange(len(rows)) + shift[rows]] = values
    return grid


def _later(classes: list[np.ndarray], docs: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Whether a valid row's class holds a smaller document."""
    rows = np.flatnonzero(valid)
    order = rows[np.lexsort((docs[rows], *(one[rows] for one in classes)))]
    new = np.ones(len(order), bool)
    new[1:] = np.any([one[order][1:] != one[order][:-1] for one in classes], axis=0)
    least = docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.zeros(len(docs), bool)
    later[order] = docs[order] > least
    return later


def _tree_windows(groups: np.ndarray, grid: np.ndarray, docs: np.ndarray, window: int) -> np.ndarray:
    """(row, offset): the window that starts so many words before the row's
    suffix also lies in a smaller document of the group."""
    offsets = _offsets(window)
    right = grid[:, offsets - 1 :]
    order = np.lexsort((*right.T[::-1], groups))
    ranked, group = right[order], groups[order]
    shared = np.zeros(len(order), np.int64)
    if len(order) > 1:
        equal = (ranked[1:] == ranked[:-1]) & (ranked[1:] != 0)
        depth = np.where(equal.all(axis=1), window, equal.argmin(axis=1))
        shared[1:] = np.where(group[1:] == group[:-1], depth, -1)
    found = np.zeros((len(docs), offsets), bool)
    before, present = np.zeros(len(docs), np.uint64), np.ones(len(docs), bool)
    base = grid.max(initial=0) + np.uint64(1)
    node = np.empty(len(docs), np.int64)
    for offset in range(offsets):
        if offset:
            word = grid[:, offsets - 1 - offset]
            # Numbers of the words before, equal only if all of them are.
            _, before = np.unique(before * base + word, return_inverse=True)
            before, present = before.astype(np.uint64), present & (word != 0)
        depth = window - offset
        node[order] = np.cumsum(shared < depth)
        valid = present & (right[:, depth - 1] != 0)
        found[:, offset] = _later([before, node], docs, valid)
    return found


def _spans(table: pa.Table, found: np.ndarray, window: int) -> pa.Table:
    """The repeated words of each document as spans that do not overlap.

    The windows of one suffix overlap, so their union is one span."""
    rows = np.flatnonzero(found.any(axis=1))
    position = table.column("position").to_numpy()[rows].astype(np.int64)
    low = position - (found.shape[1] - 1 - found[rows, ::-1].argmax(axis=1))
    high = position - found[rows].argmax(axis=1) + window
    texts = table.column("digest").combine_chunks().dictionary_encode()
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    owners = np.stack([table.column("doc_id").to_numpy(), texts.indices.to_numpy()], axis=1)[rows]
    _, owner = np.unique(owners, axis=0, return_inverse=True)
    owner = owner.ravel()
    order = np.lexsort((low, owner))
    # Every owner gets its own range, so that one running maximum serves all.
    apart = owner[order].astype(np.int64) << 32
    low, high = low[order] + apart, np.maximum.accumulate(high[order] + apart)
    new = np.append(True, low[1:] > high[:-1])[: len(low)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(low))[: len(first)] - 1
    taken = table.select(["doc_id", "digest"]).take(pa.array(rows[order[first]]))
    return pa.table(
        {
            "doc_id": taken.column("doc_id"),
            "digest": taken.column("digest"),
            "low": pa.array((low[first] - apart[first]).astype(np.int32)),
            "high": pa.array((high[last] - apart[first]).astype(np.int32)),
        }
    )


def _trees(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The trees of a partition sorted by prefix, some thousand suffixes at a time."""

    def solve(table: pa.Table) -> list[pa.RecordBatch]:
        _, groups = np.unique(table.column("prefix").to_numpy(), return_inverse=True)
        docs = table.column("doc_id").to_numpy()
        found = _tree_windows(groups, _grid(table, window, numbered=True), docs, window)
        return _spans(table, found, window).to_batches()

    waiting: list[pa.RecordBatch] = []
    for batch in pieces(batches, GROUP_ROWS):
        waiting.append(batch)
        table = pa.Table.from_batches(waiting)
        prefix = table.column("prefix").to_numpy()
        border = int(np.searchsorted(prefix, prefix[-1]))
        if table.num_rows >= 2 * GROUP_ROWS and border:
            yield from solve(table.slice(0, border))
            waiting = table.slice(border).to_batches()
    if waiting:
        yield from solve(pa.Table.from_batches(waiting))


def _window_keys(grid: np.ndarray, offset: int, window: int) -> tuple[np.ndarray, ...]:
    """Two hashes of each row's window at the offset, and whether it is there."""
    first = _offsets(window) - 1 - offset
    one, two = np.zeros(len(grid), np.uint64), np.ones(len(grid), np.uint64)
    for column in grid[:, first : first + window].T:
        one = one * np.uint64(0x9E3779B97F4A7C15) + column
        two = two * np.uint64(0xD1342543DE82EF95) + mix(column)
    present = (grid[:, first] != 0) & (grid[:, first + window - 1] != 0)
    return mix(one), mix(two), present


def _chunk_windows(table: pa.Table, window: int) -> pa.Table:
    """The distinct windows of a chunk with the smallest document of each."""
    grid, docs = _grid(table, window), table.column("doc_id").to_numpy()
    parts = []
    for offset in range(_offsets(window)):
        one, two, present = _window_keys(grid, offset, window)
        rows = np.flatnonzero(present)
        order = rows[np.lexsort((docs[rows], two[rows], one[rows]))]
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        parts.append((one[order][new], two[order][new], docs[order][new]))
    one, two, least = (np.concatenate(part) for part in zip(*parts, strict=True))
    size = len(one)
    return pa.table(
        {
            "chunk": pa.array(np.full(size, table.column("chunk")[0].as_py(), np.int64)),
            "one": pa.array(one.view(np.int64)),
            "two": pa.array(two.view(np.int64)),
            "least": pa.array(least),
        }
    )


def _chunk_spans(table: pa.Table, known: pa.Table, window: int) -> pa.Table:
    """The spans of a chunk, given the windows that smaller documents of other
    chunks have."""
    grid, docs = _grid(table, window), table.column("doc_id").to_numpy()
    found = np.zeros((len(docs), _offsets(window)), bool)
    extra = [known.column(name).to_numpy().view(np.uint64) for name in ("one", "two")]
    everyone = np.append(docs, known.column("least").to_numpy())
    for offset in range(found.shape[1]):
        one, two, present = _window_keys(grid, offset, window)
        classes = [np.append(one, extra[0]), np.append(two, extra[1])]
        valid = np.append(present, np.ones(known.num_rows, bool))
        found[:, offset] = _later(classes, everyone, valid)[: len(docs)]
    return _spans(table, found, window)


def repeated_spans(docs: DataFrame, *, window: int = 50) -> DataFrame:
    """(doc_id, mark, digest, copy, spans) of the texts that repeat something.

    ``spans`` are word ranges (low, high) made up of windows of ``window``
    words whose sequence also starts in a document with a smaller doc_id;
    ``copy`` says that a smaller document has the same words throughout, in
    which case everything repeats. ``digest`` tells texts of one doc_id apart, and
    ``mark`` is a hash of the text.
    Texts shorter than a window, null texts and rows without doc_id repeat
    nothing.
    """
    # The mark tells most texts of a doc_id apart, so that each is only joined to
    # what was found in it; the digest decides.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).where(
        "doc_id is not null"
    )
    info = stage(texts.mapInArrow(partial(_suffixes, window=window), _INFO), "suffixes")
    long_enough = info.where(F.col("n_words") >= window)
    firsts = stage(long_enough.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "firsts")
    entered = long_enough.join(firsts, ["digest", "doc_id"], "left_semi").dropDuplicates(
        ["digest", "doc_id"]
    ).select("doc_id", "mark", "digest", F.explode(F.arrays_zip("positions", "seeds")).alias("at"))
    suffixes = entered.select(
        "doc_id",
        "mark",
        "digest",
        F.col("at.positions").alias("position"),
        F.col("at.seeds").alias("seed"),
    )
    # Stored, so that AQE can split a hot seed's side of the join.
    several = stage(
        suffixes.groupBy("seed")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("size"))
        .where("low < high")
        .select("seed", "size"),
        "seeds",
    )
    found = (
        suffixes.join(several, "seed")
        .groupBy("doc_id", "mark", "digest")
        .agg(F.collect_list(F.struct("position", "seed", "size")).alias("found"))
    )
    # Of equal texts of a doc_id one is enough.
    contexts = stage(
        texts.join(found, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark", "text"]).mapInArrow(partial(_contexts, window=window), _CONTEXTS),
        "contexts",
    )
    chosen = ["doc_id", "digest", "position", "before", "context"]
    grouped = contexts.where(F.col("size") <= GROUP_ROWS).select(
        F.col("seed").alias("prefix"), *chosen
    )
    spans = (
        grouped.repartition("prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(partial(_trees, window=window), _SPANS)
    )
    crowded = several.where(F.col("size") > GROUP_ROWS).agg(F.sum("size")).first()[0]
    if crowded:
        # A prefix goes to as many chunks as its seed needs, a chunk takes many.
        stretch = F.floor(F.col("position") / GROUP_ROWS)
        salt = F.pmod(F.xxhash64("doc_id", stretch), F.ceil(F.col("size") / GROUP_ROWS))
        chunks = F.lit(-(-crowded // GROUP_ROWS))
        solid = stage(
            contexts.where(F.col("size") > GROUP_ROWS).select(
                F.pmod(F.xxhash64("longest", salt), chunks).alias("chunk"), *chosen
            ),
            "solid",
        )
        windows = stage(
            solid.groupBy("chunk").applyInArrow(
                lambda table: _chunk_windows(table, window),
                "chunk long, one long, two long, least long",
            ),
            "windows",
        )
        across = (
            windows.groupBy("one", "two")
            .agg(F.min("least").alias("low"), F.max("least").alias("high"))
            .where("low < high")
        )
        known = windows.join(across, ["one", "two"]).where("least > low").select(
            F.col("chunk").alias("of_chunk"),
            "one",
            "two",
            F.col("low").alias("least"),
        )
        spans = spans.union(
            solid.groupBy("chunk")
            .cogroup(known.groupBy("of_chunk"))
            .applyInArrow(lambda table, others: _chunk_spans(table, others, window), _SPANS)
        )
    spans = spans.groupBy("doc_id", "digest").agg(
        F.collect_list(F.struct("low", "high")).alias("spans")
    )
    copies = (
        long_enough.select("digest", "doc_id")
        .distinct()
        .join(firsts.withColumnRenamed("doc_id", "first"), "digest")
        .where("first < doc_id")
        .select("doc_id", "digest", F.lit(True).alias("copy"))
    )
    marks = long_enough.select("doc_id", "digest", "mark").distinct()
    return (
        copies.join(spans, ["doc_id", "digest"], "full")
        .join(marks, ["doc_id", "digest"])
        .select("doc_id", "mark", "digest", F.coalesce("copy", F.lit(False)).alias("copy"), "spans")
    )


def _removed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256):
        column = batch.column("doc").field("text")
        words = find_words(column)
        counts, removed, kept = [], [], []
        texts = column.cast(pa.binary()).to_pylist()
        entries = batch.column("found").to_pylist()
        for at, (text, found) in enumerate(zip(texts, entries, strict=True)):
            digest = _digest(words.hashes[words.first[at] : words.first[at + 1]]) if found else None
            own = (text or b"").split()
            gone = np.zeros(len(own), bool)
            for entry in found or ():
                if entry["digest"] != digest:
                    continue  # what another text of this doc_id repeats
                gone |= entry["copy"]
                for span in entry["spans"] or ():
                    gone[span["low"] : span["high"]] = True
            counts.append(len(own))
            removed.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(own, gone.tolist(), strict=True) if not g))
        yield pa.record_batch(
            {
                "doc": batch.column("doc"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )


def remove_repeats(docs: DataFrame, *, window: int = 50) -> DataFrame:
    """(doc, n_words, n_removed, kept_text), one row per row of ``docs``.

    ``docs`` has doc_id (long) and text (string); ``doc`` is the whole row, so
    other columns pass whatever their names. A word goes if a window of
    ``window`` words covers it whose sequence also starts in a document with a
    smaller doc_id; windows are judged on the input. kept_text joins the other
    words by one space. A null text has no words and an empty kept_text.
    Rows without doc_id stay whole, and so do repeats within one doc_id.

    A doc_id with several texts: each is judged by itself against smaller ones.
    """
    found = (
        repeated_spans(docs, window=window)
        .groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("of_mark"))
        .agg(F.collect_list(F.struct("digest", "copy", "spans")).alias("found"))
    )
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64("text").alias("mark"))
    same = (F.col("doc.doc_id") == F.col("of")) & (F.col("mark") == F.col("of_mark"))
    joined = rows.join(found, same, "left")
    fields = rows.schema["doc"].dataType.simpleString()
    return joined.select("doc", "found").mapInArrow(
        partial(_removed, window=window),
        f"doc {fields}, n_words long, n_removed long, kept_text string",
    )
