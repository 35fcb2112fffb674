"""Spelling variants by a bit-sliced position index.

Two words are near if one character is inserted, deleted or replaced. Written as
the shorter one, that character is at some place of it: if in the first half, the
rest is equal behind, else before. So a word goes to groups by length, the place
range of the difference, and the characters outside that range. A group of more
than ``GROUP`` words is cut into those of half the range, again and again; with a
range of one place a group has at most two free characters a word, whatever the
data. The pair of two words counts in the one group whose range holds the end of
their common prefix.

A task puts its groups, some together, into an index: for each place and each
character, a bitset of the words that have it there. A word asks with recurrences
over its characters: sets of the words that agree so far (zero errors), and of
those with one replaced character, one more (read one place further) or one less
(one place back). All words of an index ask together, 64 answers to an operation.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.term_counts import TERMS, find_runs
from churnlake.operators.skew import hot_keys, spread_lookup
from churnlake.scratch import stage

LEAST_LENGTH, LEAST_COUNT = 5, 3

# Words of a group before its range is cut, and of an index.
GROUP, INDEX = 4096, 2048
# Characters of the words of an index, unless one group has more.
LETTERS = 1 << 20

# Which runs lose a character.
STEP = 97

_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")


def variant(run: bytes, start: int) -> bytes | None:
    """The run without one of its characters if its checksum says so."""
    check = crc32(run, start)
    if check % STEP:
        return None
    text = run.decode()
    place = check % len(text)
    return (text[:place] + text[place + 1 :]).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def give() -> pa.RecordBatch:
        words, counts = list(totals), list(totals.values())
        return pa.record_batch(
            {"word": pa.array(words, pa.binary()).cast(pa.string()), "n": pa.array(counts, pa.int64())}
        )

    totals: Counter = Counter()
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for doc_id, text in zip(ids, batch.column("text").cast(pa.binary()), strict=True):
            start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for runs in find_runs(_RUN, (text.as_py() or b"").lower()):
                counts = Counter(runs)
                for run in [run for run in counts if crc32(run, start) % STEP == 0]:
                    totals[variant(run, start)] += counts.pop(run)
                totals.update(counts)
        if len(totals) > TERMS:
            yield give()
            totals = Counter()
    yield give()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough."""
    return (
        docs.select("doc_id", "text")
        .mapInArrow(_counted, "word string, n long")
        .where(F.length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


def _keyed(words: DataFrame) -> DataFrame:
    """Words with their key: ``before`` and ``after`` the range ``low`` to ``high``
    of the places of a word of length ``size``, theirs or one less."""
    return words.selectExpr(
        "*",
        "substring(word, 1, low) AS before",
        "substring(word, length(word) - (size - high) + 1, size - high) AS after",
    )


KEY = ("size", "low", "high", "before", "after")


def _cut(words: DataFrame) -> DataFrame:
    """Each word twice, with either half of its range."""
    middle = "int((low + high) div 2)"
    return words.withColumn(
        "part",
        F.explode(
            F.expr(
                f"array(struct(low AS low, {middle} AS high), struct({middle} AS low, high AS high))"
            )
        ),
    ).select("word", "n", "size", "part.low", "part.high")


def grouped_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n, KEY): every word in the groups it may have a near word in.

    Each round cuts the groups that are too large; the range of the longest word
    halves, so the rounds end.
    """
    ranged = words.withColumn("size", F.explode(F.expr("array(length(word), length(word) - 1)")))
    ranged = ranged.where(F.col("size") >= LEAST_LENGTH)
    waiting = _cut(ranged.selectExpr("word", "n", "size", "0 AS low", "size AS high"))
    done = None
    while True:
        keyed = stage(_keyed(waiting), "word-groups")
        large = stage(
            keyed.where("high - low > 1")
            .groupBy(*KEY)
            .agg(F.count("*").alias("_words"))
            .where(F.col("_words") > group)
            .select(*KEY, F.lit(True).alias("_large")),
            "large-groups",
        )
        more = not large.isEmpty()
        fitting = keyed.join(large, [*KEY], "left_anti") if more else keyed
        done = fitting if done is None else done.unionByName(fitting)
        if not more:
            return done.select("word", "n", *KEY)
        waiting = _cut(keyed.join(large, [*KEY], "left_semi"))


def _bits(member: np.ndarray) -> np.ndarray:
    """Rows of truth values as bitsets of 64-bit words."""
    packed = np.packbits(member, axis=-1, bitorder="little")
    short = -packed.shape[-1] % 8
    packed = np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, short)])
    return packed.view(np.uint64)


def near_bits(
    letters: np.ndarray,
    lengths: np.ndarray,
    groups: np.ndarray,
    spans: np.ndarray,
    whole: np.ndarray,
) -> np.ndarray:
    """For each word the bitset of the words of its group that are near.

    ``letters`` has a row per word, padded by 0, of the numbers of the characters
    inside the group's range, ``spans`` places long or one more. Two words that are
    both longer do not meet here; nor do two that agree in the whole range, unless
    the range ends with the word (``whole``).
    """
    size, width = letters.shape
    count = int(letters.max(initial=0)) + 1
    index = np.zeros((width + 1, count, (size + 63) // 64), np.uint64)
    for place in range(width):
        member = letters[:, place] == np.arange(count)[:, None]
        member[0] = False
        index[place] = _bits(member)
    of_length = _bits(lengths == np.arange(width + 2)[:, None])
    longer = _bits(lengths > np.arange(width + 1)[:, None])
    zero = _bits(groups[:, None] == groups)
    more, replaced, less = zero.copy(), np.zeros_like(zero), np.zeros_like(zero)
    found, agree = np.zeros_like(zero), np.zeros_like(zero)
    for place in range(width + 1):
        ended = np.flatnonzero(lengths == place)
        found[ended] = (replaced[ended] & of_length[place]) | (more[ended] & of_length[place + 1])
        if place:
            found[ended] |= less[ended] & of_length[place - 1]
        if place == width:
            break
        going = np.flatnonzero(lengths > place)
        letter = letters[going, place]
        was, here = zero[going], index[place, letter]
        zero[going] = was & here
        replaced[going] = (replaced[going] & here) | (was & ~here & longer[place])
        more[going] = (more[going] & index[place + 1, letter]) | zero[going]
        less[going] = (less[going] & index[place - 1, letter] if place else 0) | was
        at_end = going[(spans[going] == place + 1) & ~whole[going]]
        agree[at_end] = zero[at_end]
    both_longer = np.where((lengths > spans)[:, None], _bits(lengths > spans), np.uint64(0))
    return found & ~agree & ~both_longer


def _group_numbers(table: pa.Table) -> np.ndarray:
    """Numbers of the groups of a sorted table, upwards from 0."""
    new = np.zeros(table.num_rows, bool)
    for name in KEY:
        column = table.column(name)
        before, after = column.slice(0, table.num_rows - 1), column.slice(1)
        new[1:] |= pa.compute.not_equal(before, after).to_numpy()
    return np.cumsum(new)


def _answers(table: pa.Table) -> pa.RecordBatch:
    """How many near words each word has in its group, and the best of them."""
    words = table.column("word").to_pylist()
    size, low, high, counts = (
        table.column(name).to_numpy().astype(np.int64) for name in ("size", "low", "high", "n")
    )
    ranges = zip(words, low.tolist(), (size - high).tolist(), strict=True)
    inner = [word[start : len(word) - rest] for word, start, rest in ranges]
    lengths = np.fromiter(map(len, inner), np.int64, len(inner))
    letters = np.zeros((len(inner), int(lengths.max())), np.int64)
    codes = np.frombuffer("".join(inner).encode("utf-32-le"), np.uint32)
    letters[np.arange(letters.shape[1]) < lengths[:, None]] = (
        np.unique(codes, return_inverse=True)[1] + 1
    )
    near = near_bits(letters, lengths, _group_numbers(table), high - low, high == size)
    hits = np.unpackbits(near.view(np.uint8), axis=1, count=len(words), bitorder="little")
    asking, answering = np.nonzero(hits)
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place[answering], -counts[answering], asking))
    asking, answering = asking[order], answering[order]
    first = np.flatnonzero(np.diff(asking, prepend=-1))
    best = answering[first]
    column = table.column("word").combine_chunks()
    return pa.record_batch(
        {
            "word": column.take(pa.array(asking[first])),
            "n_near": pa.array(np.diff(np.append(first, len(asking))), pa.int64()),
            "form_n": pa.array(counts[best], pa.int64()),
            "form": column.take(pa.array(best)),
        }
    )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial answers of the words of a partition sorted by group."""

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        groups = _group_numbers(table)
        table = table.filter(pa.array(np.bincount(groups)[groups] > 1))
        if not table.num_rows:
            return
        starts = np.flatnonzero(np.diff(_group_numbers(table), prepend=-1))
        longest = np.maximum.reduceat(
            pa.compute.utf8_length(table.column("word")).to_numpy(), starts
        ).tolist()
        low = width = 0
        for at, stop, length in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], longest):
            if at > low and (stop - low > INDEX or (stop - low) * max(width, length) > LETTERS):
                yield _answers(table.slice(low, at - low))
                low, width = at, 0
            width = max(width, length)
        yield _answers(table.slice(low))

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        table = pa.Table.from_batches(waiting).combine_chunks()
        if not table.num_rows:
            continue
        # The last group may go on in the next batch.
        groups = _group_numbers(table)
        last = int(np.searchsorted(groups, groups[-1]))
        if last:
            yield from solve(table.slice(0, last))
        waiting = table.slice(last).to_batches()
    if waiting:
        yield from solve(pa.Table.from_batches(waiting).combine_chunks())


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last of the forms of forms.

    Every round doubles the steps taken, and a form has at least twice its word's
    count, so there are few. Words of a frequent root are dealt out.
    """
    state = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = spread_lookup(state, onward, "root", F.col("word"), hot_keys(state, "root"))
        moved = stage(moved, "roots")
        state = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next is not null").isEmpty():
            return state


def spelling_forms(docs: DataFrame, *, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word.

    ``docs`` has doc_id and text; other columns are ignored. Words are the longest
    runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z, of which the checksum
    of ``doc_id:run`` takes a character from some; those of at least five characters
    that come three times are kept. ``form`` is the near word of most occurrences,
    the first in code-point order among equals, if it has twice the word's; ``root``
    is where following forms ends. A null text has no words, a null doc_id counts as
    an empty one, repeated rows count each time, and no rows give no rows.
    """
    words = stage(count_words(docs), "words")
    # Groups are dealt out by their key and met in one task each, of bounded size.
    answers = (
        grouped_words(words, group)
        .repartition(*KEY)
        .sortWithinPartitions(*KEY)
        .mapInArrow(_near, "word string, n_near long, form_n long, form string")
        .groupBy("word")
        .agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("form_n")).alias("rank"), "form", "form_n")).alias("best"),
        )
    )
    judged = stage(
        words.join(answers, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("best.form_n") >= 2 * F.col("n"), F.col("best")).alias("best"),
        ),
        "forms",
    )
    forms = judged.where("best is not null").select("word", "best.form")
    return judged.join(follow(forms), "word", "left").select(
        "word",
        F.col("best.form").alias("form"),
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        F.col("best.form_n").alias("form_n"),
    )
