"""Words and word hashes of a batch of texts, computed on its UTF-8 bytes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; a text never shares a word with its neighbour. Equal
words are found by their bytes and get one number per call; their hash is made of
the bytes of each distinct word.

The rolling hash of a byte range is a polynomial over random codes of its bytes,
read off running sums. Long words of equal rolling hash are easy to construct, so
it only serves features and the lookup of short pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

# Bytes hashed at a time; a longer text is cut between words.
CHUNK = 1 << 21

_CODES = np.random.Generator(np.random.PCG64(11)).integers(
    0, 1 << 64, 256, dtype=np.uint64, endpoint=False
) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def byte_codes() -> np.ndarray:
    return _CODES


def powers(length: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``length`` of them.

    The hash of the bytes from a to b is mix((sum[b] - sum[a]) * inverse[a]),
    with the running sums of code * power."""
    if not _POWERS or len(_POWERS[0]) < length:
        size = max(length, CHUNK)
        for number in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, number, np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
        del _POWERS[:-2]
    return _POWERS


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits; a bijection."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


@dataclass
class Words:
    """The words of a run of texts.

    ``starts`` and ``ends`` are byte positions within the word's own text,
    ``hashes`` the words' hashes, ``first`` the number of the first word of each
    text, followed by the number of words. ``ids`` numbers the distinct words of
    the run: two words have the same bytes exactly if they have the same id.
    ``heads`` has the rolling hashes of the words' first bytes, by their number; a
    shorter word's head is the whole word.
    """

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    ids: np.ndarray
    heads: dict[int, np.ndarray]

    def rows(self) -> np.ndarray:
        """The number of the text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def sequences(self, length: int) -> np.ndarray:
        """A hash of the ``length`` words from each word on, also beyond its text."""
        hashes, total = self.hashes, np.zeros(len(self.hashes), np.uint64)
        for at in range(length):
            total *= np.uint64(_BASE)
            total[: len(hashes) - at] += hashes[at:]
        return mix(total)

    def numbered_shingles(self, length: int) -> list[np.ndarray]:
        """Sorted distinct numbers of each text's ``length``-word shingles.

        Two shingles of the run have one number exactly if their words are equal.
        """
        base = int(self.ids.max(initial=0)) + 1
        code = self.ids.astype(np.int64)
        for at in range(1, length):
            code[: len(code) - at] = code[: len(code) - at] * base + self.ids[at:]
            code = np.unique(code, return_inverse=True)[1]
        found, short = [], {}
        for low, high in zip(self.first[:-1], self.first[1:], strict=True):
            if high - low >= length:
                found.append(distinct(code[low : high - length + 1]))
            elif high > low:
                number = short.setdefault(tuple(self.ids[low:high].tolist()), -1 - len(short))
                found.append(np.array([number]))
            else:
                found.append(code[:0])
        return found

    def shingles(self, length: int) -> list[np.ndarray]:
        """Sorted distinct hashes of each text's ``length``-word shingles.

        A shorter text is one shingle by itself, which tells its length.
        """
        whole, found = self.sequences(length), []
        for low, high in zip(self.first[:-1], self.first[1:], strict=True):
            if high - low >= length:
                found.append(distinct(whole[low : high - length + 1]))
                continue
            short = np.zeros(min(1, high - low), np.uint64)
            for value in self.hashes[low:high]:
                short = mix(short + np.uint64(high - low)) + value
            found.append(mix(short))
        return found


def _hash_chunk(
    data: np.ndarray,
    fold: np.ndarray,
    apart: np.ndarray,
    breaks: np.ndarray,
    heads: tuple[int, ...],
) -> list[np.ndarray]:
    """Starts, ends, rolling hashes and heads of a chunk's words; words end at
    ``breaks``."""
    inside = ~apart[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    power, inverse = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[fold][data] * power[: len(data)], out=sums[1:])
    stops = [ends, *(np.minimum(ends, starts + head) for head in heads)]
    return [starts, ends, *(mix((sums[at] - sums[starts]) * inverse[starts]) for at in stops)]


def number_ranges(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(number of each byte range, hash of each number); equal bytes, equal number."""
    sizes = ends - starts
    offsets = np.append(0, np.cumsum(sizes))
    whole = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(whole)]
    ranges = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    words = ranges.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return ranges.indices.to_numpy().astype(np.int64), hashes


def find_words(
    column: pa.Array,
    *,
    lower: bool = False,
    apart: np.ndarray = SPACE,
    heads: tuple[int, ...] = (),
    rolling: bool = False,
) -> Words:
    """The words of each text of an Arrow column; a null has none.

    With ``rolling`` the hashes are rolling ones and words of equal hash share an
    id, which is cheaper and good enough for features.
    """
    column = column.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    data, bounds = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    fold = LOWER if lower else SAME
    found, start = [], 0
    while start < len(data):
        stop = min(start + CHUNK, len(data))
        if stop < len(data) and not apart[data[stop]]:
            later = np.flatnonzero(apart[data[stop : stop + CHUNK]])
            border = bounds[np.searchsorted(bounds, stop)]
            reach = CHUNK
            while not len(later) and stop + reach < border:
                later = np.flatnonzero(apart[data[stop + reach : stop + reach + CHUNK]]) + reach
                reach += CHUNK
            stop = int(min(stop + later[0], border) if len(later) else border)
        low, high = np.searchsorted(bounds, [start, stop])
        part = _hash_chunk(data[start:stop], fold, apart, bounds[low:high] - start, heads)
        found.append([part[0] + start, part[1] + start, *part[2:]])
        start = stop
    if not found:
        none = np.empty(0, np.int64)
        found.append([none, none, *[none.astype(np.uint64)] * (1 + len(heads))])
    starts, ends, hashes, *rest = (np.concatenate(parts) for parts in zip(*found, strict=True))
    first = np.searchsorted(starts, bounds)
    own = np.repeat(bounds[:-1], np.diff(first))
    if rolling:
        ids = hashes
    else:
        ids, known = number_ranges(fold[data], starts, ends)
        hashes = known[ids]
    return Words(starts - own, ends - own, hashes, first, ids, dict(zip(heads, rest, strict=True)))


def pieces(
    batches: Iterator[pa.RecordBatch],
    rows: int = 512,
    text: str | None = None,
    size: int = CHUNK,
) -> Iterator[pa.RecordBatch]:
    """The batches cut to few rows and, where a text column is named, to about
    ``size`` bytes of it."""
    for batch in batches:
        if text is None:
            cuts = range(0, batch.num_rows, rows)
        else:
            sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy()
            block = (np.cumsum(sizes, dtype=np.int64) - sizes) // size
            number = np.arange(batch.num_rows) // rows
            change = (np.diff(block) != 0) | (np.diff(number) != 0)
            cuts = [0, *(np.flatnonzero(change) + 1).tolist()] if batch.num_rows else []
        for start, stop in zip(cuts, [*cuts[1:], batch.num_rows]):
            yield batch.slice(start, stop - start)
