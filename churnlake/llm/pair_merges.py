"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs.

A word's symbols are leaves; a leaf holds the rank of the merge of its symbol and
the next one, if there is one, above its place. Every inner node holds the least
leaf below it, so the root gives the leftmost pair of lowest rank. Merging it
changes the leaf itself, the one before and the one that goes, and their paths
to the root: a word of n symbols takes n log n steps. Short words of equal tree
size advance together, a long one has a tree of its own.

The vocabulary file says how text becomes words: Unicode composition, blanks as
spaces, lower case, and a pattern. No word reaches over a blank, so a text is cut
at blanks into units, and a distinct unit is normalized and encoded once, as long
as it is among the units a task remembers. Strings of special tokens in a text
are those tokens.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlake.llm.sentence_pieces import ragged
from churnlake.llm.words import pieces

# Where each executor finds the vocabulary; a parameter of the operator.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"

# Symbols of a word whose tree is built together with others.
SHORT = 64
# Leaves of the trees that advance together.
LEAVES = 1 << 18
# Units that a task remembers, and the longest of them in characters.
KNOWN, KNOWN_LENGTH = 1 << 18, 64
# Characters of a text that are cut into units at a time.
STRETCH = 1 << 20

_NONE = np.iinfo(np.int64).max
# The control characters that Python splits at, though they are no blanks.
_NOT_BLANK = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[\t-\r \u0085   -     　]+")
_SLOT_BITS = 20
# The first letter after the Latin ones.
_BEYOND = "\u0250"


@dataclass
class Merges:
    """Pairs of symbols by rank, found by a hash table of their keys."""

    keys: np.ndarray
    merged: np.ndarray
    slots: np.ndarray

    @staticmethod
    def build(pairs: list[tuple[int, int]], merged: list[int]) -> Merges:
        keys = np.array([(left << 32) | right for left, right in pairs] + [-1], np.int64)
        slots = np.full(1 << _SLOT_BITS, len(pairs), np.int32)
        waiting = np.arange(len(pairs))
        places = Merges._place(keys[:-1])
        while len(waiting):
            free = slots[places] == len(pairs)
            slots[places[free]] = waiting[free]
            lost = slots[places] != waiting
            waiting, places = waiting[lost], (places[lost] + 1) & (len(slots) - 1)
        return Merges(keys, np.array([*merged, 0], np.int64), slots)

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of pairs where there is none."""
        keys = (left.astype(np.int64) << 32) | right
        places = self._place(keys)
        found = self.slots[places].astype(np.int64)
        none = len(self.keys) - 1
        wrong = np.flatnonzero((self.keys[found] != keys) & (found != none))
        while len(wrong):
            places[wrong] = (places[wrong] + 1) & (len(self.slots) - 1)
            found[wrong] = self.slots[places[wrong]]
            missed = (self.keys[found[wrong]] != keys[wrong]) & (found[wrong] != none)
            wrong = wrong[missed]
        return found


@dataclass
class Vocabulary:
    tokenizer: Tokenizer
    merges: Merges
    by_key: dict[int, int]
    # The symbol of a byte, within a word and as its end, and the byte of the
    # character that stands for it in the file.
    inner: np.ndarray
    final: np.ndarray
    byte: dict[str, int]
    # What cuts lower-case text without blanks but line feeds.
    pattern: regex.Pattern
    special: re.Pattern
    special_ids: dict[str, int]
    # Bytes of all tokens, each followed by a space, and where each starts.
    data: np.ndarray
    starts: np.ndarray


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else
    the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return [chr(byte if byte in visible else 256 + hidden.index(byte)) for byte in range(256)]


def load(vocabulary: str) -> Vocabulary:
    with open(vocabulary, encoding="utf-8") as file:
        given = json.load(file)
    model, ids = given["model"], given["model"]["vocab"]
    if model["type"] != "BPE" or given["decoder"] is not None or model["dropout"]:
        raise ValueError("only byte-pair vocabularies without dropout and decoder are supported")
    end = model["end_of_word_suffix"]
    characters, cut = _byte_characters(), given["pre_tokenizer"]["pretokenizers"][0]
    pairs = [(ids[left], ids[right]) for left, right in model["merges"]]
    merged = [ids[left + right] for left, right in model["merges"]]
    special = {token["content"]: token["id"] for token in given["added_tokens"]}
    tokens = {number: token for token, number in [*ids.items(), *special.items()]}
    texts = [tokens.get(number, "").encode() + b" " for number in range(max(tokens) + 1)]
    return Vocabulary(
        Tokenizer.from_file(vocabulary),
        Merges.build(pairs, merged),
        {(left << 32) | right: rank for rank, (left, right) in enumerate(pairs)},
        np.array([ids[character] for character in characters]),
        np.array([ids[character + end] for character in characters]),
        {character: byte for byte, character in enumerate(characters)},
        regex.compile(f"{cut['pattern']['Regex']}|\n"),
        re.compile("|".join(map(re.escape, special))),
        special,
        np.frombuffer(b"".join(texts), np.uint8),
        np.cumsum([0, *map(len, texts)]),
    )


def _merge_short(symbols: np.ndarray, merges: Merges) -> np.ndarray:
    """Merge the rows of a table of symbols, padded by -1; gone symbols become -1.

    The width is a power of two; the trees are the rows of one table, with the
    root at 1 and the children of a node at twice its place and the next.
    """
    size, width = symbols.shape
    none = len(merges.keys) - 1
    rows = np.arange(size)
    after = np.tile(np.arange(1, width + 1), (size, 1))
    length = (symbols >= 0).sum(axis=1)
    after[rows, length - 1] = width
    before = np.tile(np.arange(-1, width), (size, 1))
    tree = np.full((size, 2 * width), _NONE)
    pair = (symbols[:, :-1] >= 0) & (symbols[:, 1:] >= 0)
    row, at = np.nonzero(pair)
    ranks = merges.ranks(symbols[row, at], symbols[row, at + 1])
    tree[row, width + at] = np.where(ranks == none, _NONE, ranks * width + at)
    low = width
    while low > 1:
        half = low // 2
        tree[:, half:low] = np.minimum(tree[:, low : 2 * low : 2], tree[:, low + 1 : 2 * low : 2])
        low = half
    rows = rows[tree[:, 1] < _NONE]
    while len(rows):
        best = tree[rows, 1]
        at = best & (width - 1)
        gone = after[rows, at]
        follower = after[rows, gone]
        symbols[rows, at] = merges.merged[best // width]
        symbols[rows, gone] = -1
        after[rows, at] = follower
        before[rows, follower] = at
        earlier = before[rows, at]
        own = symbols[rows, at]
        # The pairs of this symbol with the next and of the one before with this.
        lefts = np.concatenate([own, symbols[rows, earlier]])
        right = np.where(follower < width, symbols[rows, np.minimum(follower, width - 1)], -1)
        rights = np.concatenate([right, own])
        places = np.concatenate([at, earlier])
        real = np.concatenate([follower < width, earlier >= 0])
        ranks = np.full(len(places), none)
        ranks[real] = merges.ranks(lefts[real], rights[real])
        values = np.where(ranks == none, _NONE, ranks * width + places)
        tree[rows, width + gone] = _NONE
        tree[rows, width + at] = values[: len(rows)]
        has = earlier >= 0
        tree[rows[has], width + earlier[has]] = values[len(rows) :][has]
        changed = np.concatenate([rows, rows, rows[has]])
        nodes = (width + np.concatenate([gone, at, earlier[has]])) >> 1
        while nodes[0]:
            tree[changed, nodes] = np.minimum(tree[changed, 2 * nodes], tree[changed, 2 * nodes + 1])
            nodes >>= 1
        rows = rows[tree[rows, 1] < _NONE]
    return symbols


def _merge_long(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """Merge one word of any length with a tree of its own."""
    size = len(symbols)
    width = 1 << max(1, (size - 1).bit_length())
    pairs, merged = vocabulary.by_key, vocabulary.merges.merged.tolist()
    none = len(pairs)
    symbols = array("q", symbols)
    after = array("q", range(1, size + 1))
    before = array("q", range(-1, size))
    leaves = np.full(2 * width, _NONE)
    whole = np.frombuffer(symbols, np.int64)
    ranks = vocabulary.merges.ranks(whole[:-1], whole[1:])
    del whole
    leaves[width : width + size - 1] = np.where(
        ranks == none, _NONE, ranks * width + np.arange(size - 1)
    )
    low = width
    while low > 1:
        half = low // 2
        leaves[half:low] = np.minimum(leaves[low : 2 * low : 2], leaves[low + 1 : 2 * low : 2])
        low = half
    tree = array("q", leaves.tobytes())
    del leaves
    top = _NONE

    def put(place: int, value: int) -> None:
        node = width + place
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    def value(place: int, follower: int) -> int:
        rank = pairs.get((symbols[place] << 32) | symbols[follower], -1)
        return top if rank < 0 else rank * width + place

    while tree[1] != top:
        rank, at = divmod(tree[1], width)
        gone = after[at]
        follower = after[gone]
        symbols[at] = merged[rank]
        symbols[gone] = -1
        after[at] = follower
        put(gone, top)
        if follower < size:
            before[follower] = at
            put(at, value(at, follower))
        else:
            put(at, top)
        if before[at] >= 0:
            put(before[at], value(before[at], at))
    return [symbol for symbol in symbols if symbol >= 0]


def merge_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that are left of each word when no pair can be merged, one word
    after the other, and where each word's start. No word has a line feed."""
    if not words:
        return np.empty(0, np.uint32), np.zeros(1, np.int64)
    data = np.frombuffer("\n".join([*words, ""]).encode(), np.uint8)
    ends = np.flatnonzero(data == 10)
    first = np.append(0, ends + 1)
    lengths = np.diff(first) - 1
    symbols = vocabulary.inner[data]
    symbols[ends - 1] = vocabulary.final[data[ends - 1]]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for number in np.flatnonzero(lengths > SHORT).tolist():
        left = _merge_long(symbols[first[number] : ends[number]].tolist(), vocabulary)
        found.append((np.array([number]), np.array([len(left)]), np.array(left)))
    width = 2
    while width <= SHORT:
        least = width // 2 if width > 2 else 0
        group = np.flatnonzero((lengths > least) & (lengths <= width))
        step = max(1, LEAVES // width)
        for low in range(0, len(group), step):
            chosen = group[low : low + step]
            table = np.full((len(chosen), width), -1, np.int64)
            own = ragged(first[chosen], lengths[chosen])
            table[np.arange(width) < lengths[chosen][:, None]] = symbols[own]
            table = _merge_short(table, vocabulary.merges)
            left = table >= 0
            found.append((chosen, left.sum(axis=1), table[left]))
        width *= 2
    counts = np.zeros(len(words), np.int64)
    for chosen, count, _ in found:
        counts[chosen] = count
    starts = np.append(0, np.cumsum(counts))
    result = np.empty(starts[-1], np.uint32)
    for chosen, count, left in found:
        result[ragged(starts[chosen], count)] = left
    return result, starts


def _units(text: str) -> Iterator[list[str]]:
    """The units of a text, some at a time."""
    start = 0
    while start < len(text):
        stop = start + STRETCH
        if stop < len(text):
            blank = _BLANKS.search(text, stop)
            stop = blank.end() if blank else len(text)
        part = text[start:stop]
        if _NOT_BLANK.search(part):
            yield [unit for unit in _BLANKS.split(part) if unit]
        else:
            yield part.split()
        start = stop


class Encoder:
    """Ids of texts, as bytes of 32-bit integers; remembers units it has seen."""

    def __init__(self, vocabulary: str) -> None:
        self.vocabulary = load(vocabulary)
        self.known: dict[str, bytes] = {}

    def _words(self, unit: str) -> list[str]:
        """The words of any unit, by the library's rules."""
        known = self.vocabulary
        normal = known.tokenizer.normalizer.normalize_str(unit)
        mapped = known.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(map(known.byte.__getitem__, word)).decode() for word, _ in mapped if word]

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        # Latin letters are composed and have one case rule, so many units can be
        # lower-cased and cut at once.
        plain = [unit for unit in units if max(unit) < _BEYOND and min(unit) > " "]
        cut = self.vocabulary.pattern.findall("\n".join(plain).lower())
        ends = [number for number, word in enumerate(cut) if word == "\n"]
        sizes = np.diff([-1, *ends, len(cut)]) - 1 if plain else []
        words = [word for word in cut if word != "\n"]
        other = [self._words(unit) for unit in set(units).difference(plain)]
        units = [*plain, *set(units).difference(plain)]
        words += [word for own in other for word in own]
        merged, starts = merge_words(words, self.vocabulary)
        data = merged.tobytes()
        ends = 4 * starts[np.cumsum([0, *sizes, *map(len, other)])]
        ranges = zip(units, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
        return {unit: data[low:high] for unit, low, high in ranges}

    def _resolve(self, parts: list[tuple[list[bytes], list[str]]]) -> None:
        """Append the ids of each list of units to the list it comes with."""
        new = set().union(*(units for _, units in parts)).difference(self.known)
        found = self._learn(list(new))
        ids = {**self.known, **found} if found else self.known
        for out, units in parts:
            out.append(b"".join(map(ids.__getitem__, units)))
        self.known = ids if len(ids) <= KNOWN else found
        for unit in new:
            if len(unit) > KNOWN_LENGTH or len(found) > KNOWN:
                del self.known[unit]

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.vocabulary
        result: list[list[bytes]] = []
        waiting: list[tuple[list[bytes], list[str]]] = []
        size = 0
        for text in texts:
            result.append([])
            start = 0
            cuts = [(token.start(), token.end(), token.group()) for token in known.special.finditer(text)]
            for low, high, token in [*cuts, (len(text), len(text), None)]:
                for units in _units(text[start:low] if cuts else text):
                    # Parts wait until they are worth a call; each keeps its place.
                    result[-1].append([])
                    waiting.append((result[-1][-1], units))
                    size += STRETCH // 512 + sum(map(len, units))
                    if size >= STRETCH:
                        self._resolve(waiting)
                        waiting, size = [], 0
                if token is not None:
                    result[-1].append([np.uint32(known.special_ids[token]).tobytes()])
                start = high
        self._resolve(waiting)
        return [b"".join(part for parts in own for part in parts) for own in result]


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> bytes:
    """The tokens joined by one space; this vocabulary has no other decoder."""
    starts = vocabulary.starts[ids]
    sizes = vocabulary.starts[ids + 1] - starts
    before = np.cumsum(sizes) - sizes
    places = np.repeat(starts - before, sizes) + np.arange(sizes.sum())
    return vocabulary.data[places][:-1].tobytes()


def encode_merges(
    docs: DataFrame,
    *,
    vocabulary: str = VOCABULARY,
    keep: Sequence[str] | None = None,
    packed: bool = False,
    decoded: bool = False,
) -> DataFrame:
    """(doc, ids), one row per row of ``docs`` (text string). ``doc`` is the row, or
    its columns ``keep``, so other columns pass whatever their names. ``ids`` is
    array<int>, or with ``packed`` binary, four bytes an id, the lowest first. With
    ``decoded`` there is also the text of the ids, as ``decode_merges`` gives it.

    No special tokens are added. A null, empty or blank text has no ids; no rows
    give no rows, and equal texts equal ids.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in pieces(batches, text="_t"):
            found = encoder.encode([text or "" for text in batch.column("_t").to_pylist()])
            if packed:
                ids = pa.array(found, pa.binary())
            else:
                first = np.cumsum([0, *(len(ids) // 4 for ids in found)])
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values)
            columns = {"doc": batch.column("doc"), "ids": ids}
            if decoded:
                numbers = [np.frombuffer(own, np.uint32).astype(np.int64) for own in found]
                texts = [decode(own, encoder.vocabulary) for own in numbers]
                columns["decoded"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.record_batch(columns)

    kept = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*kept).alias("doc"), F.col("text").alias("_t"))
    kind = rows.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, ids {'binary' if packed else 'array<int>'}"
    return rows.mapInArrow(encoded, schema + ", decoded string" * decoded)


def decode_merges(encoded: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (ids array<int>, or packed) with the text of its ids as ``decoded``.

    Null ids give null, no ids the empty text; special tokens are kept. Other
    columns pass; a column named decoded is an error.
    """
    if "decoded" in encoded.columns:
        raise ValueError("there is a column named decoded")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load(vocabulary)
        for batch in pieces(batches):
            column = batch.column("ids")
            if pa.types.is_binary(column.type):
                rows = [None if ids is None else np.frombuffer(ids, np.int32) for ids in column.to_pylist()]
            else:
                values, first = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
                ranges = zip(first[:-1], first[1:], column.is_valid().to_pylist(), strict=True)
                rows = [values[low:high] if there else None for low, high, there in ranges]
            texts = [None if ids is None else decode(ids.astype(np.int64), known) for ids in rows]
            yield batch.append_column("decoded", pa.array(texts, pa.binary()).cast(pa.string()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decoded, f"{schema}, decoded string")
