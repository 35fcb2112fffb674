"""SentencePiece encoding and decoding by a batched Viterbi search.

A text is a space followed by its characters; a space and what follows it up to
the next space is a unit, and no piece reaches over a unit's end. The distinct
units of a batch, told apart by their bytes, are encoded once. Units of equal length advance together:
at each character the hashes of the substrings that end there probe the sorted
keys of the pieces, the best sum of scores is the maximum over them, and its
length is the backpointer. A character that is no piece costs 10 more than the
worst piece and becomes its bytes.

The result is the segmentation of the highest total score, the longer last piece
first among equals. Decoding gives back the text, with U+2581 as a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.words import byte_codes, mix, number_ranges, pieces, powers

# Where each executor finds the model; a parameter of the operator.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

_META = "▁"
_PENALTY = 10.0
_CELLS = 1 << 22

# Bytes of text whose distinct units are encoded together.
_TEXT = 1 << 23


@dataclass
class Pieces:
    """Piece keys in order with their ids and scores, and each id's bytes."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    unknown: float
    byte_ids: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    maybe: np.ndarray


def load(model: str) -> Pieces:
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    if processor.normalize(" a  b½") != f"{_META}{_META}a{_META}{_META}b½":
        raise ValueError("only models without normalization are supported")
    keys, ids, scores, longest = [], [], [], 1
    byte_ids, texts = np.full(256, processor.unk_id()), []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        if processor.is_byte(number):
            byte_ids[int(piece[3:5], 16)] = number
            texts.append(bytes([int(piece[3:5], 16)]))
        elif processor.is_control(number) or processor.is_unknown(number):
            texts.append(b"")
        else:
            texts.append(piece.replace(_META, " ").encode())
            keys.append(texts[-1])
            ids.append(number)
            scores.append(processor.get_score(number))
            longest = max(longest, len(piece))
    hashes = np.array([_key(key) for key in keys], np.uint64)
    order = np.argsort(hashes)
    maybe = np.zeros(_CELLS, bool)
    maybe[hashes >> np.uint64(42)] = True
    return Pieces(
        hashes[order],
        np.array(ids)[order],
        np.array(scores)[order],
        longest,
        min(scores) - _PENALTY,
        byte_ids,
        np.frombuffer(b"".join(texts), np.uint8),
        np.cumsum([0, *map(len, texts)]),
        maybe,
    )


def _key(text: bytes) -> int:
    data = np.frombuffer(text, np.uint8)
    return int(mix((byte_codes()[data] * powers(len(data))[0][: len(data)]).sum(keepdims=True))[0])


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + sizes[i] - 1, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def _split(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of texts that each begin with a space."""
    space = data == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(data))


def _segment(units: np.ndarray, sums: np.ndarray, place: np.ndarray, known: Pieces):
    """Lengths in characters and piece ids (-1: none) of the units' pieces, from
    the last to the first. ``place`` has the byte offsets of the characters and
    ``sums`` the running hash sums there, a row per unit."""
    size, n = len(units), place.shape[1] - 1
    turned = powers(int(place.max()) + 1)[1][place]
    best = np.full((size, n + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((size, n + 1), np.int32)
    own = np.full((size, n + 1), -1, np.int32)
    rows = np.arange(size)
    for end in range(1, n + 1):
        begins = np.arange(max(0, end - known.longest), end)
        keys = mix((sums[:, end, None] - sums[:, begins]) * turned[:, begins])
        hit = known.maybe[keys >> np.uint64(42)]
        wanted = keys[hit]
        at = np.minimum(np.searchsorted(known.keys, wanted), len(known.keys) - 1)
        real = known.keys[at] == wanted
        total = np.full(keys.shape, -np.inf)
        total[:, -1] = best[:, end - 1] + known.unknown
        piece = np.full(keys.shape, -1, np.int32)
        row, column = (index[real] for index in np.nonzero(hit))
        at = at[real]
        total[row, column] = best[row, column + begins[0]] + known.scores[at]
        piece[row, column] = known.ids[at]
        chosen = total.argmax(axis=1)
        best[:, end] = total[rows, chosen]
        back[:, end] = end - begins[0] - chosen
        own[:, end] = piece[rows, chosen]
    ends, lengths, ids = np.full(size, n), [], []
    while (ends > 0).any():
        lengths.append(np.where(ends > 0, back[rows, ends], 0))
        ids.append(own[rows, ends])
        ends = ends - lengths[-1]
    return np.stack(lengths, axis=1), np.stack(ids, axis=1)


def _encode_units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: Pieces):
    """Ids of all units in order, and where each unit's start."""
    heads = (data & 0xC0) != 0x80
    counted = np.append(0, np.cumsum(heads))
    sizes = counted[ends] - counted[starts]
    firsts = np.flatnonzero(heads)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts):
        n = int(sizes[group[0]]) if len(group) else 0
        step = max(1, (1 << 16) // max(n, 1))
        for low in range(0, len(group), step):
            units = group[low : low + step]
            at = firsts[counted[starts[units]][:, None] + np.arange(n)]
            place = np.concatenate([at, ends[units][:, None]], axis=1) - starts[units][:, None]
            width = int(place.max())
            power = powers(width + 1)[0]
            grid = np.zeros((len(units), width + 1), np.uint64)
            inside = np.arange(width) < place[:, -1:]
            grid[:, 1:][inside] = byte_codes()[data[ragged(starts[units], place[:, -1])]]
            grid[:, 1:] *= power[:width]
            sums = np.take_along_axis(np.cumsum(grid, axis=1, dtype=np.uint64), place, axis=1)
            lengths, ids = _segment(units, sums, place, known)
            lengths, ids = lengths[:, ::-1], ids[:, ::-1]
            stops = np.cumsum(lengths, axis=1)
            row = np.arange(len(units))[:, None]
            begin = starts[units][:, None] + place[row, stops - lengths]
            bytes_ = starts[units][:, None] + place[row, stops] - begin
            real = lengths > 0
            width = np.where(ids >= 0, 1, bytes_)[real]
            flat = np.repeat(ids[real], width)
            raw = ragged(begin[real], width)
            flat = np.where(flat >= 0, flat, known.byte_ids[data[raw]])
            total = np.bincount(np.nonzero(real)[0], width, len(units)).astype(np.int64)
            out.append((units, total, flat))
    counts = np.zeros(len(starts), np.int64)
    for units, total, _ in out:
        counts[units] = total
    first = np.append(0, np.cumsum(counts))
    result = np.empty(first[-1], np.int32)
    for units, total, flat in out:
        result[ragged(first[units], total)] = flat
    return result, first


def encode(texts: list[bytes], known: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in order, and where each text's start."""
    texts = [b" " + text.replace(_META.encode(), b" ") if text else b"" for text in texts]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.append(0, np.cumsum([len(text) for text in texts]).astype(np.int64))
    starts, ends = _split(data, bounds)
    if not len(starts):
        return np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
    same, _ = number_ranges(data, starts, ends)
    _, sample = np.unique(same, return_index=True)
    ids, first = _encode_units(data, starts[sample], ends[sample], known)
    sizes = np.diff(first)[same]
    whole = ids[ragged(first[:-1][same], sizes)]
    before = np.append(0, np.cumsum(sizes))
    return whole, before[np.searchsorted(starts, bounds)]


def decode(ids: np.ndarray, first: np.ndarray, known: Pieces) -> list[bytes]:
    """The texts of runs of piece ids, without the space put before them."""
    sizes = np.diff(known.starts)[ids]
    data = known.data[ragged(known.starts[:-1][ids], sizes)].tobytes()
    ends = np.append(0, np.cumsum(sizes))[first]
    return [data[a + 1 : b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encode_pieces(docs: DataFrame, *, model: str = MODEL) -> DataFrame:
    """(doc, piece_ids, round_trip), one row per row of ``docs``.

    ``docs`` has text (string); ``doc`` is the whole row. round_trip: decoding
    the ids gives the text, but for U+2581, which becomes a space. A null or
    empty text has no pieces.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load(model)
        for batch in batches:
            batch = batch.append_column("_t", batch.column("doc").field("text"))
            for part in pieces([batch], 1 << 14, text="_t", size=_TEXT):
                texts = [text or b"" for text in part.column("_t").cast(pa.binary()).to_pylist()]
                ids, first = encode(texts, known)
                again = decode(ids, first, known)
                same = [x.replace(_META.encode(), b" ") == y for x, y in zip(texts, again, strict=True)]
                yield pa.record_batch(
                    {
                        "doc": part.column("doc"),
                        "piece_ids": pa.ListArray.from_arrays(
                            pa.array(first.astype(np.int32)), pa.array(ids)
                        ),
                        "round_trip": pa.array(same),
                    }
                )

    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"doc {kind}, piece_ids array<int>, round_trip boolean")


def decode_pieces(encoded: DataFrame, *, model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of its piece_ids as ``decoded``; null for null."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load(model)
        for batch in batches:
            rows = [np.array(row or [], np.int64) for row in batch.column("piece_ids").to_pylist()]
            first = np.cumsum([0, *map(len, rows)])
            texts = decode(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), first, known)
            texts = pa.array(texts, pa.binary()).cast(pa.string())
            empty = batch.column("piece_ids").is_null()
            yield batch.append_column("decoded", pa.compute.if_else(empty, None, texts))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decoded, f"{schema}, decoded string")

