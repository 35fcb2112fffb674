"""Token counts of the sections of a document, from one encoding of the whole.

A document is encoded once. Its tokens' character spans are joined with the
spans of its sections, the lines with their line feeds, by binary search. A
token inside one section counts there. A token across a boundary counts in the
section that holds most of its characters, the earliest of several, so the
counts of the sections add up to the count of the document.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from churnlake.llm.words import pieces

# Where each executor finds the vocabulary; a parameter of the operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how this vocabulary cuts text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Fixed value: the characters that the pattern's \s stands for.
BLANKS = "\t\n\v\f\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Longer runs of blanks are encoded apart: the pattern looks ahead after every
# run and needs a stack as deep as the run is long.
LONGEST_RUN = 1000
_LONG_RUN = re.compile(f"[{BLANKS}]{{{LONGEST_RUN},}}")

_SCHEMA = (
    "doc_id long, section int, first_char long, n_chars long, n_tokens long, n_crossing long"
)


def load(vocabulary: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding and the bytes of each token."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = [len(token) for token in ranks]
    encoding = tiktoken.Encoding(
        "public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return encoding, sizes


def encode(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The tokens of a text of any length.

    The pattern takes a run of blanks as one piece, but for its last blank where
    text follows, which goes with that text; so a cut before that blank leaves
    every piece as it is.
    """
    tokens, start = [], 0
    for run in _LONG_RUN.finditer(text):
        tokens += encoding.encode_ordinary(text[start : run.start()])
        start = run.end() - (run.end() < len(text))
        tokens += encoding._encode_single_piece(text[run.start() : start])
    return tokens + encoding.encode_ordinary(text[start:])


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, chars: np.ndarray):
    """(section of each token, whether it crosses): byte spans of the tokens,
    section starts followed by the end, and the characters before each byte."""
    section = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = section != last
    for token in np.flatnonzero(crossing):
        edges = bounds[section[token] : last[token] + 2].copy()
        edges[0], edges[-1] = starts[token], ends[token]
        section[token] += np.diff(chars[edges]).argmax()
    return section, crossing


def count_sections(text: bytes, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """First character, characters, tokens and crossing tokens of each line."""
    data = np.frombuffer(text, np.uint8)
    bounds = np.append(0, np.flatnonzero(data == 10) + 1)
    if len(bounds) == 1 or bounds[-1] < len(data):
        bounds = np.append(bounds, len(data))
    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    ends = np.cumsum(sizes[tokens])
    section, crossing = attribute(ends - sizes[tokens], ends, bounds, chars)
    n = len(bounds) - 1
    return (
        chars[bounds[:-1]],
        np.diff(chars[bounds]),
        np.bincount(section, minlength=n),
        np.bincount(section[crossing], minlength=n),
    )


def section_tokens(docs: DataFrame, *, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per section of each row of ``docs`` (doc_id long, text string).

    Sections are the lines, numbered from 0, each with its line feed. A null or
    empty text is one section without characters and tokens. n_crossing counts
    the section's tokens that also lie in other sections. Other columns are
    ignored; a repeated row is counted each time.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = load(vocabulary)
        for batch in pieces(batches, text="text"):
            found, lines = [], []
            for text in batch.column("text").to_pylist():
                tokens = np.array(encode(encoding, text or ""), np.int64)
                found.append(count_sections((text or "").encode(), tokens, sizes))
                lines.append(len(found[-1][0]))
            owner = np.repeat(np.arange(batch.num_rows), lines)
            number = np.concatenate([np.arange(n) for n in lines])
            columns = [np.concatenate(part) for part in zip(*found, strict=True)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(owner)),
                    "section": pa.array(number.astype(np.int32)),
                    **{
                        name: pa.array(column.astype(np.int64))
                        for name, column in zip(
                            ("first_char", "n_chars", "n_tokens", "n_crossing"), columns, strict=True
                        )
                    },
                }
            )

    return docs.select("doc_id", "text").mapInArrow(counted, _SCHEMA)
