"""Runs of letters in texts, counted inside tasks before anything is shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator

# Bytes of a text that are matched at a time.
STRETCH = 1 << 20

# Distinct terms a task counts before it hands on what it has.
TERMS = 1 << 18


# ASCII that belongs to no run.
_BETWEEN = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")


def find_runs(pattern: re.Pattern, data: bytes) -> Iterator[list[bytes]]:
    """All matches of ``pattern``, runs of letters, some at a time.

    A text is only cut after an ASCII character that is no letter.
    """
    start = 0
    while start < len(data):
        between = _BETWEEN.search(data, start + STRETCH)
        stop = between.end() if between else len(data)
        yield pattern.findall(data, start, stop)
        start = stop
