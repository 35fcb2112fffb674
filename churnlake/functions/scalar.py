"""Small expressions the reports share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 where there is no whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def percent(ratio: Column) -> Column:
    return F.round(ratio * 100, 2)


def segment(value: Column, cuts: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first cut that ``value`` reaches, highest cut first; a NULL
    reaches none and gets ``otherwise``, as a value below all cuts does."""
    labels = [F.when(value >= cut, F.lit(label)) for cut, label in cuts]
    return F.coalesce(*labels, F.lit(otherwise))
