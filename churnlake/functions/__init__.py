from churnlake.functions.scalar import guarded_ratio, percent, segment
from churnlake.functions.standardize import (
    currency,
    date,
    decimal,
    fingerprint,
    flag,
    lower_text,
    month,
    month_of,
    resolve_column,
    text,
    title,
    whole_number,
)

__all__ = [
    "currency",
    "date",
    "decimal",
    "fingerprint",
    "flag",
    "guarded_ratio",
    "lower_text",
    "month",
    "month_of",
    "percent",
    "resolve_column",
    "segment",
    "text",
    "title",
    "whole_number",
]
