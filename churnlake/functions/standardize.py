"""Raw strings to typed values.

Spark 4 raises on a bad cast, while a raw row must never stop the job: every
parser here returns NULL for what it cannot read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted date layouts, first match wins. Slashes are read as
# month first, dashes as day first.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "MM/dd/yyyy", "dd MMM yyyy")

# The shapes of the layouts.
YEAR_FIRST = r"^\d{4}([-/])\d{2}\1\d{2}$"
DAY_FIRST = r"^\d{2}-\d{2}-\d{4}$"
MONTH_FIRST = r"^\d{2}/\d{2}/\d{4}$"
NAMED_MONTH = r"^\d{2} [A-Za-z]{3} \d{4}$"

# Numbers whose fraction is cut off, and those that are nothing but a fraction.
PLAIN_NUMBER = r"^[+-]?\d+(\.\d*)?$"
BARE_FRACTION = r"^[+-]?\.\d*$"

# Tokens read as 1 and as 0, in any case.
TRUE_TOKENS = ("1", "yes", "y", "true")
FALSE_TOKENS = ("0", "no", "n", "false")

# The normal month, and its other spellings.
NORMAL_MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"
YEAR_AND_MONTH = r"^\d{4}[-/](0[1-9]|1[0-2])$"
MONTH_AND_YEAR = r"^(0[1-9]|1[0-2])/\d{4}$"


def text(value: Column) -> Column:
    """Without surrounding spaces; a blank string is NULL. Tabs are kept."""
    return F.nullif(F.trim(value), F.lit(""))


def title(value: Column) -> Column:
    return F.initcap(text(value))


def lower_text(value: Column) -> Column:
    return F.lower(text(value))


# The parsers below only trim, since a blank string is no number, date or flag.
# They also keep to functions whose generated code is short: all cells of a row
# are parsed in one method, and a long method is never compiled to machine code.


def currency(value: Column) -> Column:
    """``$1,234.50`` to 1234.5."""
    return F.translate(F.trim(value), "$,", "").try_cast("double")


def decimal(value: Column) -> Column:
    return F.trim(value).try_cast("double")


def whole_number(value: Column, type_name: str = "int") -> Column:
    """An integer; a fraction is cut off, overflow and junk are NULL."""
    cleaned = F.trim(value)
    return F.when(
        cleaned.rlike(PLAIN_NUMBER), F.substring_index(cleaned, ".", 1).try_cast(type_name)
    ).when(cleaned.rlike(BARE_FRACTION), F.lit(0).cast(type_name))


def _join_dashed(value: Column, *places: tuple[int, int]) -> Column:
    return F.concat_ws("-", *[F.substring(value, start, length) for start, length in places])


def date(value: Column) -> Column:
    """The date in whichever of the layouts the text has; NULL if it has none.

    The layouts exclude each other, so the text is first recognised by its
    shape. Trying one layout after the other would raise and catch an exception
    for every miss, which costs more than the rest of the row.
    """
    cleaned = F.trim(value)
    iso = (
        F.when(cleaned.rlike(YEAR_FIRST), F.translate(cleaned, "/", "-"))
        .when(cleaned.rlike(DAY_FIRST), _join_dashed(cleaned, (7, 4), (4, 2), (1, 2)))
        .when(cleaned.rlike(MONTH_FIRST), _join_dashed(cleaned, (7, 4), (1, 2), (4, 2)))
    )
    named = F.when(cleaned.rlike(NAMED_MONTH), F.try_to_date(cleaned, DATE_LAYOUTS[-1]))
    return F.coalesce(iso.try_cast("date"), named)


def flag(value: Column) -> Column:
    token = F.lower(F.trim(value))
    return F.when(token.isin(*TRUE_TOKENS), 1).when(token.isin(*FALSE_TOKENS), 0)


def month(value: Column) -> Column:
    """``2025/10`` and ``10/2025`` to ``2025-10``."""
    cleaned = F.trim(value)
    return F.when(cleaned.rlike(YEAR_AND_MONTH), F.translate(cleaned, "/", "-")).when(
        cleaned.rlike(MONTH_AND_YEAR), _join_dashed(cleaned, (4, 4), (1, 2))
    )


def month_of(value: Column) -> Column:
    """``2025-10`` of a date or time. A date's own text starts with it as long as the
    year has four digits, and takes half the time of a pattern."""
    day = value.cast("date")
    plain = day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    return F.when(plain, F.substring(day.cast("string"), 1, 7)).otherwise(
        F.date_format(value, "yyyy-MM")
    )


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 over the named fields. JSON leaves NULL fields out by name, so
    no two different rows read the same."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def resolve_column(df: DataFrame, *names: str) -> Column:
    """The first of ``names`` that ``df`` has."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of {', '.join(names)} is among {', '.join(df.columns)}")
