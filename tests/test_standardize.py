import datetime
import math
from functools import partial

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlake.functions import (
    currency,
    date,
    decimal,
    fingerprint,
    flag,
    guarded_ratio,
    lower_text,
    month,
    percent,
    resolve_column,
    segment,
    text,
    title,
    whole_number,
)

DAY = datetime.date(2023, 1, 15)


def test_text_trims_spaces_only(cells):
    assert cells(text, ["  ", " Smith ", "\tx", "", None]) == [None, "Smith", "\tx", None, None]


def test_title_and_lower(cells):
    assert cells(title, ["FRANCE", "wEST gERMANY", " "]) == ["France", "West Germany", None]
    assert cells(lower_text, [" App_Bug", None]) == ["app_bug", None]


def test_currency(cells):
    values = ["$1,234.50", "-$5", "abc", " 7 ", "", None]
    assert cells(currency, values) == [1234.5, -5.0, None, 7.0, None, None]
    assert math.isnan(cells(currency, ["NaN"])[0])


def test_decimal(cells):
    assert cells(decimal, ["720.5", " 12 ", "soon", ""]) == [720.5, 12.0, None, None]


@pytest.mark.parametrize(
    ("cell", "expected"),
    [
        ("42", 42),
        ("42.0", 42),
        ("12.7", 12),
        ("-3.9", -3),
        ("+7", 7),
        (".5", 0),
        ("1e3", None),
        ("2147483648", None),
        ("2147483648.0", None),
        ("x", None),
        ("", None),
        (" 8 ", 8),
        ("1.2.3", None),
        ("-", None),
        (None, None),
    ],
)
def test_whole_number(cells, cell, expected):
    assert cells(whole_number, [cell]) == [expected]


def test_whole_number_long(cells):
    parse = partial(whole_number, type_name="long")
    assert cells(parse, ["2147483648", "9223372036854775808"]) == [2147483648, None]


@settings(
    max_examples=20,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.tuples(st.integers(-(2**31), 2**31 - 1), st.integers(0, 999)), min_size=1))
def test_whole_number_cuts_fractions(cells, pairs):
    values = [f"{whole}.{fraction}" for whole, fraction in pairs]
    assert cells(whole_number, values) == [whole for whole, _ in pairs]


def test_date_layouts(cells):
    values = ["2023-01-15", "2023/01/15", "15-01-2023", "01/15/2023", "15 Jan 2023", " 2023-01-15 "]
    assert cells(date, values) == [DAY] * len(values)


def test_date_ambiguous_and_invalid(cells):
    assert cells(date, ["05/06/2023", "05-06-2023"]) == [
        datetime.date(2023, 5, 6),
        datetime.date(2023, 6, 5),
    ]
    invalid = [
        "2023-02-30",
        "1/5/2023",
        "2023-01-15 10:00:00",
        "2023-01/15",
        "31 Jun 2023",
        "13/13/2023",
        "2023",
        "junk",
        "",
        None,
    ]
    assert cells(date, invalid) == [None] * len(invalid)


def test_flag(cells):
    assert cells(flag, ["YES", "y", "1", "True"]) == [1] * 4
    assert cells(flag, ["no", "N", "0", "false"]) == [0] * 4
    assert cells(flag, ["maybe", "", None]) == [None] * 3


def test_month(cells):
    assert cells(month, ["2025-10", "2025/10", "10/2025"]) == ["2025-10"] * 3
    invalid = ["2025-13", "2025-1", "Oct 2025", "13/2025", "10-2025", "", None]
    assert cells(month, invalid) == [None] * len(invalid)


def test_fingerprint_keeps_columns_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a")], "x string, y string")
    hashes = [row[0] for row in df.select(fingerprint(["x", "y"])).collect()]
    assert len(set(hashes)) == 3


def test_resolve_column(spark):
    df = spark.createDataFrame([(1,)], "customerid int")
    assert df.select(resolve_column(df, "CustomerId", "customerid")).first()[0] == 1
    with pytest.raises(ValueError, match="none of"):
        resolve_column(df, "absent")


def test_report_expressions(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2)], "part int, whole int")
    rows = df.select(
        guarded_ratio(F.col("part"), F.col("whole")).alias("ratio"),
        percent(F.lit(0.02675)).alias("percent"),
        segment(F.col("part"), ((2, "high"), (1, "middle")), "low").alias("segment"),
    ).collect()
    assert [row.ratio for row in rows] == [0.0, 0.5, 1.0]
    assert {row.percent for row in rows} == {2.68}
    assert [row.segment for row in rows] == ["low", "middle", "high"]
