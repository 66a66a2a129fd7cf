import datetime as dt

import pytest
from pyspark.sql import functions as F

from revlake.functions import columns as C


def values(spark, kind, rows, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, c {kind}")
    return [r[0] for r in df.select(expr(F.col("c")).alias("x"), "i").orderBy("i").select("x").collect()]


@pytest.mark.parametrize(
    ("expr", "kind", "rows", "expected"),
    [
        (C.strip_non_digits, "string", ["C12-3", "abc", None], ["123", "", None]),
        (C.stream_category, "string", ["post", "DOT", "12A", "12", "12a", None], ["Special", "Special", "Alphanumeric", "Numeric", "Other", "Other"]),
        (C.slug_country, "string", ["United  Kingdom", "EIRE"], ["united_kingdom", "eire"]),
        (C.view_bucket, "int", [-1, 0, 1, 2, 5, 6, 20, 21, None], [None, "1 view", "1 view", "2-5 views", "2-5 views", "6-10 views", "11-20 views", "20+ views", None]),
        # Halves go to the even neighbour, and 0.575 is below its half in binary.
        (C.round_even, "double", [0.575, 2.5, 0.125, 0.375, -0.125], [0.57, 2.5, 0.12, 0.38, -0.12]),
        (C.two_decimals, "double", [1.0, 2.345678], ["1.00", "2.35"]),
        (C.title_case, "string", ["  united kingdom "], ["United Kingdom"]),
        (C.sanitize_text, "string", [" <b>'x';\\\" "], ["bx"]),
    ],
)
def test_column_functions(spark, expr, kind, rows, expected):
    assert values(spark, kind, rows, expr) == expected


def test_settled_totals_do_not_depend_on_the_last_bits(spark):
    a, b = 636490.5 / 100, 636490.4999999999 / 100
    assert len(set(values(spark, "double", [a, b], C.round_total))) == 1


def test_dates(spark):
    df = spark.createDataFrame([(2024, 2, 30), (2024, 2, 29), (None, 1, 1)], "y int, m int, d int")
    found = [r[0] for r in df.select(C.make_invoice_date("y", "m", "d")).collect()]
    assert found == [None, dt.date(2024, 2, 29), None]
    day = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date")
    parts = day.select(*[c.alias(n) for n, c in C.calendar_parts("d").items()], C.day_name("d").alias("name"), C.month_name("d").alias("month_name")).first()
    assert (parts["day_of_week"], parts["week_of_year"], parts["name"], parts["month_name"]) == (0, 1, "Monday", "Dec")
    flags = day.select(*[c.alias(n) for n, c in C.seasonal_flags("d").items()]).first()
    assert tuple(flags) == (0, 0, 1)


def test_ratios(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 4), (1.0, -2), (1.0, None)], "a double, b int")
    assert [r[0] for r in df.select(C.safe_ratio("a", "b")).collect()] == [0.0, 0.25, 0.0, 0.0]


def test_details(spark):
    found = values(spark, "string", ['{"a": 1}', "{bad", None], C.parse_details)
    assert found == [{"a": "1"}, {}, {}]
