"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_non_digits(c) -> Column:
    return F.regexp_replace(col(c), r"\D+", "")


def stream_category(c) -> Column:
    """Special, Alphanumeric, Numeric or Other, tested in that order; null is Other."""
    c = col(c)
    return (
        F.when(F.upper(c).isin("DOT", "POST"), "Special")
        .when(c.rlike("[A-Z]"), "Alphanumeric")
        .when(c.rlike(r"^\d+$"), "Numeric")
        .otherwise("Other")
    )


def slug_country(c) -> Column:
    return F.regexp_replace(F.lower(col(c)), r"\s+", "_")


def title_case(c) -> Column:
    return F.initcap(F.trim(col(c)))


def date_text(year, month, day) -> Column:
    """``YYYY-MM-DD`` from whole numbers; null when a part is null."""
    parts = [F.lpad(col(c).cast("string"), n, "0") for c, n in ((year, 4), (month, 2), (day, 2))]
    return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2])


def make_invoice_date(year, month, day) -> Column:
    """Date from parts, null when they name no calendar day."""
    return F.try_to_date(date_text(year, month, day), "yyyy-MM-dd")


def year_month(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def calendar_parts(d) -> dict[str, Column]:
    """year, month, day, day_of_week (Monday is 0), ISO week, hour."""
    d = col(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "week_of_year": F.weekofyear(d),
        "hour": F.hour(d),
    }


def seasonal_flags(d) -> dict[str, Column]:
    d = col(d)
    return {
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_month_start": (F.dayofmonth(d) <= 3).cast("int"),
        "is_month_end": (F.dayofmonth(d) >= 28).cast("int"),
    }


def month_name(d) -> Column:
    return F.date_format(col(d), "MMM")


def day_name(d) -> Column:
    return F.date_format(col(d), "EEEE")


def view_bucket(c) -> Column:
    """Right-closed view classes; negative counts have none."""
    c = col(c)
    return (
        F.when(c < 0, F.lit(None))
        .when(c <= 1, "1 view")
        .when(c <= 5, "2-5 views")
        .when(c <= 10, "6-10 views")
        .when(c <= 20, "11-20 views")
        .when(c.isNotNull(), "20+ views")
    )


def round_even(c, digits: int = 2) -> Column:
    """Round a double the numpy way: scale, half to even, scale back."""
    scale = F.lit(float(10**digits))
    return F.rint(col(c) * scale) / scale


def round_total(c, digits: int = 2) -> Column:
    """``round_even`` for sums and means of many rows.

    The last bits of a distributed sum depend on the order of its parts. Settling it to six decimals
    first gives the same two decimals again when a task is repeated.
    """
    return round_even(F.round(col(c), 6), digits)


def safe_ratio(a, b) -> Column:
    """a / b where b is positive, else 0."""
    b = col(b)
    return F.coalesce(F.try_divide(col(a).cast("double"), F.when(b > 0, b)), F.lit(0.0))


def percent(a, b) -> Column:
    return F.try_divide(col(a).cast("double"), col(b)) * 100


def finite(c) -> Column:
    """The value as double, null when NaN or infinite."""
    c = col(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def two_decimals(c) -> Column:
    return F.format_string("%.2f", col(c))


def log_forward(c, positive) -> Column:
    """log1p where the series flag ``positive`` holds."""
    return F.when(col(positive), F.log1p(col(c))).otherwise(col(c))


def log_inverse(c, positive) -> Column:
    return F.when(col(positive), F.expm1(col(c))).otherwise(col(c))


def parse_details(c) -> Column:
    """JSON text as a string map; unreadable text is an empty map."""
    parsed = F.from_json(col(c), "map<string,string>")
    return F.coalesce(parsed, F.from_json(F.lit("{}"), "map<string,string>"))


# Fixed value: longest text accepted after sanitising.
LONGEST_TEXT = 255


def sanitize_text(c, longest: int = LONGEST_TEXT) -> Column:
    """The trimmed text without characters that have a meaning in markup or SQL; null if longer than ``longest``."""
    clean = F.regexp_replace(F.trim(col(c)), "[<>\"';\\\\]", "")
    return F.when(F.length(clean) <= longest, clean)


def text_error(c, longest: int = LONGEST_TEXT) -> Column:
    """Why ``sanitize_text`` accepts no text, null where it does."""
    too_long = F.format_string(f"Input too long. Maximum {longest} characters allowed")
    return F.when(col(c).isNull(), "Input must be a string").when(sanitize_text(c, longest).isNull(), too_long)


def priority_order(c) -> Column:
    """Sort key: high, medium, low, anything else."""
    c = col(c)
    return F.when(c == "high", 0).when(c == "medium", 1).when(c == "low", 2).otherwise(3)
