"""Queries over the daily result table: summaries, country statistics, model input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.functions.columns import two_decimals
from revlake.sources.invoices import scan_date_range


def _of_country(df: DataFrame, country: str | None) -> DataFrame:
    return df if country is None else df.where(F.col("country") == country)


def data_summary(daily: DataFrame, country: str | None = None) -> DataFrame:
    """Days, date range, revenue, transactions and countries as one row."""
    return _of_country(daily, country).agg(
        F.count(F.lit(1)).alias("total_days"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_transactions").alias("total_transactions"),
        F.count_distinct("country").alias("countries"),
    )


def country_stats(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("total_revenue").alias("total_revenue"),
            F.avg("total_revenue").alias("avg_daily_revenue"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
        )
        .orderBy(F.col("total_revenue").desc(), "country")
    )


def business_metrics(daily: DataFrame, country: str | None = None, start=None, end=None) -> DataFrame:
    """Daily averages, extremes and sample deviation of revenue over a country and period."""
    return scan_date_range(_of_country(daily, country), start, end).agg(
        F.avg("total_revenue").alias("avg_daily_revenue"),
        F.avg("total_transactions").alias("avg_daily_transactions"),
        F.avg("unique_customers").alias("avg_daily_customers"),
        F.avg("avg_transaction_value").alias("avg_order_value"),
        F.sum("total_revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_days"),
        F.max("total_revenue").alias("max_daily_revenue"),
        F.min("total_revenue").alias("min_daily_revenue"),
        F.stddev_samp("total_revenue").alias("revenue_std_dev"),
    )


def verify_summary(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct("country").alias("countries"),
        two_decimals(F.sum("total_revenue")).alias("total_revenue"),
        F.sum("total_transactions").alias("total_transactions"),
    )


def top_countries(daily: DataFrame, n: int = 5) -> DataFrame:
    return (
        daily.groupBy("country")
        .agg(
            F.sum("total_revenue").alias("revenue"),
            F.sum("total_transactions").alias("transactions"),
            F.avg("unique_customers").alias("avg_customers"),
        )
        .orderBy(F.col("revenue").desc(), "country")
        .limit(n)
    )


def metric_rows(daily: DataFrame) -> DataFrame:
    """Long form: one row per day, country and metric."""
    return daily.select(
        "date",
        "country",
        (F.col("total_revenue") / F.greatest("unique_customers", F.lit(1))).alias("revenue_per_customer"),
        (F.col("unique_customers") / F.greatest("unique_invoices", F.lit(1))).alias("customer_acquisition_rate"),
    ).unpivot(
        ["date", "country"],
        ["revenue_per_customer", "customer_acquisition_rate"],
        "metric_name",
        "metric_value",
    )


def project_series(daily: DataFrame, country: str | None = None, start=None, end=None) -> DataFrame:
    """Model input columns of one country (or all), in date order."""
    return (
        scan_date_range(_of_country(daily, country), start, end)
        .select(
            "country",
            F.col("date").alias("ds"),
            F.col("total_revenue").alias("y"),
            F.col("total_transactions").alias("transactions"),
            F.col("unique_customers").alias("customers"),
            F.col("avg_transaction_value").alias("avg_order_value"),
            "day_of_week",
            "week_of_year",
            "month",
            "year",
        )
        .orderBy("country", "ds")
    )


def lookback_window(daily: DataFrame, country: str, end, days: int = 90) -> DataFrame:
    """Rows of one country from ``days`` before ``end`` up to ``end``."""
    end = F.lit(end).cast("date")
    return daily.where((F.col("country") == country) & F.col("date").between(F.date_sub(end, days), end))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def top_k(df: DataFrame, column: str, k: int, tiebreak: str) -> DataFrame:
    """The k rows with the largest values; ties go by ``tiebreak``."""
    return df.orderBy(F.col(column).desc_nulls_last(), tiebreak).limit(k)
