"""Cleaning rules, outlier flags and the counts that describe a cleaning run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.columns import col, finite, safe_ratio
from revlake.functions.quantiles import exact_quantiles, null_safe, quantile_rows

# Accepted price range, z-score limit, IQR fence factor.
MIN_PRICE = 0.01
MAX_PRICE = 10_000.0
Z_LIMIT = 3.0
FENCE = 1.5


def price_out_of_range(c="price") -> Column:
    """True below the minimum or above the maximum; null and NaN are not out of range."""
    c = col(c)
    return F.coalesce(~F.isnan(c) & ((c < MIN_PRICE) | (c > MAX_PRICE)), F.lit(False))


def price_filter(df: DataFrame) -> DataFrame:
    return df.where(~price_out_of_range())


def outlier_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample deviation of each column as one row, from one pass."""
    return df.agg(
        *[F.avg(finite(c)).alias(f"_m_{c}") for c in columns],
        *[F.stddev_samp(finite(c)).alias(f"_s_{c}") for c in columns],
    )


def _one_row(stats: DataFrame) -> DataFrame:
    """Stored statistics as one row, whatever the frame holds."""
    return stats.agg(*[F.max(c).alias(c) for c in stats.columns])


def _zscore_outlier(c: str, limit: float = Z_LIMIT) -> Column:
    """The flag of one column on rows joined with ``outlier_stats``."""
    z = F.abs(F.try_divide(finite(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")))
    return F.coalesce(z > limit, F.lit(False))


def flag_zscore_outliers(
    df: DataFrame, columns: str | list[str], limit: float = Z_LIMIT, stats: DataFrame | None = None
) -> DataFrame:
    """Add ``<column>_outlier`` for values more than ``limit`` sample deviations from the mean.

    ``stats`` may hold the result of ``outlier_stats`` when several plans share it.
    """
    columns = [columns] if isinstance(columns, str) else columns
    stats = outlier_stats(df, columns) if stats is None else _one_row(stats)
    out = df.crossJoin(F.broadcast(stats))  # one row
    return out.withColumns({f"{c}_outlier": _zscore_outlier(c, limit) for c in columns}).drop(*stats.columns)


def flag_iqr_outliers(df: DataFrame, column: str, keys: list[str] | None = None) -> DataFrame:
    """Add ``<column>_iqr_outlier``: outside the quartile fences of the frame or of the row's group."""
    fences = exact_quantiles(df, column, [0.25, 0.75], keys or [])
    low, high = F.col("q")[0], F.col("q")[1]
    flag = (col(column) < low - FENCE * (high - low)) | (col(column) > high + FENCE * (high - low))
    if keys:
        joined = null_safe(df, fences, keys, "left")
    else:
        joined = df.crossJoin(F.broadcast(fences.agg(F.max("q").alias("q"))))  # one row
    return joined.withColumn(f"{column}_iqr_outlier", F.coalesce(flag, F.lit(False))).drop("q")


def flag_missing_customer(df: DataFrame) -> DataFrame:
    return df.withColumn("has_customer_id", F.col("customer_id").isNotNull())


def cast_clean_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "price": F.col("price").cast("double"),
            "times_viewed": F.col("times_viewed").cast("int"),
            "customer_id": F.col("customer_id").cast("long"),
        }
    )


FLAGGED = ["price", "times_viewed"]


def cleaning_stats(df: DataFrame) -> DataFrame:
    """The statistics behind the outlier flags of ``clean_invoices``, one row."""
    return outlier_stats(price_filter(cast_clean_types(df)), FLAGGED)


def clean_invoices(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Flag missing customers, drop prices out of range, flag price and view outliers, fix types."""
    kept = cast_clean_types(price_filter(flag_missing_customer(df)))
    return flag_zscore_outliers(kept, FLAGGED, stats=stats).withColumnsRenamed(
        {"price_outlier": "is_price_outlier", "times_viewed_outlier": "is_view_outlier"}
    )


def cleaning_metrics(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Counts of a cleaning run as one row. Missing ids count before the price filter.

    Takes the raw frame: one pass for the statistics, one for the counts.
    """
    stats = cleaning_stats(df) if stats is None else _one_row(stats)
    good = ~price_out_of_range()
    return cast_clean_types(df).crossJoin(F.broadcast(stats)).agg(  # one row
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer_ids"),
        F.count_if(~good).alias("invalid_prices"),
        F.count_if(good & _zscore_outlier("price")).alias("price_outliers"),
        F.count_if(good & _zscore_outlier("times_viewed")).alias("view_outliers"),
        F.count_if(good).alias("valid_records"),
    )


def overall_quality_score(metrics: DataFrame) -> DataFrame:
    """Valid over total records of a run."""
    return metrics.select(
        "total_records", "valid_records", safe_ratio("valid_records", "total_records").alias("overall_quality_score")
    )


def high_engagement(df: DataFrame) -> DataFrame:
    """Counts and prices of heavily viewed rows, and of dear but little viewed ones."""
    cuts = quantile_rows(df, {"_vq": "times_viewed", "_pq": "price"}, [0.8])
    mean = df.agg(F.avg("times_viewed").alias("_vm"))
    one_row = cuts.crossJoin(F.broadcast(mean))
    marked = df.crossJoin(F.broadcast(one_row))  # one row
    top = F.col("times_viewed") > F.col("_vq")[0]
    dear = (F.col("price") > F.col("_pq")[0]) & (F.col("times_viewed") <= 2)
    busy = F.col("times_viewed") > 2 * F.col("_vm")
    return marked.agg(
        F.count_if(top).alias("high_engagement"),
        F.avg(F.when(top, F.col("price"))).alias("high_engagement_avg_price"),
        F.avg("price").alias("avg_price"),
        F.count_if(dear).alias("high_price_low_engagement"),
        F.avg(F.when(dear, F.col("price"))).alias("high_price_low_engagement_avg_price"),
        (F.count_if(busy) / F.count(F.lit(1)) * 100).alias("busy_share"),
    )


def sample_rows(df: DataFrame, fraction: float | None = None, n: int | None = None, seed: int = 42) -> DataFrame:
    """A random share of the rows, or exactly ``n`` rows, without replacement."""
    if n is not None:
        return df.orderBy(F.rand(seed)).limit(n)
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
