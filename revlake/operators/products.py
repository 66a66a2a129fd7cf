"""Product (stream) performance, categories, premium products, Pareto curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.functions.columns import percent, round_even, round_total, stream_category
from revlake.functions.quantiles import quantile_row
from revlake.functions.ranking import running_totals, top_share


def stream_performance(df: DataFrame) -> DataFrame:
    """Revenue, price, views and customers per product, largest revenue first."""
    base = (
        df.where("stream_id is not null")
        .groupBy("stream_id")
        .agg(
            round_total(F.sum("price")).alias("total_revenue"),
            round_total(F.avg("price")).alias("avg_price"),
            F.count("price").alias("transactions"),
            round_total(F.stddev_samp("price")).alias("price_std"),
            F.sum("times_viewed").alias("total_views"),
            round_total(F.avg("times_viewed")).alias("avg_views"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    return base.select(
        "*",
        round_even(F.try_divide("total_revenue", "unique_customers")).alias("revenue_per_customer"),
        round_even(F.try_divide("total_views", "transactions")).alias("views_per_transaction"),
    ).orderBy(F.col("total_revenue").desc(), "stream_id")


def stream_category_performance(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(stream_category("stream_id").alias("stream_category"))
        .agg(
            round_total(F.sum("price")).alias("total_revenue"),
            round_total(F.avg("price")).alias("avg_price"),
            F.count("price").alias("transactions"),
            F.sum("times_viewed").alias("total_views"),
        )
        .orderBy(F.col("total_revenue").desc(), "stream_category")
    )


def premium_streams(streams: DataFrame) -> DataFrame:
    """Products whose mean price exceeds the 80 % quantile of all mean prices."""
    cut = quantile_row(streams, "avg_price", [0.8], "_c")
    return (
        streams.crossJoin(F.broadcast(cut))  # one row
        .where(F.col("avg_price") > F.col("_c")[0])
        .agg(
            F.count(F.lit(1)).alias("premium_streams"),
            F.avg("avg_price").alias("avg_price"),
            F.sum("total_revenue").alias("total_revenue"),
        )
    )


def product_revenue(df: DataFrame) -> DataFrame:
    return df.where("stream_id is not null").groupBy("stream_id").agg(F.sum("price").alias("revenue"))


def product_portfolio(products: DataFrame) -> DataFrame:
    """Mean revenue per product, and revenue share of the best fifth of the products."""
    return top_share(products, "revenue", 0.2).select(
        F.col("n").alias("products"),
        F.try_divide("total", "n").alias("avg_revenue_per_product"),
        percent("top", "total").alias("top_fifth_share"),
    )


def pareto(frame: DataFrame, key: str, value: str) -> DataFrame:
    """Cumulative revenue and share, largest first; ties go by key."""
    return running_totals(frame.select(key, value), value, key).select(
        key,
        value,
        F.col("row_number").alias("position"),
        F.col("running").alias("cumulative"),
        percent("running", "total").alias("cumulative_percent"),
        "total",
    )


def pareto_summary(curve: DataFrame, value: str) -> DataFrame:
    """Members within the first 80 % of revenue, and the shares of the first 10 and 50."""
    n = F.count(F.lit(1))
    within = F.count_if(F.col("cumulative_percent") <= 80)

    def share(k):
        return percent(F.sum(F.when(F.col("position") <= k, F.col(value))), F.sum(value))

    return curve.agg(
        n.alias("members"),
        within.alias("members_for_80"),
        percent(within, n).alias("members_for_80_percent"),
        share(10).alias("top10_share"),
        share(50).alias("top50_share"),
    )
