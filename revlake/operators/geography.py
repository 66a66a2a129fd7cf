"""Country revenue, shares, concentration and market classes. Frames here have one row per country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import percent, round_even, round_total


def _all():
    """Window over all countries: one row per country after the first aggregation, so it stays small."""
    return W.partitionBy(F.lit(0))


def country_revenue(df: DataFrame) -> DataFrame:
    """Revenue, transactions, customers, views, market share and efficiency per country."""
    base = (
        df.where("country is not null")
        .groupBy("country")
        .agg(
            round_total(F.sum("price")).alias("total_revenue"),
            F.count("price").alias("transactions"),
            round_total(F.avg("price")).alias("avg_price"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("times_viewed").alias("total_views"),
        )
    )
    return base.select(
        "*",
        round_even(percent("total_revenue", F.sum("total_revenue").over(_all()))).alias("market_share"),
        round_even(F.try_divide("total_revenue", "unique_customers")).alias("revenue_per_customer"),
        round_even(F.try_divide("total_revenue", "transactions")).alias("revenue_per_transaction"),
    ).orderBy(F.col("total_revenue").desc(), "country")


def _positions(markets: DataFrame) -> DataFrame:
    order = _all().orderBy(F.col("total_revenue").desc(), "country")
    return markets.withColumn("position", F.row_number().over(order))


def concentration(markets: DataFrame) -> DataFrame:
    """Shares of the first three and five countries, diversity index, number of countries."""
    ranked = _positions(markets)
    total = F.sum("total_revenue")
    first = {n: F.sum(F.when(F.col("position") <= n, F.col("total_revenue"))) for n in (3, 5)}
    return ranked.agg(
        F.count(F.lit(1)).alias("countries"),
        percent(first[3], total).alias("top3_share"),
        percent(first[5], total).alias("top5_share"),
        (1 - F.try_divide(first[5], total)).alias("diversity_index"),
    )


def with_others(markets: DataFrame, n: int = 10) -> DataFrame:
    """The first n countries, and the rest summed as Others."""
    label = F.when(F.col("position") <= n, F.col("country")).otherwise("Others")
    return _positions(markets).groupBy(label.alias("market")).agg(F.sum("total_revenue").alias("total_revenue"))


def market_classes(markets: DataFrame) -> DataFrame:
    """Country flags: high value, volume growth, above-mean value and volume, growth market."""
    limits = markets.agg(
        # One value per country.
        F.percentile("revenue_per_customer", F.lit(0.75)).alias("_rc75"),
        F.median("revenue_per_customer").alias("_rc50"),
        F.avg("revenue_per_customer").alias("_rcm"),
        F.median("transactions").alias("_t50"),
        F.avg("transactions").alias("_tm"),
        F.median("revenue_per_transaction").alias("_rt50"),
    )
    per_customer, rows = F.col("revenue_per_customer"), F.col("transactions")

    def flag(condition):
        return F.coalesce(condition, F.lit(False))

    return markets.crossJoin(F.broadcast(limits)).select(  # one row
        "country",
        flag(per_customer >= F.col("_rc75")).alias("high_value"),
        flag((rows > F.col("_t50")) & (per_customer < F.col("_rc50"))).alias("volume_growth"),
        flag(per_customer > F.col("_rcm")).alias("above_mean_value"),
        flag(rows > F.col("_tm")).alias("above_mean_volume"),
        flag((rows > F.col("_tm")) & (F.col("revenue_per_transaction") < F.col("_rt50"))).alias("growth_market"),
    )


def coefficient_of_variation(df: DataFrame, column: str) -> DataFrame:
    cv = F.try_divide(F.stddev_samp(column), F.avg(column))
    return df.agg(cv.alias("cv")).withColumn("stability", F.when(F.col("cv") < 1, "Stable").otherwise("Volatile"))


def country_engagement(markets: DataFrame, n: int = 5) -> DataFrame:
    """Countries with the most views per transaction."""
    per_row = round_even(F.try_divide("total_views", "transactions"))
    return (
        markets.select("country", per_row.alias("views_per_transaction"))
        .orderBy(F.col("views_per_transaction").desc(), "country")
        .limit(n)
    )
