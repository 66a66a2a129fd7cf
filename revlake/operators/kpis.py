"""Headline figures of the business as one row, and the advice that follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.functions.columns import percent, safe_ratio
from revlake.functions.quantiles import quantile_row
from revlake.functions.ranking import top_share
from revlake.session import pinned


def kpi_summary(df: DataFrame) -> DataFrame:
    base = df.agg(
        F.sum("price").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("stream_id").alias("unique_products"),
        F.count_distinct("country").alias("countries"),
        F.sum("times_viewed").alias("total_views"),
    )
    customers = (
        df.where("customer_id is not null")
        .groupBy("customer_id")
        .agg(F.sum("price").alias("spent"), F.count(F.lit(1)).alias("n"))
    )
    cut = quantile_row(customers, "spent", [0.8], "_c")
    loyalty = customers.crossJoin(F.broadcast(cut)).agg(  # one row
        F.count_if(F.col("n") > 1).alias("repeat_customers"),
        F.avg("n").alias("avg_transactions_per_customer"),
        F.count_if(F.col("spent") > F.col("_c")[0]).alias("high_value_customers"),
    )
    return base.crossJoin(F.broadcast(loyalty)).select(  # one row
        "total_revenue",
        "total_transactions",
        "unique_customers",
        "unique_products",
        "countries",
        "total_views",
        safe_ratio("total_revenue", "total_transactions").alias("avg_transaction_value"),
        safe_ratio("total_revenue", "unique_customers").alias("revenue_per_customer"),
        "repeat_customers",
        percent("repeat_customers", "unique_customers").alias("retention_rate"),
        "avg_transactions_per_customer",
        "high_value_customers",
        safe_ratio("total_revenue", "total_views").alias("revenue_per_view"),
        safe_ratio("total_views", "total_transactions").alias("views_per_transaction"),
        (safe_ratio("total_transactions", "total_views") * 100).alias("conversion_rate"),
    )


def advice_inputs(df: DataFrame) -> DataFrame:
    """The one-row frame the advice rules read.

    ``df`` is read three times: customers, and counts by country and views, are stored in the shared folder,
    since readers of different columns would each compute them again.
    """
    customers = pinned(
        df.where("customer_id is not null")
        .groupBy("customer_id")
        .agg(F.sum("price").alias("spent"), F.count(F.lit(1)).alias("n")),
        "customers",
    )
    products = df.where("stream_id is not null").groupBy("stream_id").agg(F.sum("price").alias("spent"))
    viewed = pinned(
        df.groupBy("country", "times_viewed").agg(
            F.count(F.lit(1)).alias("n"),
            F.count("price").alias("priced"),
            F.sum("price").alias("spent"),
            F.avg("price").alias("mean"),
            F.var_pop("price").alias("variance"),
        ),
        "viewed",
    )
    countries = viewed.where("country is not null").groupBy("country").agg(F.sum("spent").alias("spent"))
    # One row per country.
    first_three = countries.orderBy(F.col("spent").desc(), "country").limit(3).agg(F.sum("spent").alias("_top3"))
    means = viewed.agg(
        F.try_divide(F.sum(F.col("times_viewed") * F.col("n")), F.sum(F.when(F.col("times_viewed").isNotNull(), F.col("n")))).alias("_m"),
        F.try_divide(F.sum("spent"), F.sum("priced")).alias("_mp"),
    )
    # Squares within the counted groups, and of their means.
    squares = F.sum(F.col("priced") * (F.col("variance") + (F.col("mean") - F.col("_mp")) * (F.col("mean") - F.col("_mp"))))
    deviation = F.when(F.sum("priced") > 1, F.sqrt(squares / (F.sum("priced") - 1)))
    often = F.sum(F.when(F.col("times_viewed") > 2 * F.col("_m"), F.col("n")).otherwise(0))
    prices = viewed.crossJoin(F.broadcast(means)).agg(  # one row
        F.sum("spent").alias("total_revenue"),
        F.max("_mp").alias("avg_transaction_value"),
        F.try_divide(deviation, F.max("_mp")).alias("price_cv"),
        percent(often, F.sum("n")).alias("high_engagement_share"),
    )
    loyalty = customers.agg(
        percent(F.count_if(F.col("n") == 1), F.count(F.lit(1))).alias("one_time_share"),
        percent(F.count_if(F.col("n") > 1), F.count(F.lit(1))).alias("retention_rate"),
    )
    geo = countries.agg(F.count(F.lit(1)).alias("countries"))
    out = prices
    # Every frame joined here has exactly one row.
    for one in (
        loyalty,
        geo,
        first_three,
        top_share(customers, "spent", 0.2).select(F.col("top").alias("_topc")),
        top_share(products, "spent", 0.2).select(F.col("top").alias("_topp")),
    ):
        out = out.crossJoin(F.broadcast(one))
    return out.select(
        "total_revenue",
        "avg_transaction_value",
        "price_cv",
        "high_engagement_share",
        "one_time_share",
        "retention_rate",
        "countries",
        percent("_topc", "total_revenue").alias("customer_concentration"),
        percent("_topp", "total_revenue").alias("product_concentration"),
        percent("_top3", "total_revenue").alias("geographic_concentration"),
    )


def business_advice(inputs: DataFrame) -> DataFrame:
    """One row per rule that fires: area, advice, and the figure behind it."""
    c = F.col
    # Thresholds and topics of the rules.
    rules = [
        ("opportunity", "Customer Retention Opportunity", "one_time_share", c("one_time_share") > 50),
        ("opportunity", "Portfolio Diversification", "product_concentration", c("product_concentration") > 80),
        ("opportunity", "Portfolio Optimization", "product_concentration", c("product_concentration") < 50),
        ("opportunity", "Geographic Expansion", "countries", c("countries") < 5),
        ("opportunity", "Price Strategy", "price_cv", c("price_cv") > 1),
        ("opportunity", "Engagement Optimization", "high_engagement_share", c("high_engagement_share") < 20),
        ("immediate", "Customer Retention Program", "retention_rate", c("retention_rate") < 50),
        ("immediate", "Revenue Per Transaction Optimization", "avg_transaction_value", c("avg_transaction_value") < 10),
        ("immediate", "Portfolio Review", "product_concentration", c("product_concentration") > 30),
        ("short_term", "Retention Focus", "retention_rate", c("retention_rate") < 30),
        ("short_term", "Acquisition Focus", "retention_rate", c("retention_rate") > 70),
        ("short_term", "Balanced Approach", "retention_rate", c("retention_rate").between(30, 70)),
        ("short_term", "Geographic Expansion", "countries", c("countries") < 10),
        ("long_term", "Growth Focus", "total_revenue", c("total_revenue") < 500_000),
        ("long_term", "Market Leadership", "total_revenue", (c("total_revenue") >= 500_000) & (c("total_revenue") < 1_000_000)),
        ("long_term", "Innovation Focus", "total_revenue", c("total_revenue") >= 1_000_000),
        ("risk", "Customer Concentration Risk", "customer_concentration", c("customer_concentration") > 70),
        ("risk", "Geographic Risk", "geographic_concentration", c("geographic_concentration") > 80),
        ("risk", "Product Risk", "product_concentration", c("product_concentration") > 80),
    ]
    fired = F.array_compact(
        F.array(
            *[
                F.when(
                    test,
                    F.struct(
                        F.lit(area).alias("area"),
                        F.lit(topic).alias("topic"),
                        F.lit(figure).alias("figure"),
                        c(figure).cast("double").alias("value"),
                    ),
                )
                for area, topic, figure, test in rules
            ]
        )
    )
    return inputs.select(F.explode(fired).alias("r")).select("r.*")
