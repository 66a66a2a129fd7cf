"""The four result tables built from cleaned invoices, and statistics over stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import calendar_parts, round_total, safe_ratio
from revlake.functions.quantiles import exact_quantiles, exact_quantiles_of, null_safe, quantile_row
from revlake.functions.ranking import dense_ranks
from revlake.operators.cleaning import FENCE
from revlake.session import pinned

CELL = ["date", "country"]


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose grouping keys are all present."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def daily_metrics(clean: DataFrame) -> DataFrame:
    """Revenue, customer, product and quality figures per day and country."""
    rows = _keyed(clean, CELL)
    known = F.col("customer_id").isNotNull()
    cells = rows.groupBy(*CELL).agg(
        F.sum("price").alias("total_revenue"),
        F.avg("price").alias("avg_transaction_value"),
        F.min("price").alias("min_transaction_value"),
        F.max("price").alias("max_transaction_value"),
        F.coalesce(F.stddev_samp("price"), F.lit(0.0)).alias("revenue_std_dev"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_distinct("invoice").alias("unique_invoices"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("stream_id").alias("unique_products"),
        F.sum(F.when(known, F.col("price"))).alias("_known_revenue"),
        F.sum("times_viewed").alias("total_views"),
        # Views of rows without a product are in the total but in no product's sum.
        F.sum(F.when(F.col("stream_id").isNotNull(), F.col("times_viewed"))).alias("_product_views"),
        F.count_if(F.col("is_price_outlier") | F.col("is_view_outlier")).alias("outlier_transactions"),
        F.count_if(~known).alias("missing_customer_ids"),
    )
    medians = exact_quantiles(rows, "price", [0.5], CELL)
    bad = F.col("outlier_transactions") + F.col("missing_customer_ids")
    parts = calendar_parts("date")
    return cells.join(medians, CELL, "left").select(
        *CELL,
        *[parts[p].alias(p) for p in ("year", "month", "day", "day_of_week", "week_of_year")],
        "total_revenue",
        "avg_transaction_value",
        "min_transaction_value",
        "max_transaction_value",
        F.col("q")[0].alias("median_transaction_value"),
        "revenue_std_dev",
        "total_transactions",
        "unique_invoices",
        "unique_customers",
        "unique_products",
        safe_ratio("_known_revenue", "unique_customers").alias("avg_customer_value"),
        "total_views",
        safe_ratio("_product_views", "unique_products").alias("avg_views_per_product"),
        safe_ratio("total_transactions", "total_views").alias("view_to_purchase_ratio"),
        (1 - bad / F.col("total_transactions")).alias("data_quality_score"),
        "outlier_transactions",
        "missing_customer_ids",
        F.col("total_transactions").alias("source_record_count"),
    )


def _ranked_customers(clean: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Spend and frequency per day, country and customer; who is in the cell's upper quartile of each."""
    customers = (
        _keyed(clean, [*CELL, "customer_id"])
        .groupBy(*CELL, "customer_id")
        .agg(round_total(F.sum("price")).alias("spend"), F.count(F.lit(1)).alias("frequency"))
    )
    cuts = exact_quantiles_of(customers, ["spend", "frequency"], [0.75], CELL)
    cuts = cuts.select(*CELL, F.col("spend")[0].alias("_spend_cut"), F.col("frequency")[0].alias("_often_cut"))
    return customers.join(cuts, CELL), F.col("spend") >= F.col("_spend_cut"), F.col("frequency") >= F.col("_often_cut")


def customer_segments(clean: DataFrame) -> DataFrame:
    """Champions and loyal customers per day and country, by the cell's upper spend and frequency quartile."""
    customers, rich, loyal = _ranked_customers(clean)
    return customers.groupBy(*CELL).agg(
        F.avg("frequency").alias("avg_frequency"),
        F.avg("spend").alias("avg_monetary_value"),
        F.count_if(rich & loyal).alias("champions_count"),
        F.count_if(loyal & ~rich).alias("loyal_customers_count"),
        F.count(F.lit(1)).alias("new_customers_count"),
        F.avg("spend").alias("avg_customer_lifetime_value"),
    )


# Fixed values of this library: days since the last purchase that count as recent, and as long ago.
RECENT_DAYS, LONG_AGO_DAYS = 30, 90


def customer_visits(clean: DataFrame) -> DataFrame:
    """``customer_id, date, country`` once for every day, country and customer with a purchase."""
    return _keyed(clean, [*CELL, "customer_id"]).select("customer_id", "date", "country").distinct()


def with_previous_visit(visits: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """``visits`` with ``previous``: the customer's last day before, anywhere, among ``visits`` and ``earlier``.

    ``earlier`` holds visits of other days; only those of the customers in ``visits`` take part.
    """
    rows = visits.withColumn("_own", F.lit(True))
    if earlier is not None:
        known = earlier.join(visits.select("customer_id").distinct(), "customer_id", "left_semi")
        rows = rows.unionByName(known.select("customer_id", "date", "country").withColumn("_own", F.lit(False)))
    before = W.partitionBy("customer_id").orderBy(F.unix_date("date")).rangeBetween(W.unboundedPreceding, -1)
    return rows.withColumn("previous", F.max("date").over(before)).where("_own").drop("_own")


def visit_metrics(visits: DataFrame) -> DataFrame:
    """New and returning customers and their share, per day and country, from ``with_previous_visit``."""
    new = F.col("previous").isNull()
    counts = visits.groupBy(*CELL).agg(F.count_if(new).alias("new_customers"), F.count_if(~new).alias("returning_customers"))
    both = F.col("new_customers") + F.col("returning_customers")
    return counts.withColumn("customer_retention_rate", safe_ratio("returning_customers", both))


def recency_segments(clean: DataFrame, visits: DataFrame) -> DataFrame:
    """Segments that depend on the last purchase before the day, per day and country.

    Potential loyalists came back within ``RECENT_DAYS`` without being among the frequent or the dear.
    Of those who had been away for over ``LONG_AGO_DAYS``, frequent ones are at risk, dear ones cannot be lost, and
    the others hibernate. Churn risk is the mean of the days away over ``LONG_AGO_DAYS``, 1 at most; new
    customers have none.
    """
    customers, rich, loyal = _ranked_customers(clean)
    away = F.datediff("date", "previous")
    returned = away.isNotNull()
    recent, long_ago = returned & (away <= RECENT_DAYS), returned & (away > LONG_AGO_DAYS)
    both = customers.join(visits, [*CELL, "customer_id"])
    return both.groupBy(*CELL).agg(
        F.coalesce(F.avg(away), F.lit(0.0)).alias("avg_recency_days"),
        F.count_if(recent & ~rich & ~loyal).alias("potential_loyalists_count"),
        F.count_if(long_ago & loyal & ~rich).alias("at_risk_count"),
        F.count_if(long_ago & rich).alias("cannot_lose_count"),
        F.count_if(long_ago & ~rich & ~loyal).alias("hibernating_count"),
        (F.count_if(~returned) / F.count(F.lit(1))).alias("customer_acquisition_rate"),
        F.avg(F.when(returned, F.least(F.lit(1.0), away / LONG_AGO_DAYS)).otherwise(0.0)).alias("customer_churn_risk_score"),
    )


def product_performance(clean: DataFrame) -> DataFrame:
    """Sales and views per day, country and product, with dense ranks inside the cell."""
    rows = _keyed(clean, [*CELL, "stream_id"])
    products = (
        rows.groupBy(*CELL, "stream_id")
        .agg(
            F.sum("price").alias("revenue"),
            F.count(F.lit(1)).alias("transactions"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("times_viewed").alias("total_views"),
            F.avg("price").alias("avg_price"),
        )
        .withColumn("conversion_rate", safe_ratio("transactions", "total_views"))
    )
    # Stored: ranking reads the two ranked columns, then all of them.
    return product_ranks(pinned(products, "products"), store=True)


def product_ranks(products: DataFrame, store: bool = False) -> DataFrame:
    """Dense ranks by revenue and by transactions within day and country, largest first. For ``store`` see ``dense_ranks``."""
    return dense_ranks(products, {"revenue": "revenue_rank", "transactions": "popularity_rank"}, CELL, store)


def customer_penetration(clean: DataFrame) -> DataFrame:
    """Share of the cell's customers who bought each product."""
    known = _keyed(clean, [*CELL])
    products = (
        _keyed(known, ["stream_id"])
        .groupBy(*CELL, "stream_id")
        .agg(F.count_distinct("customer_id").alias("unique_customers"))
    )
    cells = known.groupBy(*CELL).agg(F.count_distinct("customer_id").alias("cell_customers"))
    return products.join(cells, CELL).withColumn(
        "customer_penetration", safe_ratio("unique_customers", "cell_customers")
    )


def _price_counts(rows: DataFrame) -> DataFrame:
    """Rows per country, day and price: all that the quality report needs, its source read once."""
    return rows.groupBy("country", "date", "price").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer_ids"),
        F.count_if("is_price_outlier").alias("price_outliers"),
        F.count_if("is_view_outlier").alias("view_count_outliers"),
    )


def _day_counts(prices: DataFrame) -> DataFrame:
    """Counts and revenue per country and day."""
    return prices.groupBy("country", "date").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.col("price") * F.col("rows")).alias("revenue"),
        *[F.sum(c).alias(c) for c in ("missing_customer_ids", "price_outliers", "view_count_outliers")],
    )


def _daily_anomalies(days: DataFrame) -> DataFrame:
    """Per country and for all (null): revenue and volume days beyond two deviations."""
    days = days.where("date is not null").select(F.lit(0).alias("scope"), "country", "date", "revenue", "rows")
    whole = days.groupBy("date").agg(F.sum("revenue").alias("revenue"), F.sum("rows").alias("rows"))
    both = days.unionByName(whole.select(F.lit(1).alias("scope"), F.lit(None).cast("string").alias("country"), "*"))
    stats = both.groupBy("scope", "country").agg(
        *[fn(c).alias(f"_{tag}_{c}") for c in ("revenue", "rows") for tag, fn in (("m", F.avg), ("s", F.stddev_samp))]
    )
    z = {c: F.abs(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}"))) for c in ("revenue", "rows")}
    return (
        null_safe(both, stats, ["scope", "country"], "inner")
        .groupBy("scope", "country")
        .agg(
            F.coalesce(F.max(z["revenue"]), F.lit(0.0)).alias("revenue_z_score_max"),
            F.count_if(z["revenue"] > 2).alias("revenue_anomalies"),
            F.count_if(z["rows"] > 2).alias("volume_anomalies"),
        )
    )


def volume_anomalies(clean: DataFrame) -> DataFrame:
    """Days with an unusual number of transactions, per country and overall (country null)."""
    return _daily_anomalies(_day_counts(_price_counts(_keyed(clean, CELL)))).select("country", "volume_anomalies")


def _iqr_counts(prices: DataFrame) -> DataFrame:
    """Price outliers by the fences of each country, and by those of all rows (country null)."""
    prices = prices.groupBy("country", "price").agg(F.sum("rows").alias("rows"))
    own = exact_quantiles(prices, "price", [0.25, 0.75], ["country"], weight="rows")
    everyone = quantile_row(prices, "price", [0.25, 0.75], "_all", weight="rows")
    fences = own.crossJoin(F.broadcast(everyone)).withColumnRenamed("country", "_country")  # one row

    def outside(q: str) -> Column:
        low, high = F.col(q)[0], F.col(q)[1]
        return (F.col("price") < low - FENCE * (high - low)) | (F.col("price") > high + FENCE * (high - low))

    def within(q: str) -> Column:
        return F.sum(F.when(outside(q), F.col("rows")).otherwise(0))

    counts = prices.join(fences, F.col("country") == F.col("_country")).groupBy("country").agg(
        within("q").alias("price_iqr_outliers"), within("_all").alias("_overall")
    )
    overall = counts.agg(F.sum("_overall").alias("price_iqr_outliers"))
    return counts.select(F.lit(0).alias("scope"), "country", "price_iqr_outliers").unionByName(
        overall.select(F.lit(1).alias("scope"), F.lit(None).cast("string").alias("country"), "price_iqr_outliers")
    )


def quality_report(clean: DataFrame, metrics: DataFrame) -> DataFrame:
    """Quality scores and anomaly counts per country, and for all rows where country is null.

    ``metrics`` is the one-row frame of ``cleaning_metrics``. An empty input gives one row with scores of
    zero and the counts of the run.
    """
    # Stored: the readers below use different columns, and each would count the rows again.
    prices = pinned(_price_counts(_keyed(clean, ["country"])), "prices")
    days = _day_counts(prices)
    counts = ["total_records", "missing_customer_ids", "price_outliers", "view_count_outliers"]
    per_country = days.withColumnRenamed("rows", "total_records").groupBy("country").agg(
        *[F.sum(c).alias(c) for c in counts]
    )
    # A global aggregate yields a row for empty input too.
    overall = per_country.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    scopes = per_country.select(F.lit(0).alias("scope"), "country", *counts).unionByName(
        overall.select(F.lit(1).alias("scope"), F.lit(None).cast("string").alias("country"), *counts)
    )
    keys = ["scope", "country"]
    joined = null_safe(null_safe(scopes, _daily_anomalies(days), keys, "left"), _iqr_counts(prices), keys, "left")
    counted_in_run = ["total_records", "missing_customer_ids", "price_outliers", "view_outliers", "invalid_prices"]
    # One row whatever ``metrics`` holds.
    run = metrics.agg(*[F.max(c).alias(f"_run_{c}") for c in counted_in_run])
    some = F.col("total_records") > 0

    def or_run(column: str, in_run: str) -> Column:
        return F.when(some, F.col(column)).otherwise(F.col(f"_run_{in_run}")).alias(column)

    completeness = F.when(some, 1 - F.col("missing_customer_ids") / F.col("total_records")).otherwise(0.0)
    consistency = F.when(some, 1.0).otherwise(0.0)
    accuracy = F.when(some, 1 - safe_ratio("_run_invalid_prices", "_run_total_records")).otherwise(0.0)
    scored = joined.crossJoin(F.broadcast(run)).select(  # one row
        "country",
        or_run("total_records", "total_records"),
        F.col("total_records").alias("valid_records"),
        or_run("missing_customer_ids", "missing_customer_ids"),
        F.col("_run_invalid_prices").alias("invalid_prices"),
        F.lit(0).alias("invalid_dates"),
        completeness.alias("completeness_score"),
        consistency.alias("consistency_score"),
        accuracy.alias("accuracy_score"),
        F.coalesce("revenue_anomalies", F.lit(0)).alias("revenue_anomalies"),
        F.coalesce("volume_anomalies", F.lit(0)).alias("volume_anomalies"),
        or_run("price_outliers", "price_outliers"),
        or_run("view_count_outliers", "view_outliers"),
        F.coalesce("revenue_z_score_max", F.lit(0.0)).alias("revenue_z_score_max"),
        F.coalesce("price_iqr_outliers", F.lit(0)).alias("price_iqr_outliers"),
    )
    mean = (F.col("completeness_score") + F.col("consistency_score") + F.col("accuracy_score")) / 3
    return scored.withColumn("overall_quality_score", mean)


def l0_stats(df: DataFrame) -> DataFrame:
    """Row count, distinct values (a null id counts as one) and date range."""
    def distinct(c):
        return (F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(f"unique_{c}")

    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[distinct(c) for c in ("invoice", "customer_id", "country", "stream_id")],
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )


def l3_stats(daily: DataFrame, segments: DataFrame, products: DataFrame, quality: DataFrame) -> DataFrame:
    """One row per result table: rows, and where it has them revenue, date range, mean quality."""

    def row(df: DataFrame, name: str, **known) -> DataFrame:
        shape = {"total_revenue": "double", "min_date": "date", "max_date": "date", "avg_quality": "double"}
        return df.agg(
            F.count(F.lit(1)).alias("records"),
            *[known.get(c, F.max(F.lit(None).cast(t))).alias(c) for c, t in shape.items()],
        ).select(F.lit(name).alias("table_name"), "records", *shape)

    dates = {"min_date": F.min("date"), "max_date": F.max("date")}
    return (
        row(daily, "daily_aggregated_metrics", total_revenue=F.sum("total_revenue"), **dates)
        .unionByName(row(segments, "customer_segment_metrics", **dates))
        .unionByName(row(products, "product_performance_metrics", total_revenue=F.sum("revenue"), **dates))
        .unionByName(row(quality, "data_quality_reports", avg_quality=F.avg("overall_quality_score")))
    )
