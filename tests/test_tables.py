"""Edge cases of cleaning and of the result tables, expected by hand."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.inputs import invoices, requests, tidy
from revlake.functions import quantiles
from revlake.operators import cleaning, customers, geography, logs, metrics, products, profile, trends
from revlake.plans.build_tables import build_tables, result_tables
from revlake.sources.invoices import scan_date_range

SCHEMA = "invoice string, country string, customer_id long, stream_id string, price double, times_viewed int, date date"
D1, D2 = dt.date(2019, 1, 7), dt.date(2019, 1, 8)


def inv(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(price=2.0, invoice="i", country="France", customer=1, stream="s", views=1, date=D1):
    return (invoice, country, customer, stream, price, views, date)


def clean(spark, rows):
    return cleaning.clean_invoices(inv(spark, rows))


def test_single_row_cell(spark):
    r = metrics.daily_metrics(clean(spark, [row()])).first()
    assert (r["revenue_std_dev"], r["outlier_transactions"], r["data_quality_score"]) == (0.0, 0, 1.0)
    assert (r["median_transaction_value"], r["day_of_week"], r["unique_customers"]) == (2.0, 0, 1)


def test_daily_metrics_values(spark):
    rows = [row(1.0, "a", customer=1, stream="x", views=2), row(3.0, "a", customer=1, stream="y", views=4), row(5.0, "b", customer=None, stream="x", views=0), row(7.0, "c", customer=2, stream="x", views=0)]
    r = metrics.daily_metrics(clean(spark, rows)).first()
    assert (r["total_revenue"], r["median_transaction_value"], r["avg_customer_value"]) == (16.0, 4.0, 5.5)
    assert (r["unique_invoices"], r["unique_customers"], r["unique_products"], r["total_views"]) == (3, 2, 2, 6)
    assert r["avg_views_per_product"] == 3.0 and r["view_to_purchase_ratio"] == pytest.approx(4 / 6)
    assert r["data_quality_score"] == 0.75


def test_zero_variance_and_zero_views(spark):
    out = clean(spark, [row(views=0), row(views=0)])
    assert not any(r["is_price_outlier"] for r in out.collect())
    assert metrics.daily_metrics(out).first()["view_to_purchase_ratio"] == 0.0


def test_all_ids_missing(spark):
    out = clean(spark, [row(customer=None), row(customer=None)])
    assert metrics.customer_segments(out).count() == 0
    assert metrics.daily_metrics(out).first()["avg_customer_value"] == 0.0


def test_view_outlier(spark):
    out = clean(spark, [row(views=1)] * 20 + [row(views=1000)])
    assert out.where("is_view_outlier").count() == 1
    assert cleaning.cleaning_metrics(inv(spark, [row(views=1)] * 20 + [row(views=1000)])).first()["view_outliers"] == 1


def test_price_filter_keeps_unknown_prices(spark):
    rows = [row(p) for p in (0.0, 0.009, 0.01, 10000.0, 10000.01, None, float("nan"))]
    assert cleaning.price_filter(inv(spark, rows)).count() == 4
    m = cleaning.cleaning_metrics(inv(spark, rows + [row(0.0, customer=None)])).first()
    assert (m["total_records"], m["invalid_prices"], m["valid_records"], m["missing_customer_ids"]) == (8, 4, 4, 1)


def test_rank_ties(spark):
    out = metrics.product_performance(clean(spark, [row(5.0, stream="a"), row(5.0, stream="b"), row(3.0, stream="c")]))
    assert {r["stream_id"]: r["revenue_rank"] for r in out.collect()} == {"a": 1, "b": 1, "c": 2}
    assert {r["popularity_rank"] for r in out.collect()} == {1}


def test_segments(spark):
    rows = [row(float(s), customer=s) for s in range(1, 9)]
    r = metrics.customer_segments(clean(spark, rows)).first()
    # All frequencies are equal, so everyone is frequent; two customers reach the spend quartile 6.25.
    assert (r["champions_count"], r["loyal_customers_count"], r["new_customers_count"]) == (2, 6, 8)
    value = customers.value_quartile_segment(customers.customer_value(inv(spark, rows)))
    assert {x["segment"]: x["count"] for x in value.groupBy("segment").count().collect()} == {"Low Value": 2, "Medium Value": 2, "High Value": 2, "Premium": 2}


def test_quality_report_scopes_and_empty_input(spark):
    rows = [row(10.0, country="A"), row(10.0, country="A", customer=None, date=D2), row(20000.0, country="B"), row(1.0, country="B")]
    out = {r["country"]: r for r in metrics.quality_report(clean(spark, rows), cleaning.cleaning_metrics(inv(spark, rows))).collect()}
    assert set(out) == {"A", "B", None}
    assert out["A"]["completeness_score"] == 0.5 and out["A"]["accuracy_score"] == 0.75
    assert out[None]["total_records"] == 3 and out["B"]["revenue_z_score_max"] == 0.0
    empty = inv(spark, [])
    rows = metrics.quality_report(cleaning.clean_invoices(empty), cleaning.cleaning_metrics(empty)).collect()
    assert len(rows) == 1 and rows[0]["overall_quality_score"] == 0.0 and rows[0]["country"] is None


def test_l0_stats_count_a_missing_id_once(spark):
    r = metrics.l0_stats(inv(spark, [row(customer=1), row(customer=None), row(customer=None)])).first()
    assert r["unique_customer_id"] == 2


def test_new_and_returning_customers(spark):
    rows = [row(date=D1), row(date=D1), row(date=D2), row(date=D2, customer=2), row(date=D2, country="Spain")]
    out = {(r["date"], r["country"]): r for r in customers.new_vs_returning(inv(spark, rows)).collect()}
    assert (out[D1, "France"]["new_customers"], out[D1, "France"]["returning_customers"]) == (1, 0)
    second = out[D2, "France"]
    assert (second["new_customers"], second["returning_customers"], second["avg_recency_days"]) == (1, 1, 1.0)
    assert out[D2, "Spain"]["returning_customers"] == 1


def test_lifecycle_and_penetration(spark):
    rows = [row(date=D1), row(date=D2), row(customer=2, stream="t", date=D1)]
    r = customers.customer_lifecycle(customers.customer_value(inv(spark, rows))).first()
    assert (r["avg_days_active"], r["avg_days_between_purchases"]) == (0.5, 1.0)
    found = {(x["date"], x["stream_id"]): x["customer_penetration"] for x in metrics.customer_penetration(clean(spark, rows)).collect()}
    assert found == {(D1, "s"): 0.5, (D1, "t"): 0.5, (D2, "s"): 1.0}


def test_pareto(spark):
    df = spark.createDataFrame([("a", 80.0), ("b", 10.0), ("c", 10.0)], "k string, v double")
    curve = products.pareto(df, "k", "v")
    assert [r["cumulative"] for r in curve.orderBy("position").collect()] == [80.0, 90.0, 100.0]
    s = products.pareto_summary(curve, "v").first()
    assert (s["members"], s["members_for_80"], s["top10_share"]) == (3, 1, 100.0)


def test_profile(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (2.0, "x"), (9.0, "x")], "v double, t string")
    m = profile.moments(df, "v").first()
    assert (m["median"], m["mode"]) == (1.5, 1.0)
    values = pd.Series([1.0, 1.0, 2.0, 9.0])
    assert (m["skewness"], m["kurtosis"]) == pytest.approx((values.skew(), values.kurt()))
    assert profile.duplicate_count(df).first()[0] == 1
    assert {r["column"]: (r["null_count"], r["data_type"]) for r in profile.null_profile(df).collect()} == {"v": (0, "double"), "t": (2, "string")}
    bins = {r["bin"]: r["count"] for r in profile.histogram(df, "v", 4).collect()}
    assert bins == {0: 3, 1: 0, 2: 0, 3: 1}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r["count"] for r in profile.histogram(flat, "v", 5).collect()) == 2
    values = {r["column"]: r["values"] for r in profile.unique_values(df, ["t", "v"], most=2).collect()}
    assert values == {"t": ["x"], "v": None}


def test_month_growth_skips_empty_months(spark):
    months = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, 5.0)], "month int, total_revenue double")
    assert [r["growth"] for r in trends.month_growth(months).orderBy("month").collect()] == [None, None, -50.0]
    assert trends.month_over_month(months).first()["most_volatile"] == -50.0


def test_concentration(spark):
    markets = spark.createDataFrame([(c, float(v)) for c, v in zip("abcdef", (50, 20, 10, 10, 5, 5), strict=True)], "country string, total_revenue double")
    r = geography.concentration(markets).first()
    assert (r["top3_share"], r["top5_share"]) == (80.0, 95.0)
    assert {x["market"]: x["total_revenue"] for x in geography.with_others(markets, 4).collect()}["Others"] == 10.0


def test_samples(spark):
    df = spark.range(1000)
    assert cleaning.sample_rows(df, n=10).count() == 10
    part = cleaning.sample_rows(df, fraction=0.3).count()
    assert 200 < part < 400 and cleaning.sample_rows(df, fraction=0.3).count() == part


def test_build_tables_can_be_repeated(spark, tmp_path):
    rows = [row(float(p), customer=p % 3, stream=f"s{p % 2}", date=D1 if p % 2 else D2) for p in range(1, 20)]
    base = str(tmp_path)
    for _ in range(2):
        quality = build_tables(spark, inv(spark, rows), base, replace_dates=True)
    assert quality.first()["overall_quality_score"] == 1.0
    stored = spark.read.parquet(f"{base}/daily_aggregated_metrics")
    assert stored.count() == 2 and {"created_at", "updated_at"} <= set(stored.columns)
    assert spark.read.parquet(f"{base}/product_performance_metrics").count() == 2
    build_tables(spark, inv(spark, rows), f"{base}/appended", start="2019-01-08")
    build_tables(spark, inv(spark, rows), f"{base}/appended", start="2019-01-08")
    assert spark.read.parquet(f"{base}/appended/daily_aggregated_metrics").count() == 2
    assert set(result_tables(inv(spark, rows))) >= {"daily_aggregated_metrics", "data_quality_reports"}


def test_days_added_one_by_one_know_earlier_customers(spark, tmp_path):
    base = str(tmp_path / "tables")
    days = [("2024-01-01", [1, 2]), ("2024-01-20", [1, 3]), ("2024-06-01", [1, 2, 4])]
    rows = [(f"i{c}", "A", c, "s", 5.0, 1, 2024, int(d[5:7]), int(d[8:])) for d, known in days for c in known]
    df = spark.createDataFrame(rows, "invoice string, country string, customer_id long, stream_id string, price double, times_viewed int, year int, month int, day int")
    df = df.withColumn("date", F.make_date("year", "month", "day"))
    for day in [d for d, _ in days] + ["2024-06-01", "2024-01-20"]:
        build_tables(spark, df, base, day, day, replace_dates=True)
    daily = {str(r["date"]): r for r in spark.read.parquet(f"{base}/daily_aggregated_metrics").collect()}
    assert {d: (r["new_customers"], r["returning_customers"]) for d, r in daily.items()} == {"2024-01-01": (2, 0), "2024-01-20": (1, 1), "2024-06-01": (1, 2)}
    cell = {str(r["date"]): r for r in spark.read.parquet(f"{base}/customer_segment_metrics").collect()}["2024-06-01"]
    assert cell["cannot_lose_count"] == 2 and cell["avg_recency_days"] == pytest.approx((133 + 152) / 2)
    assert cell["customer_churn_risk_score"] == pytest.approx(2 / 3) and cell["customer_acquisition_rate"] == pytest.approx(1 / 3)
    assert {r["customer_penetration"] for r in spark.read.parquet(f"{base}/product_performance_metrics").collect()} == {1.0}
    assert spark.read.parquet(f"{base}/customer_visits").count() == 7


def test_iqr_flags_per_group(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 100.0), ("b", 101.0), ("b", 102.0)], "g string, v double")
    found = cleaning.flag_iqr_outliers(df, "v", ["g"]).where("v_iqr_outlier").collect()
    assert [(r["g"], r["v"]) for r in found] == [("a", 100.0)]
    assert cleaning.flag_iqr_outliers(df, "v").where(F.col("v_iqr_outlier")).count() == 0


def test_large_groups_take_the_split_plans_and_give_the_same(spark, sf, monkeypatch):
    """With a limit of three rows almost every day, country and endpoint counts as large."""
    def tables():
        raw = invoices(spark, sf)
        rows = cleaning.clean_invoices(raw)
        return [
            tidy(metrics.daily_metrics(rows)), tidy(metrics.customer_segments(rows)), tidy(metrics.product_performance(rows)),
            tidy(metrics.quality_report(rows, cleaning.cleaning_metrics(raw))), tidy(profile.boxplot_stats(raw, "price", ["month"])),
            tidy(logs.endpoint_metrics(requests(spark, sf))),
        ]

    def collected(frames):
        return [sorted(map(repr, f.collect())) for f in frames]

    usual = collected(tables())
    monkeypatch.setattr(quantiles, "PIECES", 3)
    assert collected(tables()) == usual


def test_date_ranges_prune_months(spark, tmp_path):
    path = str(tmp_path / "invoices")
    rows = [(2020 + i // 12, 1 + i % 12, i) for i in range(30)]
    df = spark.createDataFrame(rows, "year int, month int, v int").withColumn("date", F.make_date("year", "month", F.lit(15)))
    df.write.partitionBy("year", "month").parquet(path)
    out = scan_date_range(spark.read.parquet(path), "2020-05-01", "2020-06-15")
    assert sorted(r["v"] for r in out.collect()) == [4, 5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("],")[0]
    assert "year" in filters
    assert "month" in filters


def test_advice_reads_its_rows_three_times(spark):
    from revlake.operators import kpis

    rows = [("a", 1, "s", 10.0, 2), ("a", 2, "t", 30.0, 9), (None, None, None, 5.0, None), ("b", 2, "t", None, 1), ("c", 3, "u", 20.0, 1)]
    df = spark.createDataFrame(rows, "country string, customer_id long, stream_id string, price double, times_viewed int")
    seen = spark.sparkContext.accumulator(0)

    def looked(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    row = kpis.advice_inputs(df.mapInArrow(looked, df.schema)).first()
    assert seen.value <= 3 * len(rows)
    plain = df.agg(F.sum("price"), F.avg("price"), F.stddev_samp("price") / F.avg("price")).first()
    assert row["total_revenue"] == 65.0 and row["countries"] == 3 and row["high_engagement_share"] == 20.0
    assert abs(row["avg_transaction_value"] - plain[1]) < 1e-9 and abs(row["price_cv"] - plain[2]) < 1e-9
    assert abs(row["geographic_concentration"] - 60 / 65 * 100) < 1e-9


def test_quality_report_and_products_read_their_rows_once(spark):
    rows = [(dt.date(2024, 1, d), c, p, k, "s", False, False, 1) for d in (1, 2, 3) for c in "ab" for p, k in ((1.0, 1), (2.0, None), (2.0, 2))]
    df = spark.createDataFrame(rows, "date date, country string, price double, customer_id long, stream_id string, is_price_outlier boolean, is_view_outlier boolean, times_viewed int")
    run = spark.createDataFrame([(18, 6, 0, 0, 0)], "total_records long, missing_customer_ids long, price_outliers long, view_outliers long, invalid_prices long")
    seen = spark.sparkContext.accumulator(0)

    def looked(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    report = metrics.quality_report(df.mapInArrow(looked, df.schema), run).collect()
    assert {r["country"]: r["total_records"] for r in report} == {None: 18, "a": 9, "b": 9} and seen.value == 18
    ranked = metrics.product_performance(df.mapInArrow(looked, df.schema)).collect()
    assert {(r["transactions"], r["unique_customers"], r["revenue_rank"], r["popularity_rank"]) for r in ranked} == {(3, 2, 1, 1)}
    assert len(ranked) == 6 and seen.value == 36
