"""What the physical plans must look like to hold at scale."""

import re

from pyspark.sql import functions as F

from checks.inputs import clean, invoices, raw_records
from revlake.operators import customers, ingest, logs, metrics, serving
from revlake.operators import series as ts
from revlake.sources.invoices import scan_date_range


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_and_columns_reach_the_scan(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("invoice"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.lit(1.0).alias("price"))
    rows.write.parquet(str(tmp_path / "t"))
    text = plan(scan_date_range(spark.read.parquet(str(tmp_path / "t")), "2020-01-03", "2020-01-05").agg(F.sum("price")))
    assert "GreaterThanOrEqual(date" in text and "LessThanOrEqual(date" in text
    assert "invoice" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_log_filters_reach_the_scan(spark, tmp_path):
    spark.sql("select timestamp'2024-01-01' as timestamp, 'INFO' as level, 'x' as message").write.parquet(str(tmp_path / "t"))
    text = plan(logs.filter_logs(spark.read.parquet(str(tmp_path / "t")), "2024-01-01", "2024-01-02", level="INFO"))
    assert "EqualTo(level,INFO)" in text and "LessThan(timestamp" in text


def test_copies_are_merged_before_the_shuffle(spark, sf):
    raw = ingest.accepted(ingest.parse_records(raw_records(spark, sf)))
    text = plan(ingest.dedupe_invoices(raw))
    assert text.count("partial_min") >= 1


def test_no_python_in_the_result_tables(spark, sf):
    for df in (metrics.daily_metrics(clean(spark, sf)), metrics.product_performance(clean(spark, sf)), metrics.customer_segments(clean(spark, sf))):
        assert "Python" not in plan(df) and "CartesianProduct" not in plan(df)


def test_windows_over_everything_see_buckets_only(spark, sf):
    """A ranking of all customers never sorts the customers in one task."""
    text = plan(customers.customer_ranks(customers.customer_value(invoices(spark, sf))))
    lone = [line for line in text.splitlines() if "Window [" in line and "customer_id" in line and "_b" not in line]
    assert not lone


def test_top_k_needs_no_global_sort(spark, sf):
    text = plan(serving.top_k(invoices(spark, sf).select("invoice", "price"), "price", 10, "invoice"))
    assert "TakeOrderedAndProject" in text


def test_series_features_shuffle_once_per_series(spark, sf):
    text = plan(ts.engineer_features(ts.revenue_series(invoices(spark, sf))))
    assert len(re.findall(r"Exchange hashpartitioning\(series#\d+, \d+\)", text)) == 1
    assert "SinglePartition" not in text


def test_ranks_of_products_are_stored_before_the_last_join(spark, sf):
    text = plan(metrics.product_performance(clean(spark, sf)))
    assert "Window" not in text and len(re.findall(r"Join", text)) == 1


def test_the_four_tables_are_made_from_one_join(spark, sf, monkeypatch):
    from checks import inputs, tables

    calls, lines = [], inputs.lines
    monkeypatch.setattr(inputs, "lines", lambda *a: calls.append(a) or lines(*a))
    assert tables.QUERIES["l3_stats"](spark, sf).count() == 4
    assert len(calls) == 1
