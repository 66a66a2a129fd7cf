"""From the invoice table to the four result tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.operators.cleaning import clean_invoices, cleaning_metrics, cleaning_stats, overall_quality_score
from revlake.operators.metrics import (
    CELL,
    customer_penetration,
    customer_segments,
    customer_visits,
    daily_metrics,
    product_performance,
    quality_report,
    recency_segments,
    visit_metrics,
    with_previous_visit,
)
from revlake.session import pinned
from revlake.sources.invoices import scan_date_range, table_exists, write_l3


class Tables(Mapping):
    """Frames by name, each made when it is first asked for: some store what they read several times."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def result_tables(invoices: DataFrame, start=None, end=None, earlier: DataFrame | None = None) -> Tables:
    """Frames of the four tables, of the days' customer visits, and of the run's quality score.

    ``earlier`` holds visits of other days, for new and returning customers. The mean and deviation behind
    the outlier flags are computed once and stored (one row); all plans read them. The invoices
    themselves are not cached: each plan's scan reads only its own columns, which costs no more than
    reading a cached copy.
    """
    rows = scan_date_range(invoices, start, end)
    stats = pinned(cleaning_stats(rows), "stats")
    clean = clean_invoices(rows, stats)
    metrics = cleaning_metrics(rows, stats)
    visits = customer_visits(clean)
    known = with_previous_visit(visits, earlier)
    counts = ["new_customers", "returning_customers", "customer_retention_rate"]

    def products() -> DataFrame:
        penetration = customer_penetration(clean).select(*CELL, "stream_id", "customer_penetration")
        return product_performance(clean).join(penetration, [*CELL, "stream_id"])

    return Tables({
        "daily_aggregated_metrics": lambda: daily_metrics(clean).join(visit_metrics(known), CELL, "left").na.fill(0, counts),
        "customer_segment_metrics": lambda: customer_segments(clean).join(recency_segments(clean, known), CELL),
        "product_performance_metrics": products,
        "data_quality_reports": lambda: quality_report(clean, metrics),
        "customer_visits": lambda: visits,
        "run_quality": lambda: overall_quality_score(metrics),
    })


def _other_visits(spark: SparkSession, path: str, invoices: DataFrame, start, end) -> DataFrame | None:
    """Stored visits of the days that this run does not compute."""
    if not table_exists(spark, path):
        return None
    days = scan_date_range(invoices, start, end).select("date").distinct()
    return spark.read.parquet(path).join(days, "date", "left_anti")


def build_tables(
    spark: SparkSession, invoices: DataFrame, base: str, start=None, end=None, replace_dates: bool = False
) -> DataFrame:
    """Write the four tables below ``base``; returns the run's quality score as one row.

    A run over some days (``start``, ``end``) adds to what is there: a table of customer visits by day is kept
    beside the results, so that new and returning customers are known without the old invoices. With
    ``replace_dates`` a repeated run leaves the tables as they are. Days already stored are not
    computed again when older days are added later.
    """
    visits = f"{base}/customer_visits"
    tables = result_tables(invoices, start, end, _other_visits(spark, visits, invoices, start, end))
    for name in ("daily_aggregated_metrics", "customer_segment_metrics", "product_performance_metrics"):
        write_l3(tables[name], f"{base}/{name}", updated=name.startswith("daily"), replace_dates=replace_dates)
    report = tables["data_quality_reports"].withColumn("report_date", F.current_date())
    write_l3(report, f"{base}/data_quality_reports", replace_dates=replace_dates, by="report_date")
    # Last: until the results are there, a repeated run sees the old visits.
    tables["customer_visits"].hint("rebalance", "date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("date").parquet(visits)
    return tables["run_quality"]
