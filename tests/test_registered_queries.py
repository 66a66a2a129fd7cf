"""Registered queries against their SQL in DuckDB, on the smallest tables.

By default a cross-section runs; ``--all-queries`` runs every one.
"""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DEFAULT = """normalize_fields dedupe_invoices normalize_country redact_json clean_invoices cleaning_metrics daily_metrics customer_segments
product_performance quality_report business_metrics moments histogram unique_values boxplot_stats country_revenue market_classes customer_ranks
top_bottom_share rfm_segments pareto month_over_month kpi_summary daily_ts engineer_features range_features forecast_seasonal_trend
rolling_origin_accuracy ljung_box endpoint_metrics performance_drift_test data_drift concept_drift log_activity_stream""".split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def pytest_generate_tests(metafunc):
    if "name" in metafunc.fixturenames:
        chosen = sorted(ORACLES) if metafunc.config.getoption("--all-queries") else DEFAULT
        metafunc.parametrize("name", chosen)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(float(r[i]) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), columns)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 150


def test_entry(spark):
    assert entry.entry(spark).count() > 0
