import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from revlake.operators import autoregressive as ar
from revlake.operators import clustering, evaluation, forecasting, registry, supervised
from revlake.operators import series as ts

DAY = dt.date(2023, 1, 1)


def day(i):
    return DAY + dt.timedelta(days=i)


def frame(spark, values, name="a", start=0):
    return spark.createDataFrame([(name, day(start + i), v) for i, v in enumerate(values)], "series string, ds date, y double")


def weekly(n=200, trend=1.0):
    return [1000 + trend * i + 200 * (1 if (DAY + dt.timedelta(days=i)).weekday() < 5 else -1) for i in range(n)]


def ys(df, column="y"):
    return [r[0] for r in df.orderBy("series", "ds").select(column).collect()]


def test_gap_series(spark):
    df = spark.createDataFrame([("a", day(0), 1.0), ("a", day(2), 3.0)], "series string, ds date, y double")
    assert ys(ts.complete_calendar(df)) == [1.0, 0.0, 3.0]


def test_month_spine_drops_the_last_month(spark):
    df = spark.createDataFrame([("a", dt.date(2023, 1, 15)), ("a", dt.date(2023, 3, 2)), ("b", dt.date(2023, 5, 1))], "series string, date date")
    days = [r[0] for r in ts.month_spine(df).where("series = 'a'").orderBy("date").select("date").collect()]
    assert (days[0], days[-1], len(days)) == (dt.date(2023, 1, 1), dt.date(2023, 2, 28), 59)
    assert ts.month_spine(df).where("series = 'b'").count() == 0


def test_range_features_look_back_by_days(spark):
    rows = [("a", day(i), v, 1, 1) for i, v in ((1, 1.0), (2, 2.0), (9, 4.0))]
    df = ts.range_features(spark.createDataFrame(rows, "series string, date date, revenue double, unique_invoices int, total_views int"))
    out = df.orderBy("date").collect()
    assert [r["previous_7"] for r in out] == [0.0, 1.0, 2.0]
    assert [r["target"] for r in out] == [7.0, 6.0, 4.0]


def test_growth_from_zero_is_filled(spark):
    grown = ts.growth_rates(frame(spark, [0.0, 5.0]))
    assert ys(grown, "y_growth_1d") == [None, None]
    assert ys(ts.backfill(grown, ["y_growth_1d"]), "y_growth_1d") == [0.0, 0.0]


def test_backfill_takes_the_next_finite_value(spark):
    assert ys(ts.backfill(frame(spark, [None, math.nan, 2.0, math.inf, None]), ["y"])) == [2.0, 2.0, 2.0, 0.0, 0.0]


def test_interpolation_matches_pandas(spark):
    values = [None, 1.0, None, None, 4.0, None]
    expected = pd.Series(values, dtype=float).interpolate().tolist()
    found = ys(ts.interpolate_linear(frame(spark, values)))
    assert found[0] is None and found[1:] == pytest.approx(expected[1:])


def test_prepare_series_keeps_nine_of_eleven(spark):
    rows = [("a", day(i), None if i == 2 else 100.0 * i, i) for i in range(10)] + [("a", day(4), 550.0, 10)]
    df = spark.createDataFrame(rows, "series string, ds date, y double, seq int")
    out = ts.prepare_series(df, "seq")
    assert out.count() == 9 and out.where(F.col("ds") == day(4)).first()["y"] == 550.0


def test_training_filter(spark):
    values = [10.0] * 60 + [-1.0, None, 1e6]
    assert ts.filter_training_series(frame(spark, values)).count() == 60
    assert ts.filter_training_series(frame(spark, [1.0] * 29)).count() == 0


def test_rolling_and_differences_match_pandas(spark):
    values = [float((i * 7) % 11) for i in range(40)]
    s = pd.Series(values)
    out = ts.rolling_features(frame(spark, values))
    assert ys(out, "y_rolling_mean_7") == pytest.approx(s.rolling(7, min_periods=1).mean().tolist())
    assert ys(out, "y_rolling_std_14")[1:] == pytest.approx(s.rolling(14, min_periods=1).std().tolist()[1:])
    assert ys(ts.difference(frame(spark, values), 2)) == pytest.approx(s.diff().diff().dropna().tolist())


def test_splits(spark):
    df = frame(spark, [1.0] * 50)
    assert ts.split_last_share(df).where("is_test").count() == 10
    assert ts.split_last_days(df).where("is_test").count() == 30


def test_perfect_forecast(spark):
    df = frame(spark, [100.0, 200.0, 300.0, 400.0, 500.0]).withColumn("yhat", F.col("y"))
    r = evaluation.accuracy_metrics(df).first()
    assert (r["mae"], r["rmse"], r["mape"]) == (0.0, 0.0, 0.0) and r["r2"] == pytest.approx(1.0)
    single = evaluation.accuracy_metrics(df.limit(1)).first()
    assert math.isinf(single["mase"])


def test_seasonal_trend_recovers_its_own_pattern(spark):
    out = forecasting.forecast_seasonal_trend(frame(spark, weekly(364)), 14).orderBy("ds").collect()
    truth = weekly(378)[364:]
    assert len(out) == 14
    for r, y in zip(out, truth, strict=True):
        assert r["lower"] <= r["yhat"] <= r["upper"] and r["yhat"] == pytest.approx(y, rel=0.05)


def test_one_day_series_is_forecast_flat(spark):
    out = forecasting.forecast_seasonal_trend(frame(spark, [5.0]), 3).collect()
    assert [r["yhat"] for r in out] == [5.0, 5.0, 5.0]


def test_cutoffs_need_history(spark):
    assert forecasting.cutoffs(frame(spark, [1.0] * 1094)).count() == 0
    found = sorted(r["cutoff"] for r in forecasting.cutoffs(frame(spark, [1.0] * 1100)).collect())
    # 1,099 days long, 180 of them horizon: 919 days, 730 of them history, so room for two steps back.
    assert found == [day(1099 - 180 - 180), day(1099 - 180 - 90), day(1099 - 180)]


@pytest.mark.parametrize("order", [(1, 0, False), (2, 1, True), (0, 2, False), (0, 0, False), (5, 2, True)])
def test_ar_forecasts_are_ordered_and_finite(spark, order):
    rng = np.random.default_rng(3)
    df = frame(spark, (np.array(weekly(200)) + rng.normal(0, 20, 200)).tolist())
    out = ar.forecast_ar(df, 21, order=order).orderBy("ds").collect()
    assert [r["ds"] for r in out] == [day(200 + i) for i in range(21)]
    assert all(np.isfinite([r["lower"], r["yhat"], r["upper"]]).all() and r["lower"] <= r["yhat"] <= r["upper"] for r in out)


def test_ar_follows_a_line_and_a_season():
    line = np.arange(1.0, 101.0) - 50
    mean, low, high = ar.recursive_forecast(line, 1, 1, False, 5, 0.95)
    assert mean == pytest.approx([51, 52, 53, 54, 55])
    season = np.tile([1.0, -2.0, 3.0, 0.0, 5.0, -6.0, 7.0], 12)
    mean, _, _ = ar.recursive_forecast(season, 0, 0, True, 7, 0.95)
    assert mean == pytest.approx(season[:7])


def test_ar_intervals_of_a_random_walk_grow_with_the_root_of_the_horizon():
    rng = np.random.default_rng(1)
    walk = np.cumsum(rng.normal(size=400))
    mean, low, high = ar.recursive_forecast(walk, 0, 1, False, 16, 0.95)
    width = high - low
    assert width[15] / width[0] == pytest.approx(4.0)


def test_short_series_get_no_ar_forecast(spark):
    assert ar.forecast_ar(frame(spark, [1.0] * 49), 5).count() == 0


def test_order_search_prefers_the_true_order(spark):
    rng = np.random.default_rng(5)
    z = [0.0, 0.0]
    for _ in range(500):
        z.append(1.2 * z[-1] - 0.6 * z[-2] + rng.normal())
    grid = [(p, d, False) for p in (0, 1, 2) for d in (0, 1)]
    best = ar.grid_search_order(frame(spark, z), grid, "bic").first()
    assert (best["p"], best["d"]) == (2, 0)


def test_stationarity(spark):
    rng = np.random.default_rng(2)
    noise = rng.normal(size=300)
    df = frame(spark, noise.tolist(), "noise").unionByName(frame(spark, np.cumsum(noise).tolist(), "walk"))
    assert {r["series"]: r["d"] for r in evaluation.stationary_order(df).collect()} == {"noise": 0, "walk": 1}


def exact_tail(q, k):
    """The same tail from ``math.erfc`` and the recurrence."""
    half = q / 2
    if k % 2 == 0:
        return sum(math.exp(-half) * half**i / math.factorial(i) for i in range(k // 2))
    return math.erfc(math.sqrt(half)) + sum(math.exp(-half) * half ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, (k + 1) // 2))


def test_chi_square_tail(spark):
    values = [0.0, 1e-9, 0.3, 1.0, 3.841458820694124, 5.991464547107979, 11.070497693516351, 17.9, 18.1, 18.307038053275146, 60.0, 500.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (1e9,)], "q double")
    out = df.select("q", *[evaluation.chi_square_tail(F.col("q"), k).alias(str(k)) for k in range(1, 11)])
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        for k in range(1, 11):
            if r["q"] is None:
                assert r[str(k)] is None
            else:
                assert r[str(k)] == pytest.approx(exact_tail(r["q"], k) if r["q"] < 1e6 else 0.0, rel=1e-9, abs=1e-300)
    known = {r["q"]: r for r in out.collect()}
    assert known[3.841458820694124]["1"] == pytest.approx(0.05) and known[18.307038053275146]["10"] == pytest.approx(0.05)


def test_residual_diagnostics_tell_noise_from_a_season(spark):
    rng = np.random.default_rng(4)
    rows = frame(spark, rng.normal(size=200).tolist(), "noise").unionByName(frame(spark, weekly(200, 0.0), "season"))
    out = {r["series"]: r for r in evaluation.residual_diagnostics(rows.withColumnRenamed("y", "residual")).collect()}
    assert out["season"]["autocorrelated"] and out["season"]["min_p"] < 1e-6
    assert 0 <= out["noise"]["min_p"] <= 1


def test_registry_runs_added_models(spark):
    def last_value(history, horizon, interval):
        first = pd.Timestamp(history["ds"].max()) + pd.Timedelta(days=1)
        y = history["y"].iloc[-1]
        return pd.DataFrame({"series": history["series"].iloc[0], "ds": pd.date_range(first, periods=horizon).date, "yhat": y, "lower": y, "upper": y})

    registry.register_per_series("last_value", last_value)
    df = frame(spark, weekly(100)).unionByName(frame(spark, weekly(80), "b"))
    out = registry.run_models(df, ["seasonal_trend", "ensemble", "last_value"], horizon=5)
    assert {(r["series"], r["model"]): r["count"] for r in out.groupBy("series", "model").count().collect()} == {(s, m): 5 for s in "ab" for m in ("seasonal_trend", "ensemble", "last_value")}


def test_supervised_forecast(spark):
    rows = [("all", day(i), 100.0 + i % 7, 3 + i % 2, 10 + i % 5) for i in range(260)]
    df = spark.createDataFrame(rows, "series string, date date, revenue double, unique_invoices int, total_views int")
    features = ts.range_features(df).persist()
    model, rmse = supervised.train_supervised(ts.trim_training(features), trees=[5], folds=2)
    assert rmse < 200
    wanted = spark.createDataFrame([("all", day(200)), ("all", day(999))], "series string, date date")
    found, missing = supervised.predict_on_date(model, features, wanted)
    assert [r["date"] for r in found.collect()] == [day(200)] and [r["date"] for r in missing.collect()] == [day(999)]
    assert found.first()["prediction"] == pytest.approx(30 * 103, rel=0.1)


def test_clusters_partition_the_customers(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(m + rng.normal()), 1) for i, m in enumerate([10] * 15 + [1000] * 15 + [5000] * 15)]
    df = spark.createDataFrame([(c, p, v, "s") for c, p, v in rows], "customer_id long, price double, times_viewed int, stream_id string")
    features = clustering.customer_features(df)
    out = clustering.kmeans_customers(features, k=3, restarts=3)
    groups = out.groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in groups) == [15, 15, 15]
    again = clustering.kmeans_customers(features, k=3, restarts=3)
    assert sorted(map(tuple, out.select("customer_id", "cluster").collect())) == sorted(map(tuple, again.select("customer_id", "cluster").collect()))
    # Neither the order of the rows nor their distribution matters, and groups without overlap are found.
    rng.shuffle(rows)
    moved = spark.createDataFrame([(c, p, v, "s") for c, p, v in rows], df.schema)
    for parts in (1, 7):
        placed = clustering.kmeans_customers(clustering.customer_features(moved).repartition(parts, "total_revenue"), k=3, restarts=3)
        assert sorted(map(tuple, placed.select("customer_id", "cluster").collect())) == sorted(map(tuple, out.select("customer_id", "cluster").collect()))
    profile = clustering.cluster_profile(out)
    assert sum(r["members"] for r in profile.collect()) == 45 and "VIP" not in {r["profile"] for r in profile.collect()}
    assert clustering.kmeans_customers(features.limit(9)).count() == 0
    costs = [r["cost"] for r in clustering.elbow(features, clustering.CUSTOMER_FEATURES).orderBy("k").collect()]
    assert len(costs) == 8 and costs[0] > costs[-1]


def test_supervised_models_of_every_series(spark, sf):
    from checks import timeseries
    from revlake.session import pinned

    table = pinned(timeseries.features(spark, sf), "features")
    names = {r["series"] for r in table.select("series").distinct().collect()}
    assert len(names) == 11
    models = supervised.train_each(ts.trim_training(table), trees=[3], folds=2)
    assert "all" in models and len(models) > 1
    out = supervised.forecast_each(models, table).groupBy("series").agg(F.count("prediction").alias("n"), F.count("*").alias("rows")).collect()
    assert {r["series"] for r in out} == names
    assert all(r["n"] == (r["rows"] if r["series"] in models else 0) for r in out)
    found, missing = supervised.predict_each_on_date(models, table, table.select("series", F.date_add("date", 1).alias("date")))
    assert {r["series"] for r in found.select("series").distinct().collect()} == names
    assert missing.count() == len(names)


def test_series_without_a_fit_have_a_reason(spark):
    values = [100.0 + i % 7 + i % 5 for i in range(60)]
    df = frame(spark, values).unionByName(frame(spark, values[:49], "short")).unionByName(frame(spark, [*values[:-1], float("inf")], "inf"))
    wanted = {"a": None, "short": "49 days, fewer than 50", "inf": "1 values missing or not finite"}
    for work in (ar.forecast_ar, ar.score_orders, ar.grid_search_order):
        out = work(df, reasons=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FlatMapGroupsInPandas") == 1 and "Join" not in plan
        rows = out.select("series", "reason").distinct().collect()
        assert {r["series"]: r["reason"] for r in rows} == wanted and len(rows) == 3
        assert {r["series"] for r in work(df).collect()} == {"a"}
        found = ar.with_reasons(work(df), ar.reasons(df)).select("series", "reason").distinct().collect()
        assert {r["series"]: r["reason"] for r in found} == wanted
    held = ar.forecast_ar(df, 5, orders=ar.grid_search_order(df), reasons=True).select("series", "reason").distinct().collect()
    assert {r["series"]: r["reason"] for r in held} == wanted
    out = registry.run_models(df, ["autoregressive", "ensemble"], horizon=5).collect()
    for model in ("autoregressive", "ensemble"):
        assert {r["series"]: r["reason"] for r in out if r["model"] == model} == wanted
        assert sum(r["yhat"] is None for r in out if r["model"] == model) == 2


def direct_criteria(y, p, d, seasonal):
    """The same criteria from a least-squares fit of each order by itself."""
    z, _ = ar._scaled(y)
    lags = ar._lags(p, seasonal)
    _, error = ar._fit(np.diff(z, n=d) if d else z, lags, ar.MAX_LAG + 2 - d)
    n, k = len(error), len(lags) + 2
    base = n * np.log(max(float(error @ error) / n, 1e-300))
    return [base + 2 * k, base + k * np.log(n), base + 2 * k * np.log(np.log(n))]


def test_all_orders_from_one_matrix_equal_fits_of_their_own(spark):
    rng = np.random.default_rng(8)
    season = np.tile([5.0, 1.0, 3.0, 2.0, 8.0, 9.0, 4.0], 60)
    values = {"noisy": 1e4 + 300 * season + rng.normal(0, 200, 420), "walk": np.cumsum(rng.normal(size=300)), "line": np.arange(1.0, 61.0), "flat": np.full(80, 7.0), "short": np.arange(50.0) ** 2}
    df = None
    for name, y in values.items():
        one = frame(spark, y.tolist(), name)
        df = one if df is None else df.unionByName(one)
    scores = ar.score_orders(df)
    assert scores._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    rows = scores.collect()
    assert len(rows) == len(values) * len(ar.GRID) and len(ar.GRID) == 36
    for r in rows:
        wanted = direct_criteria(values[r["series"]], r["p"], r["d"], r["seasonal"])
        n = len(values[r["series"]])
        if wanted[0] < -25 * n:  # an exact fit: both are as good as nothing
            assert r["aic"] < -25 * n
        else:
            assert [r["aic"], r["bic"], r["hqic"]] == pytest.approx(wanted, rel=1e-6, abs=1e-4)


def test_an_explosive_path_is_infinite(spark):
    out = ar.forecast_ar(frame(spark, np.exp(np.linspace(0, 600, 60) ** 1.0).tolist()), 200, order=(1, 1, False)).orderBy("ds").collect()
    assert len(out) == 200 and out[-1]["yhat"] == float("inf")


def test_reasons_of_other_models_use_their_rows_once(spark):
    df = frame(spark, [1.0] * 60).unionByName(frame(spark, [2.0] * 3, "b"))
    registry.register_per_series("long_only", lambda pdf, horizon, interval: pd.DataFrame({"series": pdf.series[:1], "ds": pdf.ds[-1:].tolist(), "yhat": 1.0, "lower": 0.0, "upper": 2.0}) if len(pdf) > 9 else pd.DataFrame(columns=["series", "ds", "yhat", "lower", "upper"]))
    out = registry.run_models(df, ["long_only"])
    assert out._jdf.queryExecution().executedPlan().toString().count("FlatMapGroupsInPandas") == 1
    assert {r["series"]: r["reason"] for r in out.collect()} == {"a": None, "b": "no row of the model"}


def test_elbow_and_searched_orders_do_the_whole_search(spark, monkeypatch):
    from checks import timeseries

    rows = [(i, float(i % 3 * 100 + i), float(i), float(i % 4), float(i % 5)) for i in range(20)]
    df = spark.createDataFrame(rows, ["customer_id", *clustering.CUSTOMER_FEATURES])
    starts, started = clustering._starts, []
    monkeypatch.setattr(clustering, "_starts", lambda rows, k, seed: started.append(k) or starts(rows, k, seed))
    assert [r["k"] for r in clustering.elbow(df, clustering.CUSTOMER_FEATURES).collect()] == [2, 3, 4]
    assert sorted(started) == sorted([2, 3, 4] * clustering.RESTARTS)
    grids, search = [], ar.grid_search_order
    monkeypatch.setattr(ar, "grid_search_order", lambda d, grid=ar.GRID: grids.append(grid) or search(d, [(1, 0, False)]))
    monkeypatch.setattr(timeseries, "tidy", lambda df, digits: df)
    history = frame(spark, [100.0 + i % 7 + i % 5 for i in range(60)])
    query = timeseries.QUERIES["forecast_searched"]
    cells = dict(zip(query.__code__.co_freevars, query.__closure__, strict=True))
    assert cells["query"].cell_contents(history).count() == 30
    assert grids == [ar.GRID]


def test_rounds_of_clusters_count_as_the_columns_do(spark):
    """Exact sums per centre, also beyond what doubles count; features are computed once for all rounds."""
    rng = np.random.default_rng(1)
    rows = [(i, *[round(float(x), 2) for x in rng.random(4) * 1000]) for i in range(300)] + [(300, 2.0**53, 1.0, 1.0, 1.0), (301, 2.0**53, 1.0, 1.0, 3.0)]
    names = clustering.CUSTOMER_FEATURES
    seen = spark.sparkContext.accumulator(0)

    def looked(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    features = spark.createDataFrame(rows, "customer_id long, " + ", ".join(f"{c} double" for c in names))
    n, mean, spread = clustering._scale(features, names)
    centres = rng.random((3, 4))
    centres[2] = centres[1]  # equally near: the first counts
    points = clustering._spread_out(features, names, n)
    shape = "run int, place int, n decimal(38,0), cost decimal(38,0), s0 decimal(38,0), s1 decimal(38,0), s2 decimal(38,0), s3 decimal(38,0)"
    found = points.mapInArrow(lambda b: clustering._round_sums(b, [centres], mean, spread), shape).drop("run")
    near = clustering._nearest(clustering._scaled(names, mean, spread), clustering._literal(centres))
    wanted = features.withColumn("near", near).groupBy("near.place").agg(
        F.count("*").cast("decimal(38,0)"), clustering._whole(F.col("near.far"), clustering.FINE), *[clustering._whole(F.col(c), clustering.CENT) for c in names])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    counted = features.mapInArrow(looked, features.schema)
    out = clustering.kmeans_customers(counted, k=3, restarts=2)
    assert out.count() == 302 and out.groupBy("cluster").count().count() == 3
    assert seen.value == 302
