"""Model performance history: drift tests, scores, summaries and recommendations.

A history holds at most 100 records per country and model (see ``capped_history``), which bounds
every window here.
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import priority_order
from revlake.functions.quantiles import quantile_rows
from revlake.operators.logs import last_n_per_key

KEY = ["country", "model_type"]
# History length, recent window, weights and limits of the drift scores.
HISTORY, RECENT, TREND = 100, 5, 20
WEIGHTS = {"data": 0.3, "concept": 0.3, "performance": 0.4}
HIGH, MEDIUM = 0.7, 0.3
# Advice texts for drift scores.
ADVICE = {
    "performance": (0.3, "High performance drift detected. Consider retraining models."),
    "data": (0.5, "Significant data drift detected. Review input data quality and distributions."),
    "concept": (0.4, "Concept drift detected. Market conditions may have changed."),
}
STABLE = "Model performance is stable. Continue monitoring."


@lru_cache
def t_critical(df: int, alpha: float = 0.05) -> float:
    """Two-sided critical value of Student's t, by bisection on the finite series of its distribution."""

    def middle(t: float) -> float:
        angle = math.atan(t / math.sqrt(df))
        square, odd = math.cos(angle) ** 2, df % 2
        term, total = (math.cos(angle), math.cos(angle)) if odd else (1.0, 1.0)
        for k in range(2 + odd, df - 1, 2):
            term *= square * (k - 1) / k
            total += term
        if odd:
            return 2 / math.pi * (angle + math.sin(angle) * total * (df > 1))
        return math.sin(angle) * total

    low, high = 1.0, 700.0 if df == 1 else 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if middle(mid) < 1 - alpha else (low, mid)
    return (low + high) / 2


def append_prediction_records(predictions: DataFrame, when=None) -> DataFrame:
    """History rows of predictions: time taken and confidence, 0 where absent."""
    now = F.current_timestamp() if when is None else F.lit(when).cast("timestamp")
    values = {"prediction_time": "prediction_time", "confidence": "confidence_score"}
    kept = [(F.coalesce(F.col(c), F.lit(0.0)) if c in predictions.columns else F.lit(0.0)).alias(n) for c, n in values.items()]
    return predictions.select(*KEY, *kept, now.alias("timestamp"))


def append_performance_records(metrics: DataFrame, when=None) -> DataFrame:
    """History rows from evaluation rows; a missing metric counts as 0."""
    now = F.current_timestamp() if when is None else F.lit(when).cast("timestamp")
    names = ["mae", "mape", "rmse", "mase", "r2"]
    values = [F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c in metrics.columns else F.lit(0.0).alias(c) for c in names]
    return metrics.select(*KEY, *values, now.alias("timestamp"))


def capped_history(history: DataFrame, n: int = HISTORY) -> DataFrame:
    return last_n_per_key(history, n, KEY, ["timestamp"])


def _recent_and_earlier(history: DataFrame) -> DataFrame:
    """Per key: count, mean and variance of R2 of the newest five records and of those before."""
    place = F.row_number().over(W.partitionBy(*KEY).orderBy(F.col("timestamp").desc()))
    marked = capped_history(history).withColumn("_recent", place <= RECENT)
    recent, earlier = F.when(F.col("_recent"), F.col("r2")), F.when(~F.col("_recent"), F.col("r2"))
    return marked.groupBy(*KEY).agg(
        F.count("r2").alias("records"),
        F.count(recent).alias("n_recent"),
        F.count(earlier).alias("n_earlier"),
        F.avg(recent).alias("recent_r2"),
        F.avg(earlier).alias("earlier_r2"),
        F.coalesce(F.var_samp(recent), F.lit(0.0)).alias("var_recent"),
        F.coalesce(F.var_samp(earlier), F.lit(0.0)).alias("var_earlier"),
        F.max("timestamp").alias("timestamp"),
    )


def performance_drift_test(history: DataFrame) -> DataFrame:
    """Pooled t test of the newest five R2 values against the earlier ones, for keys with more than five."""
    a, b = F.col("n_recent"), F.col("n_earlier")
    freedom = a + b - 2
    pooled = ((a - 1) * F.col("var_recent") + (b - 1) * F.col("var_earlier")) / freedom
    t = F.try_divide(F.col("recent_r2") - F.col("earlier_r2"), F.sqrt(pooled * (1 / a + 1 / b)))
    # Degrees of freedom end at HISTORY - 2, so the critical values fit in one literal array.
    critical = F.array(*[F.lit(t_critical(d)) for d in range(1, HISTORY - 1)])
    alert = (F.col("t_statistic") < -2) & (F.abs("t_statistic") > F.col("critical"))
    return (
        _recent_and_earlier(history)
        .where(F.col("records") > RECENT)
        .select(
            *KEY, "timestamp", "records", "recent_r2", "earlier_r2",
            t.alias("t_statistic"), F.element_at(critical, freedom.cast("int")).alias("critical"),
        )
        .withColumn("has_drift", F.coalesce(alert, F.lit(False)))
        .withColumn("drift_score", F.when(F.col("has_drift"), F.abs("t_statistic") / 10))
    )


def drift_alerts(tests: DataFrame) -> DataFrame:
    """Alert rows of the keys whose test fired."""
    text = "Model %s for %s showing performance degradation. Consider retraining."
    return tests.where("has_drift").select(
        *KEY,
        "timestamp",
        F.lit("performance").alias("drift_type"),
        "drift_score",
        F.array("model_type").alias("affected_features"),
        F.format_string(text, "model_type", "country").alias("recommendation"),
    )


def performance_drift_scores(history: DataFrame) -> DataFrame:
    """Relative loss of mean R2 in the newest five records, for keys with more than ten."""
    loss = F.try_divide(F.col("earlier_r2") - F.col("recent_r2"), F.col("earlier_r2"))
    return (
        _recent_and_earlier(history)
        .where("records > 10")
        .select(*KEY, F.greatest(F.lit(0.0), loss).alias("drift_score"))
        .withColumn("high_drift", F.col("drift_score") > 0.3)
    )


def performance_drift_score(history: DataFrame) -> DataFrame:
    """Mean drift score of all keys as one row."""
    return performance_drift_scores(history).agg(
        F.coalesce(F.avg("drift_score"), F.lit(0.0)).alias("overall_score"),
        F.count_if("high_drift").alias("high_drift_models"),
    )


def overall_drift(data: DataFrame, concept: DataFrame, performance: DataFrame) -> DataFrame:
    """Weighted drift score and its class, from three one-row frames with ``overall_score``."""
    frames = {"data": data, "concept": concept, "performance": performance}
    out = None
    for name, frame in frames.items():
        one = frame.agg(F.max("overall_score").alias(name))
        out = one if out is None else out.crossJoin(F.broadcast(one))  # one row
    score = sum((F.coalesce(F.col(n), F.lit(0.0)) * w for n, w in WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("overall_score", score).withColumn(
        "drift_status",
        F.when(F.col("overall_score") > HIGH, "high").when(F.col("overall_score") > MEDIUM, "medium").otherwise("low"),
    )


def drift_recommendations(scores: DataFrame) -> DataFrame:
    """Add ``recommendations`` to a frame with the columns performance, data and concept."""
    fired = F.array_compact(F.array(*[F.when(F.col(name) > limit, F.lit(text)) for name, (limit, text) in ADVICE.items()]))
    return scores.withColumn("recommendations", F.when(F.size(fired) > 0, fired).otherwise(F.array(F.lit(STABLE))))


def performance_summary(history: DataFrame) -> DataFrame:
    """Average R2 of the records kept of each key, best and worst key by mean R2, last record time, as one row."""
    per_key = capped_history(history).groupBy(*KEY).agg(F.avg("r2").alias("mean_r2"), F.sum("r2").alias("_s"), F.count("r2").alias("_n"), F.max("timestamp").alias("_t"))
    key = F.concat_ws("_", *KEY)
    return per_key.agg(
        F.coalesce(F.try_divide(F.sum("_s"), F.sum("_n")), F.lit(0.0)).alias("average_accuracy"),
        F.coalesce(F.min_by(key, F.struct(-F.col("mean_r2"), key)), F.lit("none")).alias("best_model"),
        F.coalesce(F.min_by(key, F.struct(F.col("mean_r2"), key)), F.lit("none")).alias("worst_model"),
        F.max("_t").alias("last_training"),
    )


def latest_performance(history: DataFrame) -> DataFrame:
    """Newest record per key."""
    return last_n_per_key(history, 1, KEY, ["timestamp"])


def accuracy_trends(history: DataFrame, n: int = TREND) -> DataFrame:
    """R2 of the newest records per key in time order."""
    kept = last_n_per_key(history, n, KEY, ["timestamp"])
    # At most ``n`` entries per key.
    pairs = F.array_sort(F.collect_list(F.struct("timestamp", "r2")))
    return kept.groupBy(*KEY).agg(F.transform(pairs, lambda p: p["r2"]).alias("r2_trend"))


def performance_stability(history: DataFrame) -> DataFrame:
    """Mean over keys with more than five records of 1 - deviation / mean, and its class."""
    mean, std = F.avg("r2"), F.stddev_pop("r2")
    per_key = capped_history(history).groupBy(*KEY).agg(
        F.count("r2").alias("n"), F.when(mean > 0, 1 - std / mean).otherwise(0.0).alias("stability")
    )
    s = F.col("stability")
    return per_key.where("n > 5").agg(F.avg("stability").alias("stability")).withColumn(
        "level",
        F.when(s.isNull(), "unknown").when(s > 0.8, "high").when(s > 0.6, "medium").otherwise("low"),
    )


def data_drift(baseline: DataFrame, recent: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """Population stability index of each column between two samples, on the baseline's deciles."""
    marks = {f"_q_{c}": c for c in columns}
    cuts = quantile_rows(baseline, marks, [i / bins for i in range(1, bins)])

    def place(c: str) -> Column:
        return sum(((F.col(c).cast("double") > F.col(f"_q_{c}")[i]).cast("int") for i in range(bins - 1)), F.lit(0))

    tags = baseline.select(*columns, F.lit(True).alias("_old")).unionByName(recent.select(*columns, F.lit(False).alias("_old")))
    # One row; every value of every column counts once, merged before the shuffle.
    pairs = [F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), place(c)).alias("bin")) for c in columns]
    counts = (
        tags.crossJoin(F.broadcast(cuts))
        .select("_old", F.explode(F.array(*pairs)).alias("p"))
        .select("_old", "p.*")
        .where("bin is not null")
        .groupBy("feature", "bin")
        .agg(F.count_if("_old").alias("a"), F.count_if(~F.col("_old")).alias("b"))
    )
    grid = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    features = cuts.select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature")).select("feature", grid)
    whole = W.partitionBy("feature")  # one row per bin
    filled = features.join(counts, ["feature", "bin"], "left").na.fill(0, ["a", "b"])
    # An empty bin counts as a ten-thousandth.
    p, q = (F.greatest(F.try_divide(F.col(x), F.sum(x).over(whole)), F.lit(1e-4)) for x in ("a", "b"))
    shares = filled.select("feature", p.alias("p"), q.alias("q"))
    # Bins empty on both sides say nothing: their two shares are equal.
    psi = F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p")))
    return shares.groupBy("feature").agg(psi.alias("psi")).withColumn("has_drift", F.col("psi") > 0.2)


def data_drift_score(drift: DataFrame) -> DataFrame:
    return drift.agg(F.least(F.lit(1.0), F.avg("psi")).alias("overall_score"))


def concept_drift(baseline: DataFrame, recent: DataFrame, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """Change of daily growth and of the weekday pattern between two windows of daily series.

    Growth is slope over level; the pattern change is the mean absolute difference of weekday shares.
    """
    def shape(df, tag):
        line = df.groupBy(*keys).agg(
            F.try_divide(F.regr_slope("y", F.unix_date("ds")), F.avg("y")).alias(f"growth_{tag}")
        )
        days = df.groupBy(*keys, F.weekday("ds").alias("dow")).agg(F.avg("y").alias("_m"))
        share = F.try_divide("_m", F.sum("_m").over(W.partitionBy(*keys)))
        return line, days.select(*keys, "dow", share.alias(f"_s_{tag}"))

    line_a, days_a = shape(baseline, "baseline")
    line_b, days_b = shape(recent, "recent")
    zero = F.lit(0.0)
    gap = F.abs(F.coalesce("_s_baseline", zero) - F.coalesce("_s_recent", zero))
    pattern = days_a.join(days_b, [*keys, "dow"], "full").groupBy(*keys).agg(F.avg(gap).alias("pattern_change"))
    return (
        line_a.join(line_b, list(keys))
        .join(pattern, list(keys))
        .withColumn("growth_change", F.col("growth_recent") - F.col("growth_baseline"))
    )


def concept_drift_score(drift: DataFrame) -> DataFrame:
    """Mean pattern change times seven, 1 at most: 0 for equal weekday patterns."""
    return drift.agg(F.least(F.lit(1.0), F.avg("pattern_change") * 7).alias("overall_score"))


def business_correlation(pairs: DataFrame, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """Correlation of forecast and revenue per series; weak below 0.3 in size."""
    r = F.col("correlation")
    return pairs.groupBy(*keys).agg(F.corr("yhat", "y").alias("correlation")).withColumn(
        "strength", F.when(F.abs(r) < 0.3, "weak").when(F.abs(r) < 0.7, "moderate").when(r.isNotNull(), "strong")
    )


# What a recommendation advises, by its issue; {} stand for the model and the country.
ADVISED = {
    "High prediction error": "Consider retraining {model} model for {country} or adjusting hyperparameters",
    "Low model fit": "Consider adding more features or using a different model architecture for {country}",
    "drift": "Retrain {model} model for {country} with recent data",
    "Model selection optimization": "Consider using {model} as primary model for {country}",
    "Weak correlation with business metrics": "Investigate model features and business KPI alignment for {country}",
}


def _advised(text: str, model: Column) -> Column:
    """One of ``ADVISED`` with its places filled."""
    return F.replace(F.replace(F.lit(text), F.lit("{model}"), model), F.lit("{country}"), F.col("country"))


def recommendations(
    metrics: DataFrame, alerts: DataFrame | None = None, ranked: DataFrame | None = None, correlation: DataFrame | None = None
) -> DataFrame:
    """One row per recommendation with its advice, high priority first.

    ``metrics`` has country, model_type, mae, rmse, r2; ``alerts`` comes from ``drift_alerts``;
    ``ranked`` has country, model_type, rank and mae; ``correlation`` has country and strength.
    """
    def rows(df, kind, priority, model, issue, details):
        advised = _advised(ADVISED[issue if isinstance(issue, str) else "drift"], F.col("model_type") if "model_type" in df.columns else F.lit(""))
        text = [F.lit(v) if isinstance(v, str) else v for v in (kind, priority, model, issue, advised)]
        names = ["type", "priority", "model", "issue", "recommendation"]
        return df.select("country", *[v.alias(n) for v, n in zip(text, names, strict=True)], details.alias("details"))

    model = F.col("model_type")
    error = F.format_string("MAE: %.2f, RMSE: %.2f", "mae", "rmse")
    found = [
        rows(metrics.where("mae > 500"), "model_performance", "high", model, "High prediction error", error),
        rows(metrics.where("coalesce(r2, 0) < 0.7"), "model_performance", "medium", model, "Low model fit", F.format_string("R2: %.3f", F.coalesce("r2", F.lit(0.0)))),
    ]
    if alerts is not None:
        severity = F.col("severity") if "severity" in alerts.columns else F.lit("medium")
        issue = F.concat(F.initcap("drift_type"), F.lit(" drift detected"))
        found.append(rows(alerts, "model_drift", severity, model, issue, F.format_string("score: %.3f", "drift_score")))
    if ranked is not None:
        best = F.format_string("%s: %.3f", "model_type", "mae")
        found.append(rows(ranked.where("rank = 1"), "model_selection", "low", "all", "Model selection optimization", best))
    if correlation is not None:
        weak = correlation.where("strength = 'weak'")
        found.append(rows(weak, "business_impact", "medium", "all", "Weak correlation with business metrics", F.col("strength")))
    out = found[0]
    for frame in found[1:]:
        out = out.unionByName(frame)
    return sort_by_priority(out)


def sort_by_priority(df: DataFrame) -> DataFrame:
    return df.orderBy(priority_order("priority"), "country", "model", "issue")


def retrain_candidates(series: DataFrame, tests: DataFrame, force: bool = False) -> DataFrame:
    """Rows of ``series`` (keyed by country and model) flagged by the drift test, or all when forced."""
    return series if force else series.join(tests.where("has_drift"), KEY, "left_semi")


def recent_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """The newest alerts, each marked when it is from the last day of the data."""
    newest = alerts.agg(F.max("timestamp").alias("_t"))
    day = F.make_dt_interval(F.lit(1))
    marked = alerts.crossJoin(F.broadcast(newest)).withColumn("last_day", F.col("timestamp") > F.col("_t") - day)  # one row
    return marked.drop("_t").orderBy(F.col("timestamp").desc(), *KEY).limit(n)
