"""Column profiles: nulls, ranges, distributions, moments, histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.functions.columns import finite
from revlake.functions.quantiles import exact_quantiles, null_safe, quantile_rows
from revlake.operators.cleaning import FENCE


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _tall(stats: DataFrame, columns: list[str], measures: list[str]) -> DataFrame:
    """One wide row named ``<column>::<measure>`` as one row per column."""
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}::{m}`").alias(m) for m in measures]) for c in columns
    ]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Type, filled and empty counts and empty share of every column, in one pass."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stats = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"{c}") for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("data_type"),
            F.col(c).alias("non_null"),
            (F.col("_n") - F.col(c)).alias("null_count"),
            (F.try_divide(F.col("_n") - F.col(c), F.col("_n")) * 100).alias("null_percent"),
        )
        for c in df.columns
    ]
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows; nulls are equal."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def range_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or _numeric(df)
    exprs = []
    for c in columns:
        v = F.col(c).cast("double")
        exprs += [
            F.min(v).alias(f"{c}::min"),
            F.max(v).alias(f"{c}::max"),
            F.count_if(v == 0).alias(f"{c}::zeros"),
            (F.try_divide(F.count_if(v == 0), F.count(F.lit(1))) * 100).alias(f"{c}::zero_percent"),
            F.count_if(v < 0).alias(f"{c}::negatives"),
        ]
    return _tall(df.agg(*exprs), columns, ["min", "max", "zeros", "zero_percent", "negatives"])


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    columns = columns or _numeric(df)
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[fn(F.col(c).cast("double")).alias(f"{c}::{m}") for c in columns for m, fn in measures.items()])
    found = quantile_rows(df, {f"{c}::q": c for c in columns}, [0.25, 0.5, 0.75])
    tall = _tall(wide.crossJoin(F.broadcast(found)), columns, [*measures, "q"])  # one row each
    return tall.select(
        "column", "count", "mean", "std", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "max"
    )


def moments(df: DataFrame, column: str) -> DataFrame:
    """Median, mode (smallest on ties), and bias-corrected skewness and excess kurtosis."""
    v = finite(column)
    data = df.select(v.alias("v")).where("v is not null")
    shape = data.agg(
        F.count("v").cast("double").alias("n"), F.skewness("v").alias("g1"), F.kurtosis("v").alias("g2")
    )
    # Counting by value first keeps the mode from buffering the column in one task.
    mode = (
        data.groupBy("v")
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(F.max_by("v", F.struct("c", -F.col("v"))).alias("mode"))
    )
    median = exact_quantiles(data, "v", [0.5]).agg((F.max("q")[0]).alias("median"))
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    skew = F.try_divide(g1 * F.sqrt(n * (n - 1)), n - 2)
    kurt = F.try_divide((n - 1) * ((n + 1) * g2 + 6), (n - 2) * (n - 3))
    return (
        shape.crossJoin(F.broadcast(mode))  # one row each
        .crossJoin(F.broadcast(median))
        .select("median", "mode", skew.alias("skewness"), kurt.alias("kurtosis"))
    )


def quantiles(df: DataFrame, columns: list[str], probs=(0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Exact quantiles per column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "v")
    found = exact_quantiles(long, "v", probs, ["column"])
    return found.select("column", *[F.col("q")[i].alias(f"q{round(p * 100)}") for i, p in enumerate(probs)])


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; empty bins are listed."""
    v = finite(column)
    limits = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi")).where("_lo is not null")
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor(F.coalesce(F.try_divide(v - F.col("_lo"), width), F.lit(0.0))).cast("int"), F.lit(bins - 1))
    counts = (
        df.where(v.isNotNull())
        .crossJoin(F.broadcast(limits))  # one row
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    grid = limits.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("_n", F.lit(0)).alias("count"),
    )


def correlation(df: DataFrame, a: str = "price", b: str = "times_viewed") -> DataFrame:
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("correlation"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), column)


def unique_values(df: DataFrame, columns: list[str], most: int = 20) -> DataFrame:
    """Number of distinct values per column, and the values themselves where there are few.

    Only ``most + 1`` values per column are ever listed, which is enough to tell.
    """
    out = None
    for c in columns:
        values = df.select(F.col(c).cast("string").alias("v")).where("v is not null").distinct()
        listed = values.orderBy("v").limit(most + 1).agg(F.array_sort(F.collect_list("v")).alias("values"))
        row = values.agg(F.count(F.lit(1)).alias("unique_count")).crossJoin(F.broadcast(listed))  # one row
        row = row.select(
            F.lit(c).alias("column"), "unique_count", F.when(F.col("unique_count") <= most, F.col("values")).alias("values")
        )
        out = row if out is None else out.unionByName(row)
    return out


def boxplot_stats(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Quartiles and whiskers (furthest values inside the fences) per group."""
    data = df.select(*keys, F.col(value).cast("double").alias("v")).where("v is not null")
    # Equal values are merged first, so a large group moves as its distinct values.
    merged = data.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    quartiles = exact_quantiles(merged, "v", [0.25, 0.5, 0.75], keys, weight="n")
    q1, q3 = F.col("q")[0], F.col("q")[2]
    low, high = q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1)
    joined = null_safe(merged, quartiles, keys, "inner")
    inside = F.col("v").between(low, high)
    return (
        joined.groupBy(*keys)
        .agg(
            F.max(q1).alias("q1"),
            F.max(F.col("q")[1]).alias("median"),
            F.max(q3).alias("q3"),
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
    )
