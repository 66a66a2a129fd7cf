"""K-means groups of customers and products that do not depend on the order or place of the rows.

Starts come from the rows with the smallest key hashes. Features have two decimals, so sums of members are
added as whole numbers and come out the same however rows are distributed; centres follow from them.
Runs with different starts and numbers of clusters share one pass over the rows in every round. Features are
stored once, in the shared folder; a round reads them from memory, and each of its tasks, one a core, sends one
row a centre.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.columns import finite, percent, round_total
from revlake.session import pinned

# Seed, restarts, smallest input, largest numbers of clusters.
SEED, RESTARTS, MIN_ROWS = 42, 10, 10
ELBOW_MOST, CUSTOMER_CLUSTERS, PRODUCT_CLUSTERS = 10, 4, 5
#: Rows that starts are picked from, and rounds after which centres are taken as they are.
START_ROWS, ROUNDS = 1000, 200
#: Rows that a task of a round should have at least.
PART_ROWS = 5000
#: Steps that sums of features and of distances are counted in.
CENT, FINE = 100, 10**6
CUSTOMER_FEATURES = ["total_revenue", "avg_order_value", "frequency", "total_views"]
PRODUCT_FEATURES = ["total_revenue", "avg_price", "transactions", "total_views"]


def _features(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Two-decimal sums, means and counts per key; rows with a missing value are left out."""
    made = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            round_total(F.sum("price")).alias(names[0]),
            round_total(F.avg("price")).alias(names[1]),
            F.count("price").cast("double").alias(names[2]),
            F.sum("times_viewed").cast("double").alias(names[3]),
        )
    )
    for name in names:
        made = made.where(finite(name).isNotNull())
    return made


def customer_features(df: DataFrame) -> DataFrame:
    return _features(df, "customer_id", CUSTOMER_FEATURES)


def product_features(df: DataFrame) -> DataFrame:
    return _features(df, "stream_id", PRODUCT_FEATURES)


def _whole(c: Column, steps: int) -> Column:
    """Sum as a whole number of ``1 / steps``: the same in any order."""
    return F.sum(F.round(c * steps).cast("decimal(38,0)"))


def _scale(features: DataFrame, names: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, and mean and sample deviation of the named columns, from exact sums."""
    row = features.agg(
        F.count(F.lit(1)),
        *[_whole(F.col(c), CENT) for c in names],
        *[F.sum(F.round(F.col(c) * CENT).cast("decimal(19,0)") * F.round(F.col(c) * CENT).cast("decimal(19,0)")) for c in names],
    ).first()
    n, k = row[0], len(names)
    if n < 2:
        return n, np.zeros(k), np.ones(k)
    mean, spread = [], []
    for one, two in zip(row[1 : k + 1], row[k + 1 :], strict=True):
        mean.append(float(Decimal(one) / n / CENT))
        spread.append(float((Decimal(two) - Decimal(one) ** 2 / n) / (n - 1)) ** 0.5 / CENT)
    return n, np.array(mean), np.array([d or 1.0 for d in spread])


def _starts(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` rows far from each other: each next one drawn by its squared distance to those picked."""
    rng = np.random.default_rng(seed)
    picked = [rows[rng.integers(len(rows))]]
    while len(picked) < k:
        far = np.min([((rows - c) ** 2).sum(axis=1) for c in picked], axis=0)
        total = far.sum()
        picked.append(rows[rng.choice(len(rows), p=far / total)] if total > 0 else rows[rng.integers(len(rows))])
    return np.array(picked)


def _nearest(scaled: Column, centres: Column) -> Column:
    """Squared distance and place of the nearest of ``centres``; the first of equally near ones."""
    def distance(centre: Column) -> Column:
        steps = F.zip_with(scaled, centre, lambda x, y: (x - y) * (x - y))
        return F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)

    return F.array_min(F.transform(centres, lambda c, i: F.struct(distance(c).alias("far"), i.alias("place"))))


def _literal(centres: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])


def _scaled(names: list[str], mean: np.ndarray, spread: np.ndarray) -> Column:
    return F.array(*[(F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(names, mean, spread, strict=True)])


def _whole_sums(places: np.ndarray, values: np.ndarray, k: int) -> list[int]:
    """Exact sums of whole numbers by place; beyond what doubles count, in Python's own numbers."""
    if len(values) * np.abs(values).max() < 2**53:
        return [int(x) for x in np.bincount(places, weights=values, minlength=k)]
    out = [0] * k
    for place, value in zip(places.tolist(), values.tolist(), strict=True):
        out[place] += int(value)
    return out


def _round_sums(batches: Iterator, runs: list[np.ndarray], mean: np.ndarray, spread: np.ndarray) -> Iterator:
    """One task of a round: members, cost and feature sums per run and centre, from batches of features.

    Distances are added up in the order of ``_nearest``, and the first of equally near centres is taken, as there.
    """
    width = len(mean)
    sums = [[[0] * len(c) for _ in range(width + 2)] for c in runs]
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(f).to_numpy() for f in range(width)]
        scaled = [(x - m) / s for x, m, s in zip(columns, mean, spread, strict=True)]
        cents = [batch.column(width + f).to_numpy() for f in range(width)]
        for centres, held in zip(runs, sums, strict=True):
            far = np.full(batch.num_rows, np.inf)
            places = np.zeros(batch.num_rows, dtype=np.int64)
            for place, centre in enumerate(centres):
                d = np.zeros(batch.num_rows)
                for x, c in zip(scaled, centre, strict=True):
                    step = x - c
                    step *= step
                    d += step
                np.copyto(places, place, where=d < far)
                np.minimum(far, d, out=far)
            cost = far * FINE
            whole = np.floor(cost)
            whole += cost - whole >= 0.5
            found = [np.bincount(places, minlength=len(centres)).tolist()]
            found += [_whole_sums(places, values, len(centres)) for values in (whole, *cents)]
            for row, more in zip(held, found, strict=True):
                row[:] = [a + b for a, b in zip(row, more, strict=True)]
    rows = [(run, place, *[row[place] for row in held]) for run, held in enumerate(sums) for place in range(len(runs[run])) if held[0][place]]
    for_run, for_place, *numbers = zip(*rows, strict=True) if rows else [()] * (width + 4)
    exact = [pa.array([Decimal(x) for x in c], pa.decimal128(38, 0)) for c in numbers]
    names = ["run", "place", "n", "cost", *[f"s{f}" for f in range(width)]]
    yield pa.RecordBatch.from_arrays([pa.array(for_run, pa.int32()), pa.array(for_place, pa.int32()), *exact], names)


def _spread_out(features: DataFrame, names: list[str], n: int) -> DataFrame:
    """The named columns and their whole cents, one part a core unless these would be small."""
    parts = max(1, min(features.sparkSession.sparkContext.defaultParallelism, -(-n // PART_ROWS)))
    cents = [F.round(F.col(c) * CENT).cast("double").alias(f"_w{i}") for i, c in enumerate(names)]
    return features.select(*[F.col(c).cast("double").alias(c) for c in names], *cents).repartition(parts)


def best_centres(features: DataFrame, names: list[str], wanted: list[int], seed: int = SEED, restarts: int = RESTARTS) -> dict:
    """``{k: (cost, centres)}``: for every number of clusters the cheapest of several runs, and the scale used.

    The first column of ``features`` is the key. Rounds stop when no centre moves any more. The driver sees
    the ``START_ROWS`` rows with the smallest key hashes, and one row a centre from each task of a round.
    """
    key = features.columns[0]
    n, mean, spread = _scale(features, names)
    least = features.orderBy(F.xxhash64(key), F.col(key)).limit(START_ROWS).select(*[F.col(c).cast("double") for c in names])
    rows = (np.array([tuple(r) for r in least.collect()]) - mean) / spread
    runs = {(k, i): _starts(rows, k, seed + i) for k in wanted for i in range(restarts)}
    costs: dict = {}
    moving = dict(runs)
    shape = "run int, place int, n decimal(38,0), cost decimal(38,0), " + ", ".join(f"s{i} decimal(38,0)" for i in range(len(names)))
    points = _spread_out(features, names, n).persist()
    try:
        for _ in range(ROUNDS):
            order = list(moving)
            models = [moving[r] for r in order]
            per_task = points.mapInArrow(lambda batches, models=models: _round_sums(batches, models, mean, spread), shape)
            # A row a centre and task. Adding them up here spares every round a shuffle.
            sums: dict = {}
            for run, place, *numbers in per_task.collect():
                known = sums.get((run, place), [0] * len(numbers))
                sums[run, place] = [a + int(b) for a, b in zip(known, numbers, strict=True)]
            next_centres = {r: c.copy() for r, c in moving.items()}
            costs |= dict.fromkeys(order, Decimal(0))
            for (run, place), (members, cost, *totals) in sums.items():
                costs[order[run]] += cost
                means = np.array([float(Decimal(x) / members / CENT) for x in totals])
                next_centres[order[run]][place] = (means - mean) / spread
            still = {r for r in order if not np.array_equal(next_centres[r], moving[r])}
            runs |= next_centres
            moving = {r: next_centres[r] for r in still}
            if not moving:
                break
    finally:
        points.unpersist()
    best = {k: min((costs[k, i], i) for i in range(restarts)) for k in wanted}
    return {"mean": mean, "spread": spread, "rows": n} | {k: (float(cost) / FINE, runs[k, i]) for k, (cost, i) in best.items()}


def elbow(features: DataFrame, names: list[str], seed: int = SEED) -> DataFrame:
    """Within-cluster cost for k = 2 .. min(10, n / 5), the least of ``RESTARTS`` runs each."""
    rows = pinned(features, "features")
    wanted = list(range(2, min(ELBOW_MOST, rows.count() // 5) + 1))
    found = best_centres(rows, names, wanted, seed) if wanted else {}
    return features.sparkSession.createDataFrame([(k, found[k][0]) for k in wanted], "k int, cost double")


def _clusters(features: DataFrame, names: list[str], k: int | None, seed: int, restarts: int, choose) -> DataFrame:
    rows = pinned(features, "features")
    n = rows.count()
    if n < MIN_ROWS:
        return rows.withColumn("cluster", F.lit(0)).where("false")
    k = k or choose(n)
    found = best_centres(rows, names, [k], seed, restarts)
    near = _nearest(_scaled(names, found["mean"], found["spread"]), _literal(found[k][1]))
    return rows.withColumn("cluster", near["place"])


def kmeans_customers(features: DataFrame, k: int | None = None, seed: int = SEED, restarts: int = RESTARTS) -> DataFrame:
    """Add ``cluster`` to customer features; empty for fewer than ten customers."""
    def choose(n):
        return max(2, min(CUSTOMER_CLUSTERS, ELBOW_MOST, n // 5))

    return _clusters(features, CUSTOMER_FEATURES, k, seed, restarts, choose)


def kmeans_products(features: DataFrame, k: int | None = None, seed: int = SEED, restarts: int = RESTARTS) -> DataFrame:
    """Add ``cluster`` to product features; empty for fewer than ten products."""
    def choose(n):
        return max(2, min(PRODUCT_CLUSTERS, n // 10))

    return _clusters(features, PRODUCT_FEATURES, k, seed, restarts, choose)


def cluster_summary(clustered: DataFrame, names: list[str]) -> DataFrame:
    """Members, revenue and mean features per cluster, with shares of the whole."""
    revenue, value, often, views = names
    per_cluster = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("members"),
        F.avg(revenue).alias("avg_revenue"),
        F.sum(revenue).alias("total_revenue"),
        F.avg(value).alias(f"avg_{value}"),
        F.avg(often).alias(f"avg_{often}"),
        F.avg(views).alias("avg_views"),
    )
    whole = clustered.agg(
        F.count(F.lit(1)).alias("_n"), F.sum(revenue).alias("_r"), F.avg(revenue).alias("_mr"),
        F.avg(value).alias("_mv"), F.avg(often).alias("_mo"),
    )
    return per_cluster.crossJoin(F.broadcast(whole)).select(  # one row
        *per_cluster.columns,
        percent("members", "_n").alias("member_share"),
        percent("total_revenue", "_r").alias("revenue_share"),
        "_mr", "_mv", "_mo",
    )


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Customer clusters with the name their averages earn."""
    rich = F.col("avg_revenue") > 1.5 * F.col("_mr")
    label = (
        F.when(rich & (F.col("avg_frequency") > F.col("_mo")), "VIP")
        .when(rich, "Occasional")
        .when(F.col("avg_frequency") > 1.2 * F.col("_mo"), "Loyal")
        .otherwise("Standard")
    )
    return cluster_summary(clustered, CUSTOMER_FEATURES).withColumn("profile", label).drop("_mr", "_mv", "_mo")


def product_cluster_profile(clustered: DataFrame) -> DataFrame:
    label = (
        F.when(F.col("avg_avg_price") > 1.5 * F.col("_mv"), "Premium")
        .when(F.col("avg_transactions") > F.col("_mo"), "Popular")
        .otherwise("Standard")
    )
    return cluster_summary(clustered, PRODUCT_FEATURES).withColumn("profile", label).drop("_mr", "_mv", "_mo")
