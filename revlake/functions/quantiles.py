"""Exact quantiles (linear interpolation) whose work splits inside a group.

Rows are first counted by group and value, with copies merged before they move. The counted rows are
dealt to pieces along cut points that a sample of them gives, so a piece holds about an equal part of the
distinct rows however close together or far apart the values lie, and a group with a large part of
the data is spread over all pieces. Counts of the pieces, at most ``PIECES`` rows a group, say which
of them hold the wanted ranks; only their values are put in order.

The sample is the rows with the smallest hashes. It depends on the rows alone, not on how they are
distributed, so a task that runs again cuts at the same points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import col

#: Pieces that rows are cut into, and sampled rows for each of them.
PIECES, SAMPLED = 32, 32


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys`` with null equal to null, keeping one copy of the keys."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = [left[k].eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{k}" for k in keys]) if how in ("inner", "left") else joined


def counted(df: DataFrame, keys: Sequence[str], value: Column, weight: str | None = None) -> DataFrame:
    """``_v`` and its number ``_n`` within ``keys``; ``weight`` may hold counts of rows counted before."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = df.select(*keys, value.alias("_v"), *[weight] * (weight is not None))
    return rows.groupBy(*keys, "_v").agg(n.alias("_n"))


def in_pieces(rows: DataFrame, *ordered: str, identity: Sequence[str]) -> DataFrame:
    """Add ``_b``, which never falls as ``ordered`` rises and has at most ``PIECES`` values.

    ``identity`` names columns that tell rows apart; their hash picks the sample behind the cut points.
    """
    place = F.struct(*ordered) if len(ordered) > 1 else F.col(ordered[0])
    rest = [c for c in rows.columns if c not in identity]
    least = rows.orderBy(F.xxhash64(*identity), *identity, *rest).limit(PIECES * SAMPLED)
    points = F.sort_array(F.collect_list(F.when(place.isNotNull(), place)))
    even = F.sequence(F.lit(1), F.lit(PIECES - 1))
    cuts = least.agg(points.alias("_all")).select(
        F.transform(even, lambda i: F.get("_all", F.floor(F.size("_all") * i / PIECES).cast("int"))).alias("_cuts")
    )
    passed = F.size(F.filter("_cuts", lambda c: c <= place))
    return rows.crossJoin(F.broadcast(cuts)).withColumn("_b", passed).drop("_cuts")  # one row


def exact_quantiles(
    df: DataFrame, value: str | Column, probs: Sequence[float], keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """One row per group: the keys and ``q``, an array of quantiles in the order of ``probs``.

    Nulls and NaN are ignored; a group without values yields no row. ``weight`` may name a column with
    the number of rows that a row stands for.
    """
    keys = list(keys)
    group = [F.col(k) for k in keys] or [F.lit(0)]
    values = counted(df, keys, col(value).cast("double"), weight).where("_v is not null and not isnan(_v)")
    placed = in_pieces(values, "_v", identity=[*keys, "_v"])
    # One row a group and piece here, so these windows are bounded by the number of pieces.
    running = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    pieces = (
        placed.groupBy(*keys, "_b")
        .agg(F.sum("_n").alias("_bn"))
        .select(
            *keys,
            "_b",
            "_bn",
            (F.sum("_bn").over(running) - F.col("_bn")).alias("_before"),
            F.sum("_bn").over(W.partitionBy(*group)).alias("_total"),
        )
    )
    spots = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    lows = [F.floor(s) for s in spots]
    highs = [F.ceil(s) for s in spots]

    def holds(rank: Column, start: Column, size: Column) -> Column:
        return (rank >= start) & (rank < start + size)

    wanted = F.lit(False)
    for rank in lows + highs:
        wanted = wanted | holds(rank, F.col("_before"), F.col("_bn"))
    inside = W.partitionBy(*group, F.col("_b")).orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = null_safe(placed, pieces.where(wanted).drop("_bn"), [*keys, "_b"], "inner").withColumn(
        "_start", F.col("_before") + F.sum("_n").over(inside) - F.col("_n")
    )
    picks = []
    for i, (low, high) in enumerate(zip(lows, highs, strict=True)):
        picks.append(F.max(F.when(holds(low, F.col("_start"), F.col("_n")), F.col("_v"))).alias(f"_low{i}"))
        picks.append(F.max(F.when(holds(high, F.col("_start"), F.col("_n")), F.col("_v"))).alias(f"_high{i}"))
    picked = ranked.groupBy(*keys, "_total").agg(*picks)
    result = [
        F.col(f"_low{i}") + F.coalesce((F.col(f"_high{i}") - F.col(f"_low{i}")) * F.nullif(spots[i] - lows[i], F.lit(0.0)), F.lit(0.0))
        for i in range(len(probs))
    ]
    return picked.select(*keys, F.array(*result).alias("q"))


def _long(df: DataFrame, values: dict[str, str | Column], keys: Sequence[str]) -> DataFrame:
    """Every value of several columns as a row of its own, named in ``_c``."""
    pairs = [F.struct(F.lit(n).alias("_c"), col(v).cast("double").alias("_v")) for n, v in values.items()]
    return df.select(*keys, F.explode(F.array(*pairs)).alias("_p")).select(*keys, "_p.*")


def exact_quantiles_of(df: DataFrame, values: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Quantiles of several columns at once: the keys and one array per column, named after it."""
    found = exact_quantiles(_long(df, {v: v for v in values}, keys), "_v", probs, [*keys, "_c"])
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == v, F.col("q"))).alias(v) for v in values])


def quantile_row(df: DataFrame, value: str | Column, probs: Sequence[float], name: str = "q", weight: str | None = None) -> DataFrame:
    """Global quantiles as exactly one row (null when there are no values), for joining to rows."""
    return exact_quantiles(df, value, probs, weight=weight).agg(F.max("q").alias(name))


def quantile_rows(df: DataFrame, values: dict[str, str | Column], probs: Sequence[float]) -> DataFrame:
    """Global quantiles of several columns as exactly one row with one array per name, from one pass."""
    found = exact_quantiles(_long(df, values, []), "_v", probs, ["_c"])
    return found.agg(*[F.max(F.when(F.col("_c") == n, F.col("q"))).alias(n) for n in values])
