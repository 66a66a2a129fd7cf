"""Quantiles and ranks cut into pieces, against pandas; pieces are even wherever the values lie."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from revlake.functions.quantiles import PIECES, counted, exact_quantiles, exact_quantiles_of, in_pieces, quantile_row, quantile_rows
from revlake.functions.ranking import dense_ranks, running_totals, top_share

PROBS = [0.0, 0.1, 0.25, 0.5, 0.8, 1.0]


@pytest.fixture(scope="module")
def frame():
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        # One key holds a third of the rows; values tie, cross zero and span many magnitudes.
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(20)}"
        value = rng.choice([0.0, -1.5, 1.0, 1e-9, 1e12, rng.gauss(0, 100), rng.lognormvariate(0, 5), -rng.random()])
        rows.append((i, key, value, rng.randrange(5)))
    return pd.DataFrame(rows, columns=["id", "key", "v", "n"])


@pytest.fixture(scope="module")
def data(spark, frame):
    return spark.createDataFrame(frame).persist()


def test_quantiles_per_key(data, frame):
    found = {r["key"]: r["q"] for r in exact_quantiles(data, "v", PROBS, ["key"]).collect()}
    for key, values in frame.groupby("key").v:
        assert found[key] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-12)


def test_quantiles_global_and_ignored_values(spark, data, frame):
    odd = spark.createDataFrame([(None,), (math.nan,)], "v double")
    found = exact_quantiles(data.select("v").unionByName(odd), "v", PROBS).collect()
    assert found[0]["q"] == pytest.approx(np.quantile(frame.v, PROBS).tolist(), rel=1e-12, abs=1e-12)
    assert quantile_row(odd, "v", [0.5]).collect()[0]["q"] is None


def test_quantiles_of_single_value_and_infinity(spark):
    one = spark.createDataFrame([(3.0,)], "v double")
    assert exact_quantiles(one, "v", [0.1, 0.9]).collect()[0]["q"] == [3.0, 3.0]
    ends = spark.createDataFrame([(-math.inf,), (1.0,), (math.inf,)], "v double")
    assert exact_quantiles(ends, "v", [0.5]).collect()[0]["q"] == [1.0]


def test_null_keys_are_a_group(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "key string, v double")
    found = {r["key"]: r["q"][0] for r in exact_quantiles(rows, "v", [0.5], ["key"]).collect()}
    assert found == {None: 2.0, "a": 5.0}


def test_quantiles_of_several_columns(data, frame):
    rows = exact_quantiles_of(data, ["v", "n"], [0.75], ["key"]).collect()
    expected = frame.groupby("key")[["v", "n"]].quantile(0.75)
    assert len(rows) == len(expected)
    for r in rows:
        assert r["v"][0] == pytest.approx(expected.v[r["key"]])
        assert r["n"][0] == pytest.approx(expected.n[r["key"]])


def test_quantile_rows_is_one_row(data, frame):
    rows = quantile_rows(data, {"a": "v", "b": "n"}, [0.2, 0.6]).collect()
    assert len(rows) == 1
    assert rows[0]["a"] == pytest.approx(frame.v.quantile([0.2, 0.6]).tolist())
    assert rows[0]["b"] == pytest.approx(frame.n.quantile([0.2, 0.6]).tolist())


def test_dense_ranks_per_key(data, frame):
    found = dense_ranks(data, {"v": "rv", "n": "rn"}, ["key"]).toPandas().sort_values("id")
    for column, rank in (("v", "rv"), ("n", "rn")):
        expected = frame.groupby("key")[column].rank(method="dense", ascending=False).astype(int)
        assert found[rank].tolist() == expected.tolist()


def test_dense_ranks_of_everything(data, frame):
    found = dense_ranks(data, {"v": "rv"}).toPandas().sort_values("id")
    assert found.rv.tolist() == frame.v.rank(method="dense", ascending=False).astype(int).tolist()


def test_running_totals_keep_every_row_in_order(data, frame):
    found = running_totals(data, "n", "id").toPandas().sort_values("row_number")
    expected = frame.sort_values(["n", "id"], ascending=[False, True])
    assert found.row_number.tolist() == list(range(1, len(frame) + 1))
    assert found.id.tolist() == expected.id.tolist()
    assert found.running.tolist() == expected.n.cumsum().tolist()
    assert set(found.total) == {frame.n.sum()}


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.5, 1.0])
def test_top_share_cuts_inside_ties(data, frame, fraction):
    row = top_share(data, "n", fraction).collect()[0]
    k = int(len(frame) * fraction)
    assert (row["n"], row["k"]) == (len(frame), k)
    assert row["top"] == pytest.approx(frame.n.nlargest(k).sum())
    assert row["total"] == pytest.approx(frame.n.sum())


def scans(df):
    """Scans that the executed plan runs; reused exchanges run none of their own."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Scan ")


def test_close_values_in_one_group_fill_the_pieces_evenly(spark):
    # All of one group, in the last bits of a double, beside values far apart and a value on half of the rows.
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 > 0, "close").otherwise("far").alias("key"),
        F.when(F.col("id") % 10 > 0, 1 + F.col("id") * 2.0**-40).otherwise(F.exp(F.col("id") / 100)).alias("v"),
    )
    pieces = in_pieces(counted(rows, ["key"], F.col("v")), "_v", identity=["key", "_v"]).groupBy("key", "_b").count()
    assert max(r["count"] for r in pieces.collect()) < 60_000 / PIECES * 2
    expected = rows.toPandas().groupby("key").v.quantile(0.3)
    found = {r["key"]: r["q"][0] for r in exact_quantiles(rows, "v", [0.3], ["key"]).collect()}
    assert found == pytest.approx(expected.to_dict(), rel=1e-14)


def test_weights_stand_for_rows(spark, data, frame):
    merged = data.groupBy("key", "v").agg(F.count(F.lit(1)).alias("w"))
    found = {r["key"]: r["q"] for r in exact_quantiles(merged, "v", PROBS, ["key"], weight="w").collect()}
    for key, values in frame.groupby("key").v:
        assert found[key] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-12)


def test_the_source_is_read_once(spark, tmp_path, frame):
    path = str(tmp_path / "rows")
    spark.createDataFrame(frame).write.parquet(path)
    rows = spark.read.parquet(path)
    assert scans(exact_quantiles(rows, "v", [0.5], ["key"])) == 1
    assert scans(top_share(rows, "n", 0.2)) == 1
    # The rows, and what is counted of them for the cut points and for the ranks.
    assert scans(dense_ranks(rows, {"v": "rv", "n": "rn"}, ["key"])) <= 3
    assert scans(quality_like(rows)) <= 2


def quality_like(rows):
    merged = rows.groupBy("key", "v").agg(F.count(F.lit(1)).alias("w"))
    return exact_quantiles(merged, "v", [0.25], ["key"], weight="w").crossJoin(quantile_row(merged, "v", [0.25], "all", weight="w"))


def test_rows_move_once_for_running_totals(data):
    plan = running_totals(data.select("id", "n"), "n", "id")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("Exchange hashpartitioning(_b#") == 2  # the rows, and the sums of the pieces


def test_ranks_put_nulls_last(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 2.0), (None, None)], "key string, v double")
    found = {(r["key"], r["v"]): r["r"] for r in dense_ranks(rows, {"v": "r"}, ["key"]).collect()}
    assert found == {("a", 3.0): 1, ("a", 1.0): 2, ("a", None): 3, (None, 2.0): 1, (None, None): 2}
    totals = running_totals(rows.where("key = 'a'").withColumn("id", F.monotonically_increasing_id()), "v", "id").orderBy("row_number").collect()
    assert [(r["v"], r["running"]) for r in totals] == [(3.0, 3.0), (1.0, 4.0), (None, 4.0)]
