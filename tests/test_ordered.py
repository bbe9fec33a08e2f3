"""Chunked windows, running values and row numbers equal their one-task forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import minute, rows
from tickflow.operators.rolling import forward_fill, gaps, rolling_features
from tickflow.plans.chunks import bounded_frames, running
from tickflow.plans.rowindex import exact_quantiles, row_index


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    data = []
    for key, n in (("a", 400), ("b", 3), ("c", 60)):
        at = 0
        for _ in range(n):
            at += rng.choice([1, 1, 1, 2, 40, 300]) if key != "b" else 500
            data.append((key, minute(at), float(rng.randint(-50, 50)) if rng.random() > 0.3 else None))
    return spark.createDataFrame(data, "k string, t timestamp_ntz, v double")


@pytest.mark.parametrize("before,after", [(4, 0), (0, 5), (9, 5), (1, 1)])
def test_bounded_frames(series, before, after):
    def compute(df, w):
        return (df.withColumn("s", F.sum("v").over(w.rowsBetween(-before, after)))
                .withColumn("n", F.count("v").over(w.rowsBetween(-before, after))))

    got = bounded_frames(series, ["k"], ["t"], "20 minutes", before, after, compute)
    want = compute(series, Window.partitionBy("k").orderBy("t"))
    assert rows(got.select("k", "t", "v", "s", "n"), "k", "t") == rows(want.select("k", "t", "v", "s", "n"), "k", "t")


@pytest.mark.parametrize("inclusive", [True, False])
def test_running(series, inclusive):
    kinds = {"last": lambda c: F.last(c, ignorenulls=True), "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}
    got = running(series, ["k"], ["t"], {f"x_{k}": (k, "v") for k in kinds}, width="30 minutes", inclusive=inclusive)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = series
    for k, f in kinds.items():
        want = want.withColumn(f"x_{k}", f("v").over(w))
    assert rows(got, "k", "t") == rows(want, "k", "t")


def test_running_without_keys_and_with_own_chunks(spark):
    df = spark.range(100).select("id", ((F.col("id") * 37) % 101).alias("v"))
    got = running(df, [], ["id"], {"low": ("min", "v")}, chunk=F.floor(F.col("id") / 7))
    best, want = None, []
    for i in range(100):
        v = (i * 37) % 101
        best = v if best is None else min(best, v)
        want.append((i, v, best))
    assert rows(got, "id") == want


def test_forward_fill_modes(spark):
    df = spark.createDataFrame([(minute(i), v) for i, v in enumerate([0.5, None, -0.2, None])], "t timestamp_ntz, v double")
    fill = lambda mode: [r[1] for r in rows(forward_fill(df, ["v"], "t", "2 minutes", mode=mode).select("t", "v"), "t")]
    assert fill("last") == [0.5, 0.5, -0.2, -0.2]
    assert fill("running_max") == [0.5, 0.5, 0.5, 0.5]


def test_frames_at_both_ends(spark):
    data = [("s", minute(i), minute(i + 1), 10.0 + i % 3, 12.0, 9.0, 10.0 + (i * i) % 7, float(i)) for i in range(12)]
    df = spark.createDataFrame(data, "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, open double, "
                                     "high double, low double, close double, volume double")
    out = [r.asDict() for r in rolling_features(df, chunk_rows=3).orderBy("window_start").collect()]
    assert out[0]["ret"] is None and out[0]["rolling_vol"] is None and out[1]["rolling_vol"] is None
    assert out[2]["rolling_vol"] is not None
    assert out[-1]["target_vol"] is None and out[-2]["target_vol"] is None and out[-3]["target_vol"] is not None
    assert out[0]["vol_ratio"] is None            # volume and its mean are 0
    strict = [r.asDict() for r in rolling_features(df, min_periods="full", chunk_rows=3).orderBy("window_start").collect()]
    assert strict[4]["rolling_vol"] is None and strict[5]["rolling_vol"] is not None
    assert strict[8]["vol_ratio"] is None and strict[9]["vol_ratio"] is not None


def test_log_returns(spark):
    import math
    data = [("s", minute(i), c) for i, c in enumerate([10.0, 20.0, 0.0, 5.0])]
    df = spark.createDataFrame(data, "symbol string, window_start timestamp_ntz, close double")
    from tickflow.operators.rolling import returns
    got = [r["ret"] for r in returns(df, kind="log").orderBy("window_start").collect()]
    assert got == [None, pytest.approx(math.log(2)), None, None]
    assert [r["ret"] for r in returns(df).orderBy("window_start").collect()] == [None, 1.0, -1.0, None]


def test_gaps(spark):
    data = [("s", minute(i), minute(i + 1)) for i in (0, 1, 4, 5, 9)]
    df = spark.createDataFrame(data, "symbol string, window_start timestamp_ntz, window_end timestamp_ntz")
    assert rows(gaps(df, "1 minute", chunk_rows=2), "gap_start") == [
        ("s", minute(2), minute(4), 2.0), ("s", minute(6), minute(9), 3.0)]


def test_row_index_and_quantiles(spark):
    rng = random.Random(3)
    data = [(rng.choice("aaaab"), float(rng.randint(0, 40))) for _ in range(999)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = rows(row_index(df, ["k", "v"]), "row_index")
    assert [r[2] for r in got] == list(range(999)) and [r[:2] for r in got] == sorted(data)
    q = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", {"q1": 0.25, "median": 0.5, "top": 1.0}).collect()}
    import numpy as np
    for k in "ab":
        values = [v for key, v in data if key == k]
        assert (q[k]["q1"], q[k]["median"], q[k]["top"]) == tuple(np.quantile(values, [0.25, 0.5, 1.0]))
        assert q[k]["n"] == len(values)
