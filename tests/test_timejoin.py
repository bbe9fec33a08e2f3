import random

from conftest import minute, rows
from tickflow.operators.evaluate import backfill, error_metrics, realized_vol
from tickflow.operators.timejoin import asof_join, interval_join, range_join, slot_join, time_series
from pyspark.sql import functions as F


def test_interval_edges(spark):
    left = spark.createDataFrame([(minute(0),), (minute(30),), (minute(59),), (minute(60),)], "t timestamp_ntz")
    right = spark.createDataFrame([(minute(0), minute(30), "x"), (minute(30), minute(60), "y")],
                                  "s timestamp_ntz, e timestamp_ntz, name string")
    got = rows(interval_join(left, right, "t", "s", "e", "30 minutes").select("t", "name"), "t")
    assert got == [(minute(0), "x"), (minute(30), "y"), (minute(59), "y"), (minute(60), None)]
    renamed = right.withColumnsRenamed({"s": "window_start", "e": "window_end"})
    assert rows(slot_join(left, renamed, "t", "30 minutes").select("t", "name"), "t") == got


def test_interval_join_brute_force(spark):
    rng = random.Random(5)
    points = [(rng.choice("ab"), minute(rng.randint(0, 500))) for _ in range(200)]
    spans = [(rng.choice("ab"), minute(s), minute(s + rng.randint(0, 90)), i)
             for i, s in enumerate(rng.randint(0, 500) for _ in range(40))]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame(spans, "k string, s timestamp_ntz, e timestamp_ntz, span int")
    for how in ("left", "inner"):
        got = sorted(rows(interval_join(left, right, "t", "s", "e", "30 minutes", ["k"], how).select("id", "span")),
                     key=lambda r: (r[0], r[1] is not None, r[1] or 0))
        want = []
        for i, (k, t) in enumerate(points):
            hit = [(i, x[3]) for x in spans if x[0] == k and x[1] <= t < x[2]]
            want += hit or ([(i, None)] if how == "left" else [])
        assert got == sorted(want, key=lambda r: (r[0], r[1] is not None, r[1] or 0))


def test_horizon_edges(spark):
    left = spark.createDataFrame([("s", minute(0)), ("s", minute(7))], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("s", minute(i), i) for i in range(0, 14)] + [("z", minute(1), 99)],
                                  "k string, u timestamp_ntz, n int")
    got = rows(range_join(left, right, "t", "u", "5 minutes", ["k"]).select("t", "r_n"), "t", "r_n")
    assert got == [(minute(0), n) for n in range(1, 6)] + [(minute(7), n) for n in range(8, 13)]


def test_asof_brute_force(spark):
    rng = random.Random(11)
    marks = sorted(rng.sample(range(0, 3000), 30))
    left = spark.createDataFrame([(i, minute(rng.randint(0, 3200))) for i in range(150)], "id int, t timestamp_ntz")
    right = spark.createDataFrame([(minute(m), m if m % 3 else None) for m in marks], "u timestamp_ntz, v int")
    got = rows(asof_join(left, right, "t", "u", "4 hours").select("id", "t", "u", "v"), "id")
    for _, t, u, v in got:
        before = [m for m in marks if minute(m) <= t]
        assert u == (minute(before[-1]) if before else None)
        assert v == (before[-1] if before and before[-1] % 3 else None)     # the row counts, also with NULL in it


def test_asof_with_no_right_rows(spark):
    left = spark.createDataFrame([(1, minute(1))], "id int, t timestamp_ntz")
    right = spark.createDataFrame([], "u timestamp_ntz, v int")
    assert rows(asof_join(left, right, "t", "u", "1 hour")) == [(1, minute(1), None, None)]


def test_time_series(spark):
    df = spark.createDataFrame([(minute(3),), (minute(20),)], "t timestamp_ntz")
    assert [r[0] for r in rows(time_series(df, "t", "1 minute", "7 minutes"), "window_start")] == [
        minute(i) for i in range(3, 21)]
    assert rows(time_series(df.where("false"), "t", "1 minute", "7 minutes")) == []


BARS = "symbol string, window_start timestamp_ntz, close double"


def test_realized_vol_sees_only_the_future(spark):
    closes = [10, 11, 10, 12, 9, 10, 14, 13, 13, 10, 11, 12]
    bars = spark.createDataFrame([("s", minute(i), float(c)) for i, c in enumerate(closes)], BARS)
    preds = spark.createDataFrame([("s", minute(2), 0.1, "v1")], "symbol string, window_start timestamp_ntz, "
                                                                 "predicted_vol double, model_version string")
    import statistics
    r = [b / a - 1 for a, b in zip(closes, closes[1:])]
    got = realized_vol(preds, bars, chunk_rows=4).first()["actual_vol"]
    assert abs(got - statistics.stdev(r[2:7])) < 1e-12          # returns at minutes 3..7


def test_backfill_uses_the_stored_prediction(spark):
    bars = spark.createDataFrame([("s", minute(i), 10.0 + (i * i) % 5) for i in range(30)], BARS)
    schema = "symbol string, window_start timestamp_ntz, predicted_vol double, model_version string"
    preds = spark.createDataFrame([("s", minute(i), 0.5, "v2") for i in (2, 3, 28)], schema)
    old = spark.createDataFrame([("s", minute(2), 0.25, None, "v1", None)],
                                "symbol string, window_start timestamp_ntz, predicted_vol double, actual_vol double, "
                                "model_version string, model_mae double")
    as_of = F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")
    got = {r["window_start"]: r for r in backfill(preds, bars, old, as_of).collect()}
    assert set(got) == {minute(2), minute(3)}                     # minute 28 is too young
    a, b = got[minute(2)], got[minute(3)]
    assert a["predicted_vol"] == 0.25 and a["model_version"] == "v1"
    assert abs(a["model_mae"] - abs(a["actual_vol"] - 0.25)) < 1e-12
    assert b["predicted_vol"] == 0.5 and b["model_mae"] is None


def test_metrics_need_ten_predictions(spark):
    def frame(n):
        return spark.createDataFrame([("v1", minute(i), 0.01, 0.0) for i in range(n)],
                                     "model_version string, window_start timestamp_ntz, predicted_vol double, actual_vol double")
    nine, ten = error_metrics(frame(9)).first(), error_metrics(frame(10)).first()
    assert nine["rmse"] is None and nine["mae"] is None and nine["n"] == 9 and nine["model_version"] == "none" and not nine["alert"]
    assert abs(ten["mae"] - 0.01) < 1e-12 and ten["model_version"] == "v1" and ten["alert"]
