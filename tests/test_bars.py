import random
import statistics
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import minute, rows
from tickflow.operators.bars import kline_volatility, ohlcv, ranged_bars, tick_bars
from tickflow.operators.quality import split_by_rules
from tickflow.schemas import bar_rules

TICK = "symbol string, event_time timestamp_ntz, trade_id bigint, price double, quantity double"


def brute(data):
    bars = {}
    for s, t, i, p, q in sorted(data, key=lambda r: (r[1], r[2])):
        bars.setdefault((s, t.replace(second=0, microsecond=0)), []).append((p, q))
    out = {}
    for k, v in bars.items():
        p = [x for x, _ in v]
        r = [(b - a) / a for a, b in zip(p, p[1:]) if a != 0]
        out[k] = (p[0], max(p), min(p), p[-1], sum(q for _, q in v), len(p), statistics.pstdev(r) if r else None)
    return out


@pytest.mark.parametrize("slices", [1, 16, 256])
def test_bars_equal_brute_force_however_sliced(spark, slices):
    rng = random.Random(1)
    data = []
    for i in range(600):     # a third of the ticks in one bar, many at one instant
        at = 3.5 if i % 3 == 0 and i % 2 else (3 + rng.random() * 0.99 if i % 3 == 0 else rng.randint(0, 20) + rng.random() * 0.9)
        data.append(("s" if i % 3 == 0 else rng.choice("st"), minute(round(at, 4)), i, float(rng.choice([0, 1, 2, 5, 7])), 1.0))
    rng.shuffle(data)
    df = spark.createDataFrame(data, TICK)
    got = {(r["symbol"], r["window_start"]): r for r in tick_bars(df, slices=slices).collect()}
    want = brute(data)
    assert got.keys() == want.keys()
    for k, w in want.items():
        g = got[k]
        assert (g["open"], g["high"], g["low"], g["close"], g["volume"], g["trade_count"]) == w[:6], k
        assert g["volatility"] == (None if w[6] is None else pytest.approx(w[6], abs=1e-12)), k


def test_order_ties_single_tick_and_zero_price(spark):
    df = spark.createDataFrame([
        ("a", minute(0), 2, 11.0, 1.0), ("a", minute(0), 1, 10.0, 1.0),          # same instant: trade id decides
        ("b", minute(0), 1, 5.0, 2.0),                                         # one tick
        ("c", minute(0), 1, 0.0, 1.0), ("c", minute(0.1), 2, 4.0, 1.0),          # only prior price is 0
    ], TICK)
    got = {r["symbol"]: r for r in tick_bars(df).collect()}
    assert (got["a"]["open"], got["a"]["close"]) == (10.0, 11.0)
    assert got["b"]["volatility"] is None and got["b"]["trade_count"] == 1
    assert got["c"]["volatility"] is None
    plain = {r["symbol"]: r for r in ohlcv(df).collect()}
    assert (plain["a"]["open"], plain["a"]["close"], plain["a"]["volume"]) == (10.0, 11.0, 2.0)


def test_kline_volatility(spark):
    df = spark.createDataFrame([(10.0, 12.0, 9.0, 11.0)], "open double, high double, low double, close double")
    got = df.select(kline_volatility()).first()[0]
    assert got == pytest.approx(statistics.stdev([0.2, -0.25, 2 / 9]))


def test_rule_split(spark):
    df = spark.createDataFrame([(1, 10.0, 12.0, 9.0, 11.0, 1.0, 1, None), (2, -1.0, 5.0, 6.0, 0.0, -1.0, 0, -0.1)],
                               "id int, open double, high double, low double, close double, volume double, "
                               "trade_count int, volatility double")
    good, bad = split_by_rules(df, bar_rules())
    assert [r["id"] for r in good.collect()] == [1] and "reasons" not in good.columns
    assert bad.first()["reasons"] == ["open_positive", "low_le_open", "close_positive", "volume_not_negative",
                                      "trade_count_positive", "volatility_not_negative", "high_ge_low"]


def test_low_never_above_open_or_close(spark):
    from checks import tables
    from conftest import SF
    b = tables.bars(spark, SF)
    assert b.where("low > open OR low > close OR high < open OR high < close OR trade_count < 1").count() == 0
    assert b.agg(F.sum("trade_count")).first()[0] == tables.ticks(spark, SF).count()
    assert rows(b.groupBy("symbol", "window_start").count().where("count > 1")) == []


def test_ranged_bars_equal_brute_force_and_spread_one_instant(spark):
    """Nine of ten ticks stand in one slice of one bar; they are dealt over the tasks all the same."""
    rng = random.Random(8)
    data = [("s", minute(3) + timedelta(microseconds=i // 3), i, rng.choice([0.0, 1.0, 2.5, 4.0]), 1.0) for i in range(3600)]
    data += [(rng.choice("st"), minute(rng.random() * 9), 10_000 + i, 1.0 + rng.random(), 2.0) for i in range(400)]
    frame = spark.createDataFrame(data, TICK)
    got = {(r["symbol"], r["window_start"]): r for r in ranged_bars(frame).collect()}
    want = brute(data)
    assert set(got) == set(want)
    for k, (o, h, lo, c, v, n, vol) in want.items():
        r = got[k]
        assert (r["open"], r["high"], r["low"], r["close"], r["trade_count"]) == (o, h, lo, c, n) and r["volume"] == pytest.approx(v)
        assert r["volatility"] == (None if vol is None else pytest.approx(vol, rel=1e-9))
    same = spark.createDataFrame([("s", minute(0), None, 1.0, 1.0)] * 500, TICK)        # not even the ids differ
    assert [(r["trade_count"], r["volatility"]) for r in ranged_bars(same).collect()] == [(500, 0.0)]
    ranges = frame.repartitionByRange(4, "symbol", "event_time", "trade_id").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranges) < 2000
