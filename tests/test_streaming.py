import base64
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from conftest import minute, rows
from tickflow.functions.token import decode_token, encode_token
from tickflow.operators import ml
from tickflow.operators.bars import tick_bars
from tickflow.operators.rolling import rolling_features
from tickflow.plans.features import latest_sentiment, sentiment_in_force
from tickflow.schemas import BARS, FEATURES, PREDICTIONS, RUNS, SENTIMENT
from tickflow.sinks.tables import Table
from tickflow.sources.ticks import stream
from tickflow.streaming import bars as sb
from tickflow.streaming import sink as ss
from tickflow.streaming.ring import Ring

TICKS = StructType([StructField("symbol", StringType()), StructField("event_time", TimestampType()),
                    StructField("trade_id", LongType()), StructField("price", DoubleType()),
                    StructField("quantity", DoubleType())])


def feed(spark, path, data):
    """One more file of ticks."""
    spark.createDataFrame(data, TICKS).coalesce(1).write.mode("append").parquet(path)


def tick(m, i, price=10.0, symbol="s"):
    return (symbol, minute(m), i, price, 1.0)


def source(spark, path):
    return stream(spark, "parquet", path, TICKS, maxFilesPerTrigger="1")


def test_stream_equals_batch_on_closed_bars(spark, tmp_path):
    path = str(tmp_path / "in")
    data = [tick(i * 0.13, i, 10.0 + (i * 7) % 11, "st"[i % 2]) for i in range(300)]
    for part in (data[:100], data[100:220], data[220:]):
        feed(spark, path, part)
    sb.run_available(sb.stream_bars(source(spark, path)), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {(r["symbol"], r["window_start"]): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = tick_bars(spark.createDataFrame(data, TICKS)).collect()
    last = max(d[1] for d in data)
    closed = [r for r in batch if (last - r["window_end"]).total_seconds() >= 60]
    assert len(closed) > 60 and len(got) == len(closed)
    for r in closed:
        g = got[r["symbol"], r["window_start"]]
        assert all(g[c] == r[c] for c in ("open", "high", "low", "close", "volume", "trade_count"))
        assert g["volatility"] == (None if r["volatility"] is None else pytest.approx(r["volatility"], abs=1e-12))


def test_late_ticks_and_restart(spark, tmp_path):
    path, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    run = lambda: sb.run_available(sb.stream_ohlcv(source(spark, path)), out, cp)
    feed(spark, path, [tick(0.1, 1), tick(1.2, 2)])
    run()                                         # watermark 0.2: nothing is final
    assert spark.read.schema("window_start timestamp").parquet(out).count() == 0 if os.path.isdir(out) else True
    feed(spark, path, [tick(0.5, 3, 20.0), tick(3.5, 4)])      # late, but before the watermark passed it
    run()
    feed(spark, path, [tick(0.6, 5, 99.0), tick(6.0, 6)])      # too late: dropped
    run()
    got = {r["window_start"]: (r["high"], r["trade_count"]) for r in spark.read.parquet(out).collect()}
    assert got[minute(0)] == (20.0, 2) and got[minute(1)] == (10.0, 1) and minute(6) not in got


class Fixed:
    """A stand-in model that predicts twice the rolling volatility."""

    def transform(self, df):
        return df.withColumn("predicted_vol", F.col("rolling_vol") * 2).withColumn("features", F.lit(0))


def make_sink(spark, tmp_path, **kw):
    keys = ["symbol", "window_start"]
    return ss.BarSink(Table(spark, str(tmp_path / "bars"), BARS, keys),
                      Table(spark, str(tmp_path / "predictions"), PREDICTIONS, keys),
                      Table(spark, str(tmp_path / "sentiment"), SENTIMENT, ["window_start"]),
                      str(tmp_path / "runs"), **kw)


BAR = "symbol string, window_start timestamp, window_end timestamp, open double, high double, low double, " \
      "close double, volume double, trade_count int, volatility double"


def bar_batch(spark, minutes, symbol="s"):
    return spark.createDataFrame([(symbol, minute(m), minute(m + 1), 10.0, 11.0, 9.0, 10.0 + (m * m) % 3 * .1, 5.0 + m % 4, 3, 0.01)
                                  for m in minutes], BAR)


def test_sink_scores_from_the_bar_table_and_replays(spark, tmp_path):
    sink = make_sink(spark, tmp_path, model=lambda: (Fixed(), "v7"))
    mood = spark.createDataFrame([(minute(0), minute(30), 0.2, 0.5, 0.1, 0.4, 0.2, 9, "ok", None)],
                                 "window_start timestamp, window_end timestamp, compound_score double, positive_ratio double, "
                                 "negative_ratio double, neutral_ratio double, weighted_compound double, post_count int, "
                                 "data_quality string, source_file string")
    sink.sentiment.upsert(mood)
    sink(bar_batch(spark, range(0, 4)), 0)                # too few bars to score
    assert sink.predictions.read().count() == 0
    for _ in range(2):                                    # replay changes nothing
        sink(bar_batch(spark, range(4, 14)), 1)
    got = sink.predictions.read().orderBy("window_start").collect()
    # vol_ratio needs 10 bars, so the first complete feature row is bar 9
    assert [r["window_start"] for r in got] == [minute(m) for m in range(9, 14)]
    assert all(abs(float(r["predicted_vol"]) - 2 * float(r["rolling_vol"])) < 1e-7 for r in got)
    assert [float(r["minutes_since_sentiment"]) for r in got] == [9.0, 10.0, 11.0, 12.0, 13.0]
    assert {r["model_version"] for r in got} == {"v7"} and float(got[0]["compound_score"]) == 0.2
    assert sink.bars.read().count() == 14
    log = spark.read.schema(RUNS).parquet(str(tmp_path / "runs"))
    assert {r["run_id"] for r in log.collect()} == {"bar_stream-0", "bar_stream-1"}


def test_sink_knows_the_last_bars_however_old(spark, tmp_path):
    sink = make_sink(spark, tmp_path, model=lambda: (Fixed(), "v1"))
    sink(bar_batch(spark, range(0, 12)), 0)
    far = 10 * 1440
    sink(bar_batch(spark, [far, far + 1]), 1)             # the bars before lie ten days back
    assert {minute(far), minute(far + 1)} <= {r["window_start"] for r in sink.predictions.read().collect()}


def test_sink_policies_and_empty_batch(spark, tmp_path):
    sink = make_sink(spark, tmp_path, policy="first_wins")
    sink(bar_batch(spark, []), 0)
    assert not os.path.exists(tmp_path / "runs")
    sink(bar_batch(spark, [0, 1]), 1)
    sink(bar_batch(spark, [1, 2]).withColumn("close", F.lit(99.0)), 2)
    assert {(r["window_start"], float(r["close"])) for r in sink.bars.read().collect()} == {
        (minute(0), 10.0), (minute(1), 10.1), (minute(2), 99.0)}
    log = {r["run_id"]: (r["rows_processed"], r["rows_rejected"]) for r in spark.read.schema(RUNS).parquet(str(tmp_path / "runs")).collect()}
    assert log == {"bar_stream-1": (2, 0), "bar_stream-2": (1, 1)}


@pytest.mark.parametrize("version", [None, "trade_count"])
def test_sink_computes_a_batch_once(spark, tmp_path, version):
    """A batch that is looked at before it is kept runs its state stores twice."""
    log = str(tmp_path / "computed")

    def counted(batches):
        for batch in batches:
            with open(log, "a") as out:
                out.write(f"{batch.num_rows}\n")
            yield batch

    sink = make_sink(spark, tmp_path, version=version)
    sink(bar_batch(spark, range(0, 20)).coalesce(1).mapInArrow(counted, BAR), 0)
    assert open(log).read() == "20\n" and sink.bars.read().count() == 20


def test_stream_split_into_ticks_and_dead_letters(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"T":1,"s":"X","t":1,"p":"1.5","q":"2"}\nbroken\n')
    lines = spark.readStream.text(str(tmp_path / "in"))
    ss.start(lines, ss.split_messages(str(tmp_path / "good"), str(tmp_path / "dead")), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1
    assert rows(spark.read.parquet(str(tmp_path / "dead")).select("raw", "error")) == [("broken", "malformed JSON")]


KEY = base64.urlsafe_b64encode(bytes(range(32))).decode()


def test_token_round_trip_and_fall_through(spark):
    iv, time = F.unhex(F.lit("00" * 16)), F.unhex(F.lit("00" * 8))
    df = spark.createDataFrame([("tick é",), ("",)], "p string").withColumn("tok", encode_token("p", KEY, iv, time))
    assert [r[0] for r in df.select(decode_token("tok", KEY)).collect()] == ["tick é", ""]
    token = df.first()["tok"].decode()
    other = base64.urlsafe_b64encode(bytes(range(1, 33))).decode()
    assert df.select(decode_token("tok", other)).first()[0] == token               # wrong key: passes as text
    flipped = token[:30] + ("A" if token[30] != "A" else "B") + token[31:]
    cases = [flipped, "gAAAAA", "{\"a\":1}", "gAAAA" + "A" * 95]
    raw = spark.createDataFrame([(c.encode(),) for c in cases] + [(b"\xff\xfe",), (None,)], "v binary")
    assert [r[0] for r in raw.select(decode_token("v", KEY)).collect()] == cases + ["��", None]
    assert [r[0] for r in raw.select(decode_token("v", None)).collect()] == cases + ["��", None]


def test_hmac_against_the_standard_library(spark):
    import hashlib
    import hmac
    from tickflow.functions.token import hmac_sha256
    got = spark.range(1).select(hmac_sha256(b"key-of-16-bytes!", F.lit(b"message"))).first()[0]
    assert bytes(got) == hmac.new(b"key-of-16-bytes!", b"message", hashlib.sha256).digest()


def test_scoring_is_skipped_without_a_model(spark):
    assert ml.score(None, spark.range(1), "v1") is None
    df = spark.createDataFrame([tuple([1.0] * 7), tuple([None] + [1.0] * 6)], ", ".join(f"{c} double" for c in FEATURES))
    assert ml.score(Fixed(), df, "v1").count() == 1       # a missing feature is not scored


# -- ring of last bars ----------------------------------------------------------------------------

def ring_rows(frame):
    return {r["symbol"]: [(b["window_start"], b["close"]) for b in r["bars"]] for r in frame.collect()}


def test_ring_is_bounded_and_replays(spark, tmp_path):
    ring = Ring(spark, str(tmp_path / "ring"), 4)
    ring.merge(bar_batch(spark, range(0, 9)), "q-0")
    ring.merge(bar_batch(spark, [2], "t"), "q-1")
    assert [m for m, _ in ring_rows(ring.now())["s"]] == [minute(m) for m in (5, 6, 7, 8)]
    assert [m for m, _ in ring_rows(ring.now())["t"]] == [minute(2)]
    again = bar_batch(spark, [8, 9]).withColumn("close", F.lit(77.0))
    ring.merge(again, "q-2")
    want = ring_rows(ring.now())
    assert [(m, c) for m, c in want["s"]][-2:] == [(minute(8), 77.0), (minute(9), 77.0)] and len(want["s"]) == 4
    for _ in range(2):                                    # a replay starts from what q-2 started from
        assert [m for m, _ in ring_rows(ring.before("q-2"))["s"]][-1] == minute(8)
        ring.merge(again, "q-2")
        assert ring_rows(ring.now()) == want
    assert len(os.listdir(tmp_path / "ring")) == 2        # a batch reads and leaves no more, however long it runs
    ring.merge(bar_batch(spark, [0]).withColumn("close", F.lit(1.0)), "q-3")      # too old: it would have no neighbours
    assert ring_rows(ring.now()) == want


def test_ring_that_keeps_the_first(spark, tmp_path):
    ring = Ring(spark, str(tmp_path / "ring"), 3, keep="first")
    ring.merge(bar_batch(spark, [0, 1]), "0")
    ring.merge(bar_batch(spark, [1, 2]).withColumn("close", F.lit(99.0)), "1")
    assert [c for _, c in ring_rows(ring.now())["s"]] == [10.0, 10.1, 99.0]
    with pytest.raises(ValueError):
        ring.seed(bar_batch(spark, [5]))
    with pytest.raises(ValueError):
        Ring(spark, str(tmp_path / "x"), 3, keep="some")


def test_unfinished_version_is_no_state(spark, tmp_path):
    ring = Ring(spark, str(tmp_path / "ring"), 3)
    ring.merge(bar_batch(spark, [0, 1]), "0")
    ring.merge(bar_batch(spark, [2]), "1")
    os.remove(tmp_path / "ring" / f"v{1:012d}" / "1" / "_SUCCESS")
    assert [m for m, _ in ring_rows(ring.now())["s"]] == [minute(0), minute(1)]


def test_batches_equal_strict_frames_over_the_whole_series(spark, tmp_path):
    """Batches of odd sizes, two symbols with gaps; every scored bar as if all bars were one table."""
    sink = make_sink(spark, tmp_path, model=lambda: (Fixed(), "v1"))
    series = {"s": [m for m in range(60) if m % 7], "t": [m * 3000 for m in range(40)]}
    for i, (a, b) in enumerate([(0, 3), (3, 17), (17, 18), (18, 40), (40, 60)]):
        parts = [bar_batch(spark, v[a:b], k) for k, v in series.items() if v[a:b]]
        sink(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), i)
    whole = rolling_features(bar_batch(spark, series["s"], "s").unionByName(bar_batch(spark, series["t"], "t")), min_periods="full")
    want = {(r["symbol"], r["window_start"]): round(r["rolling_vol"], 8) for r in whole.where(
        "rolling_vol IS NOT NULL AND vol_ratio IS NOT NULL").collect()}
    got = {(r["symbol"], r["window_start"]): float(r["rolling_vol"]) for r in sink.predictions.read().collect()}
    assert got == pytest.approx(want, abs=1e-8) and len(got) > 60


def test_late_bar_does_not_stand_in_for_its_neighbours(spark, tmp_path):
    sink = make_sink(spark, tmp_path, model=lambda: (Fixed(), "v1"))
    sink(bar_batch(spark, range(0, 40)), 0)
    before = {r["window_start"]: r["predicted_vol"] for r in sink.predictions.read().collect()}
    sink(bar_batch(spark, [3, *range(26, 40)]), 1)
    assert {r["window_start"]: r["predicted_vol"] for r in sink.predictions.read().collect()} == before


def test_sentiment_in_force_equals_the_latest_slot(spark, tmp_path):
    mood = spark.createDataFrame([(minute(m), minute(m + 30), m / 1e4, .5, m) for m in (0, 30, 60, 150, 5000)],
                                 "window_start timestamp, window_end timestamp, compound_score double, positive_ratio double, post_count int")
    bars = bar_batch(spark, [-5, 0, 29, 30, 61, 149, 150, 4999, 5000, 9000]).select("symbol", "window_start")
    got = sentiment_in_force(bars, mood, "30 minutes", F.lit(minute(20_000))).orderBy("window_start").collect()
    want = latest_sentiment(bars, mood, "4 hours").orderBy("window_start").collect()
    assert [[r[c] for c in ("window_start", "compound_score", "positive_ratio", "post_count", "minutes_since_sentiment")] for r in got] == \
           [[r[c] for c in ("window_start", "compound_score", "positive_ratio", "post_count", "minutes_since_sentiment")] for r in want]
    assert got[0]["positive_ratio"] == 0.5 and got[0]["minutes_since_sentiment"] == 30.0 and len(got) == 10
    table = Table(spark, str(tmp_path / "mood"), SENTIMENT, ["window_start"])
    table.upsert(mood)
    days = table.days()
    assert days == sorted(days) and len(days) == 2
    read = table.days_from_before(days[1], days[1])       # its own day and the last one before it
    assert read.count() == 5 and table.days_from_before(days[0], days[0]).count() == 4


# -- update mode, replays, doubles ------------------------------------------------------------------

def test_update_mode_emits_open_bars_and_older_emissions_change_nothing(spark, tmp_path):
    path = str(tmp_path / "in")
    sink = make_sink(spark, tmp_path, version="trade_count")
    seen = []

    def recorded(batch, batch_id):
        seen.append(batch.collect())
        sink(batch, batch_id)

    def run():
        ss.start(sb.stream_ohlcv(source(spark, path)), recorded, str(tmp_path / "cp"), mode="update").awaitTermination()

    feed(spark, path, [tick(0.1, 1), tick(0.2, 2, 12.0)])
    run()
    assert [(r["trade_count"], float(r["high"])) for r in sink.bars.read().collect()] == [(2, 12.0)]      # still open
    feed(spark, path, [tick(0.5, 3, 15.0), tick(1.1, 4)])
    run()
    stored = sorted((r["window_start"], r["trade_count"], float(r["high"]), float(r["close"])) for r in sink.bars.read().collect())
    assert stored == [(minute(0), 3, 15.0, 15.0), (minute(1), 1, 10.0, 10.0)]
    old = next(b for b in seen if b)
    sink(spark.createDataFrame(old, sb.stream_ohlcv(source(spark, path)).schema), 99)
    assert sorted((r["window_start"], r["trade_count"], float(r["high"]), float(r["close"])) for r in sink.bars.read().collect()) == stored


def test_posts_come_once_within_the_delay(spark, tmp_path):
    path, out = str(tmp_path / "posts"), str(tmp_path / "out")
    kind = "id string, created_at timestamp, text string"

    def run(*posts):
        spark.createDataFrame([(i, minute(m), t) for i, m, t in posts], kind).coalesce(1).write.mode("append").parquet(path)
        stream_ = stream(spark, "parquet", path, spark.createDataFrame([], kind).schema)
        sb.run_available(sb.stream_posts(stream_, "10 minutes"), out, str(tmp_path / "cp"))

    run(("a", 0, "first"), ("b", 1, "b"))
    run(("a", 5, "again"), ("c", 30, "c"))
    run(("a", 40, "much later"), ("c", 35, "again"))
    got = sorted((r["id"], r["text"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", "first"), ("a", "much later"), ("b", "b"), ("c", "c")]


def test_linear_model(spark):
    rows_ = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert ml.LinearModel({"a": 2, "b": -1}, 0.5).transform(rows_).first()["predicted_vol"] == 0.5


def test_a_slice_computes_its_mean_once(spark):
    """Named in a lambda, the mean, and with it the order of the ticks, was computed again for every tick; so was a bar's for every slice."""
    bars = sb.stream_bars(spark.createDataFrame([tick(0, 1)], TICKS))
    plan = bars._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 2          # the steps of a slice and the seams of a bar
