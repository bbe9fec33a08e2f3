"""Streaming jobs run to the end of the given events, and token decoding."""

from __future__ import annotations

import base64
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, StructField, StructType

from tickflow.functions.token import decode_token, encode_token
from tickflow.operators.bars import ohlcv
from tickflow.operators.ml import LinearModel
from tickflow.schemas import PREDICTIONS, SENTIMENT
from tickflow.session import shared_dir
from tickflow.sinks.tables import Table, stream_topic, topic_messages
from tickflow.sources import ticks as st
from tickflow.streaming import bars as sb
from tickflow.streaming import sink as ss

from . import tables as t
from .market import BAR_SQL, PRICES, RAW_SQL
from .registry import query, rounded

CLOSED = BAR_SQL + " WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE"
TEST_KEY = base64.urlsafe_b64encode(bytes(range(32))).decode()      # made up for this check


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def event_stream(spark, sf):
    return st.stream(spark, "parquet", sf, t.events(spark, sf).schema, pathGlobFilter="events.parquet")


def tick_stream(spark, sf):
    return event_stream(spark, sf).select(
        F.col("ts").cast("timestamp").alias("event_time"), F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"))


def _ntz(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_bars", "bars", CLOSED)
def stream_bars(spark, sf):
    """Bars final after the watermark; the last ones are still open."""
    out, state = _folder(spark, "stream-bars"), _folder(spark, "state")
    sb.run_available(sb.stream_bars(tick_stream(spark, sf), t.BAR, "15 minutes"), out, state)
    return rounded(_ntz(spark.read.parquet(out)), *PRICES)


@query("stream_ohlcv", "bars", CLOSED.replace("round(volatility, 6) AS volatility, ", "").replace(
    ", round(volatility, 6) AS volatility", ""))
def stream_ohlcv(spark, sf):
    out, state = _folder(spark, "stream-ohlcv"), _folder(spark, "state")
    sb.run_available(sb.stream_ohlcv(tick_stream(spark, sf), t.BAR), out, state)
    return rounded(_ntz(spark.read.parquet(out)), *PRICES[:-1])


def _parts(frame, time, days, skip="0 hours"):
    """The rows by stretches of ``days``, the first ``skip`` shorter, so that bars lie across the seams; later stretches arrive later."""
    bounds = frame.agg(F.date_trunc("day", F.min(time)).alias("a"), F.max(time).alias("b"))
    cuts = bounds.select(F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {days} DAYS"))).alias("c")).orderBy("c")
    edges = [r[0] for r in cuts.select(F.col("c") - F.expr(f"INTERVAL {skip}")).collect()]
    for i, start in enumerate(edges):
        rows = frame if i == 0 else frame.where(F.col(time) >= F.lit(start))
        yield rows if i + 1 == len(edges) else rows.where(F.col(time) < F.lit(edges[i + 1]))


def _stored_ticks(spark, sf):
    return t.ticks(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp"))


#: Weights of a model that is fixed, so that SQL can state its predictions.
LINEAR = {"rolling_vol": 0.5, "price_range_ratio": 0.25, "vol_ratio": 0.1, "compound_score": -0.2, "positive_ratio": 0.3,
          "post_count": 0.01, "minutes_since_sentiment": 0.001}
#: As with the bars, the test values need more room than the usual columns have.
WIDE = StructType([StructField(f.name, DoubleType()) if isinstance(f.dataType, DecimalType) else f for f in PREDICTIONS])
_IN_FORCE = """
    , known AS (SELECT f.symbol, f.window_start, f.window_end, f.rolling_vol, f.price_range_ratio, f.vol_ratio, max(s.window_start) AS at
                FROM feats f LEFT JOIN all_slots s ON s.window_start <= f.window_start
                WHERE f.n_ret = 5 AND f.n_volume = 10 GROUP BY ALL),
    inputs AS (SELECT k.symbol, k.window_start, k.window_end, k.rolling_vol, k.price_range_ratio, k.vol_ratio, coalesce(s.compound_score, 0) AS compound_score,
                      coalesce(s.positive_ratio, 0.5) AS positive_ratio, coalesce(s.post_count, 0) AS post_count,
                      coalesce(date_diff('second', k.at, k.window_start) / 60.0, 30) AS minutes_since_sentiment
               FROM known k LEFT JOIN all_slots s ON s.window_start = k.at)"""


@query("stream_enriched", "feats all_slots", _IN_FORCE + f"""
    SELECT symbol, window_start, round(rolling_vol, 5) AS rolling_vol, round(price_range_ratio, 5) AS price_range_ratio, round(vol_ratio, 5) AS vol_ratio,
           round(CAST(compound_score AS DOUBLE), 5) AS compound_score, round(CAST(minutes_since_sentiment AS DOUBLE), 5) AS minutes_since_sentiment,
           round({' + '.join(f'{w} * {c}' for c, w in LINEAR.items())}, 4) AS predicted_vol, 'linear' AS model_version
    FROM inputs WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""")
def stream_enriched(spark, sf):
    """The whole micro-batch sink: bars stored, trailing features from the ring, sentiment in force, predictions of a fixed model.

    The ticks arrive in stretches of days; each is a run of the stream that goes on from the checkpoint of the one before.
    """
    keys = ["symbol", "window_start"]
    sink = ss.BarSink(Table(spark, _folder(spark, "bars"), t.BAR_SCHEMA, keys), Table(spark, _folder(spark, "predictions"), WIDE, keys),
                      Table(spark, _folder(spark, "sentiment"), SENTIMENT, ["window_start"]), _folder(spark, "runs"), width=t.BAR, slot=t.SLOT,
                      model=lambda: (LinearModel(LINEAR), "linear"))
    sink.sentiment.upsert(t.all_slots(spark, sf))
    incoming, state, ticks = _folder(spark, "ticks"), _folder(spark, "state"), _stored_ticks(spark, sf)
    for part in _parts(ticks, "event_time", 16, "3 hours"):
        part.write.mode("append").parquet(incoming)
        arrived = st.stream(spark, "parquet", incoming, ticks.schema)
        ss.start(sb.stream_bars(arrived, t.BAR, "15 minutes"), sink, state).awaitTermination()
    out = sink.predictions.read().select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "rolling_vol", "price_range_ratio",
                                         "vol_ratio", "compound_score", "minutes_since_sentiment", F.round("predicted_vol", 4).alias("predicted_vol"), "model_version")
    return rounded(out, "rolling_vol", "price_range_ratio", "vol_ratio", "compound_score", "minutes_since_sentiment", digits=5)


@query("stream_update", "bars", """
    SELECT symbol, window_start, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close,
           round(volume, 6) AS volume, CAST(trade_count AS INTEGER) AS trade_count FROM bars""")
def stream_update(spark, sf):
    """Update mode: open bars are emitted again and again, the last of them too; the table keeps the latest. At the end the first
    stretch's bars are emitted once more, as a replay would, and change nothing."""
    keys = ["symbol", "window_start"]
    sink = ss.BarSink(Table(spark, _folder(spark, "bars"), t.BAR_SCHEMA, keys), Table(spark, _folder(spark, "predictions"), WIDE, keys),
                      Table(spark, _folder(spark, "sentiment"), SENTIMENT, ["window_start"]), _folder(spark, "runs"), width=t.BAR, version="trade_count")
    incoming, state, ticks = _folder(spark, "ticks"), _folder(spark, "state"), _stored_ticks(spark, sf)
    parts = list(_parts(ticks, "event_time", 16, "3 hours"))
    for part in parts:
        part.write.mode("append").parquet(incoming)
        ss.start(sb.stream_ohlcv(st.stream(spark, "parquet", incoming, ticks.schema), t.BAR), sink, state, mode="update").awaitTermination()
    sink(ohlcv(parts[0], t.BAR), 10_000)
    out = sink.bars.read().select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                  *[F.col(c).cast("double").alias(c) for c in PRICES[:-1]], "trade_count")
    return rounded(out, *PRICES[:-1])


@query("stream_dedup", "raw_posts", """
    , again AS (SELECT created_at + INTERVAL 8 DAY AS created_at, id, lang, keyword || '-late' AS keyword FROM raw_posts WHERE id % 10 = 3)
    SELECT created_at, id, lang, keyword FROM raw_posts WHERE keyword NOT LIKE '%-again' UNION ALL SELECT * FROM again""")
def stream_dedup(spark, sf):
    """Every twentieth post comes again after an hour, within the delay; every tenth after eight days, as a new post."""
    posts = t.raw_posts(spark, sf).select(F.col("created_at").cast("timestamp").alias("created_at"), "id", "lang", "keyword")
    once, again = posts.where("keyword NOT LIKE '%-again'"), posts.where("keyword LIKE '%-again'")
    late = once.where("id % 10 = 3").withColumns({"created_at": F.expr("created_at + INTERVAL 8 DAYS"), "keyword": F.concat("keyword", F.lit("-late"))})
    incoming, out, state = _folder(spark, "posts"), _folder(spark, "once"), _folder(spark, "state")
    for part in _parts(once.unionByName(late), "created_at", 7):
        for rows in (part, again.join(part.select("id"), "id", "left_semi")):
            rows.select(*posts.columns).write.mode("append").parquet(incoming)
            sb.run_available(sb.stream_posts(st.stream(spark, "parquet", incoming, posts.schema), "2 hours"), out, state)
    return spark.read.parquet(out).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("stream_decoded", "ticks", """
    SELECT trade_id, symbol, date_trunc('millisecond', event_time) AS event_time, round(price, 6) AS price, round(quantity, 6) AS quantity FROM ticks""")
def stream_decoded(spark, sf):
    """Sealed messages opened on the stream; every fifth arrives in the clear."""
    ticks = _stored_ticks(spark, sf).withColumns({"event_time": F.unix_millis("event_time"), "price": F.col("price").cast("string"),
                                                  "quantity": F.col("quantity").cast("string")})
    text = st.payload_json(ticks)
    sealed = ticks.select(F.when(F.col("trade_id") % 5 == 0, text.cast("binary")).otherwise(
        encode_token(text, TEST_KEY, F.unhex(F.md5(text)), F.unhex(F.lpad(F.hex("trade_id"), 16, "0")))).alias("value"))
    incoming, out = _folder(spark, "sealed"), _folder(spark, "opened")
    sealed.write.parquet(incoming)
    sb.run_available(st.parse_payload(st.stream(spark, "parquet", incoming, sealed.schema), key=TEST_KEY), out, _folder(spark, "state"))
    found = spark.read.parquet(out)
    return rounded(found.select("trade_id", "symbol", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "price", "quantity"), "price", "quantity")


@query("prediction_topic", "predictions", """
    SELECT '{"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S') || '","predicted_vol":' || CAST(round(predicted_vol, 3) AS DECIMAL(18,3))
           || ',"model_version":"' || model_version || '"}' AS value FROM predictions""")
def prediction_topic(spark, sf):
    """Stored predictions followed as a stream and put on a topic, here a folder of text."""
    rows = t.predictions(spark, sf).select("window_start", F.round("predicted_vol", 3).cast("decimal(18,3)").alias("predicted_vol"), "model_version")
    incoming, out = _folder(spark, "predictions"), _folder(spark, "topic")
    rows.write.parquet(incoming)
    stream_topic(topic_messages(st.stream(spark, "parquet", incoming, rows.schema)), "text", _folder(spark, "state"), path=out).awaitTermination()
    return spark.read.text(out)


def _raw_stream(spark, sf):
    e = event_stream(spark, sf)
    body = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("T"), F.col("event_type").alias("s"),
                    F.col("event_id").alias("t"),
                    F.when(F.col("event_id") % 50 != 0, F.col("value").cast("string")).alias("p"),
                    F.get_json_object("props", "$.k").alias("q"), (F.col("event_id") % 2 == 0).alias("m"))
    text = F.to_json(body)
    cut = F.when(F.col("event_id") % 97 == 0, F.substring(text, F.lit(1), F.length(text) - 10)).otherwise(text)
    return e.select(cut.alias("value"))


@query("stream_dlq", sql=f"""
    SELECT CASE WHEN event_id % 97 = 0 THEN raw[1:length(raw) - 10] ELSE raw END AS raw,
           CASE WHEN event_id % 97 = 0 THEN 'malformed JSON' ELSE 'missing fields: p' END AS error
    FROM ({RAW_SQL}) WHERE event_id % 97 = 0 OR event_id % 50 = 0""")
def stream_dlq(spark, sf):
    good, dead = _folder(spark, "good"), _folder(spark, "dead")
    ss.start(_raw_stream(spark, sf), ss.split_messages(good, dead), _folder(spark, "state")).awaitTermination()
    return spark.read.parquet(dead).select("raw", "error")


@query("token_decode", "ticks", """
    SELECT trade_id, '{"trade_id":' || trade_id || ',"price":' || price || '}' AS decoded FROM ticks""")
def token_decode(spark, sf):
    """Ticks sealed into tokens and opened again; every fifth was never sealed."""
    plain = t.ticks(spark, sf).select("trade_id", F.to_json(F.struct("trade_id", "price")).alias("text"))
    iv = F.unhex(F.md5(F.col("text")))
    time = F.unhex(F.lpad(F.hex("trade_id"), 16, "0"))
    sealed = plain.withColumn("value", F.when(F.col("trade_id") % 5 == 0, F.col("text").cast("binary"))
                              .otherwise(encode_token("text", TEST_KEY, iv, time)))
    return sealed.select("trade_id", decode_token("value", TEST_KEY).alias("decoded"))
