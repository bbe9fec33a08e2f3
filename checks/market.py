"""Ticks, bars, window features, time joins and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.functions import scalar as fs
from tickflow.operators import bars as ob
from tickflow.operators import evaluate as oe
from tickflow.operators import ops, quality, rolling, stats, timejoin
from tickflow.plans import features as pf
from tickflow.schemas import bar_rules
from tickflow.sources import ticks as st

from . import tables as t
from .registry import query, rnd, rounded

PRICES = ["open", "high", "low", "close", "volume", "volatility"]
BAR_SQL = (f"SELECT symbol, window_start, window_end, {rnd(*PRICES)}, CAST(trade_count AS BIGINT) AS trade_count "
           "FROM bars")
FEATURE_COLS = ["rolling_vol", "price_range_ratio", "vol_ratio", "compound_score", "positive_ratio", "post_count",
                "minutes_since_sentiment", "target_vol"]
HORIZON = "30 hours"


@query("bars_ohlcv", "bars", BAR_SQL)
def bars_ohlcv(spark, sf):
    return rounded(t.bars(spark, sf), *PRICES)


@query("bars_sliced", "bars", BAR_SQL)
def bars_sliced(spark, sf):
    """The same with other slices."""
    return rounded(ob.tick_bars(t.ticks(spark, sf), t.BAR, slices=7), *PRICES)


@query("bars_ranged", "bars", BAR_SQL)
def bars_ranged(spark, sf):
    """The same by ranges of the ticks' order."""
    return rounded(ob.ranged_bars(t.ticks(spark, sf), t.BAR), *PRICES)


@query("bars_plain", "bars", f"SELECT symbol, window_start, window_end, {rnd(*PRICES[:-1])}, "
       "CAST(trade_count AS BIGINT) AS trade_count FROM bars")
def bars_plain(spark, sf):
    return rounded(ob.ohlcv(t.ticks(spark, sf), t.BAR), *PRICES[:-1])


# ---- parsing -----------------------------------------------------------------------------

def _cut(text):
    """Every 97th message loses its end."""
    return F.when(F.col("event_id") % 97 == 0, F.expr("substring(raw, 1, length(raw) - 10)")).otherwise(text)


def payloads(spark, sf):
    e = t.events(spark, sf)
    k = F.get_json_object("props", "$.k").cast("double").cast("string")
    price = F.when(F.col("event_id") % 50 != 0, F.col("value").cast("string"))
    body = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"),
                    F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"), price.alias("price"),
                    k.alias("quantity"), (F.col("event_id") % 2 == 0).alias("is_buyer_mm"))
    return e.select("event_id", F.to_json(body).alias("raw")).select(_cut(F.col("raw")).alias("value"))


def raw_trades(spark, sf):
    e = t.events(spark, sf)
    price = F.when(F.col("event_id") % 50 != 0, F.col("value").cast("string"))
    body = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("T"), F.col("event_type").alias("s"),
                    F.col("event_id").alias("t"), price.alias("p"),
                    F.get_json_object("props", "$.k").alias("q"), (F.col("event_id") % 2 == 0).alias("m"))
    return e.select("event_id", F.to_json(body).alias("raw")).select(_cut(F.col("raw")).alias("value"))


@query("tick_parse", "ticks", """
    SELECT date_trunc('millisecond', event_time) AS event_time, trade_id, symbol, price, quantity,
           trade_id % 2 = 0 AS is_buyer_mm
    FROM ticks WHERE trade_id % 50 <> 0 AND trade_id % 97 <> 0""")
def tick_parse(spark, sf):
    return st.parse_payload(payloads(spark, sf)).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


RAW_SQL = """
    SELECT event_id, '{"T":' || epoch_us(ts) // 1000 || ',"s":"' || event_type || '","t":' || event_id
           || CASE WHEN event_id % 50 <> 0 THEN ',"p":"' || value || '"' ELSE '' END
           || ',"q":"' || json_extract_string(props, '$.k') || '","m":' || (event_id % 2 = 0) || '}' AS raw FROM events"""


@query("tick_dlq", sql=f"""
    SELECT CASE WHEN event_id % 97 = 0 THEN raw[1:length(raw) - 10] ELSE raw END AS raw,
           CASE WHEN event_id % 97 = 0 THEN 'malformed JSON' ELSE 'missing fields: p' END AS error
    FROM ({RAW_SQL}) WHERE event_id % 97 = 0 OR event_id % 50 = 0""")
def tick_dlq(spark, sf):
    return st.dead_letters(st.checked(raw_trades(spark, sf)))


@query("tick_good", "ticks", """
    SELECT CAST(epoch_us(event_time) // 1000 AS VARCHAR) AS event_time, symbol, CAST(trade_id AS VARCHAR) AS trade_id,
           CAST(price AS VARCHAR) AS price, CAST(CAST(quantity AS INTEGER) AS VARCHAR) AS quantity,
           trade_id % 2 = 0 AS is_buyer_mm
    FROM ticks WHERE trade_id % 50 <> 0 AND trade_id % 97 <> 0""")
def tick_good(spark, sf):
    return st.good_ticks(st.checked(raw_trades(spark, sf)))


@query("kline_volatility", "bars", """
    SELECT symbol, window_start, window_start + INTERVAL 1 MINUTE AS window_end, open, high, low, close, volume,
           CAST(trade_count AS INTEGER) AS trade_count,
           round((SELECT stddev_samp(x) FROM (VALUES ((high - open) / open), ((low - high) / high),
                                                     ((close - low) / low)) v(x)), 6) AS volatility FROM bars""")
def kline_volatility(spark, sf):
    """Bars written as kline arrays, a day per message, and read back."""
    b = t.bars(spark, sf)
    text = lambda c: F.col(c).cast("string")
    zero = F.lit("0")
    k = F.array(F.unix_millis(F.col("window_start").cast("timestamp")).cast("string"), text("open"), text("high"),
                text("low"), text("close"), text("volume"), zero, zero, text("trade_count"))
    messages = (b.groupBy("symbol", F.to_date("window_start").alias("day"))   # four bars a day
                .agg(F.to_json(F.collect_list(k)).alias("klines")).drop("day"))
    out = st.klines(messages)
    return rounded(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}),
                   "volatility")


@query("bar_reject_reasons", "bars", """
    SELECT symbol, window_start, concat_ws(',',
        CASE WHEN NOT (o > 0) THEN 'open_positive' END, CASE WHEN NOT (high >= o) THEN 'high_ge_open' END,
        CASE WHEN NOT (l <= o AND l > 0) THEN 'low_le_open' END,
        CASE WHEN NOT (volume - 500 >= 0) THEN 'volume_not_negative' END,
        CASE WHEN NOT (high >= l) THEN 'high_ge_low' END) AS reasons
    FROM (SELECT *, open - 20 AS o, low - 1 AS l FROM bars)
    WHERE NOT (o > 0) OR NOT (high >= o) OR NOT (l <= o AND l > 0) OR NOT (volume - 500 >= 0) OR NOT (high >= l)""")
def bar_reject_reasons(spark, sf):
    shifted = t.bars(spark, sf).withColumns({
        "open": F.col("open") - 20, "low": F.col("low") - 1, "volume": F.col("volume") - 500})
    _, rejected = quality.split_by_rules(shifted, bar_rules())
    return rejected.select("symbol", "window_start", F.array_join("reasons", ",").alias("reasons"))


# ---- window features ---------------------------------------------------------------------

def _feature_query(name, columns, sql_columns=None):
    @query(name, "feats", f"SELECT symbol, window_start, {sql_columns or rnd(*columns)} FROM feats")
    def run(spark, sf):
        return rounded(t.features(spark, sf).select("symbol", "window_start", *columns), *columns)
    return run


rolling_vol = _feature_query("rolling_vol", ["rolling_vol"])
forward_vol = _feature_query("forward_vol", ["target_vol"])
vol_ratio = _feature_query("vol_ratio", ["vol_ratio", "price_range_ratio"])


@query("returns", "rets", "SELECT symbol, window_start, round(ret, 6) AS ret FROM rets")
def returns(spark, sf):
    out = rolling.returns(t.bars(spark, sf), t.BAR, chunk_rows=t.CHUNK_ROWS)
    return rounded(out.select("symbol", "window_start", "ret"), "ret")


@query("rolling_strict", "feats", """
    SELECT symbol, window_start, round(CASE WHEN n_ret = 5 THEN rolling_vol END, 6) AS rolling_vol,
           round(CASE WHEN n_volume = 10 THEN vol_ratio END, 6) AS vol_ratio FROM feats""")
def rolling_strict(spark, sf):
    out = rolling.rolling_features(t.bars(spark, sf), t.BAR, min_periods="full", chunk_rows=t.CHUNK_ROWS)
    return rounded(out.select("symbol", "window_start", "rolling_vol", "vol_ratio"), "rolling_vol", "vol_ratio")


def _fill_query(name, mode, cte):
    @query(name, cte, f"""SELECT window_start, compound_score, positive_ratio,
        CAST(post_count AS DOUBLE) AS post_count, last_sentiment_ts FROM {cte}""")
    def run(spark, sf):
        out = pf.sentiment_series(t.bars(spark, sf), t.slots(spark, sf), t.BAR, t.SLOT, mode, t.CHUNK_ROWS)
        return out.withColumn("post_count", F.col("post_count").cast("double"))
    return run


_fill_query("ffill_last", "last", "filled")
_fill_query("ffill_running_max", "running_max", "highest")


@query("feature_view", "features", f"SELECT symbol, window_start, {rnd(*FEATURE_COLS)} FROM features")
def feature_view(spark, sf):
    out = pf.feature_table(t.bars(spark, sf), t.slots(spark, sf), t.BAR, t.SLOT, chunk_rows=t.CHUNK_ROWS)
    return rounded(out, *FEATURE_COLS)


@query("feature_view_running_max", "feats highest", f"""
    SELECT symbol, window_start, {rnd('rolling_vol', 'vol_ratio', 'compound_score', 'positive_ratio', 'target_vol')},
           CAST(post_count AS DOUBLE) AS post_count
    FROM feats JOIN highest USING (window_start)
    WHERE target_vol IS NOT NULL AND rolling_vol IS NOT NULL AND compound_score IS NOT NULL""")
def feature_view_running_max(spark, sf):
    out = pf.feature_table(t.bars(spark, sf), t.slots(spark, sf), t.BAR, t.SLOT, mode="running_max",
                           chunk_rows=t.CHUNK_ROWS)
    cols = ["rolling_vol", "vol_ratio", "compound_score", "positive_ratio", "target_vol"]
    return rounded(out.select("symbol", "window_start", *cols, "post_count"), *cols)


# ---- joins over time ---------------------------------------------------------------------

@query("interval_join_slot", "ticks all_slots", """
    SELECT trade_id, event_time, s.window_start AS slot_start, s.compound_score, s.data_quality
    FROM ticks LEFT JOIN all_slots s ON s.window_start <= event_time AND s.window_end > event_time""")
def interval_join_slot(spark, sf):
    right = t.all_slots(spark, sf).select(F.col("window_start").alias("slot_start"), "window_end", "compound_score",
                                      "data_quality")
    left = t.ticks(spark, sf).select("trade_id", "event_time")
    return timejoin.interval_join(left, right, "event_time", "slot_start", "window_end", t.SLOT).drop("window_end")


@query("slot_join", "ticks all_slots", """
    SELECT trade_id, event_time, s.compound_score, s.data_quality
    FROM ticks LEFT JOIN all_slots s ON s.window_start = time_bucket(INTERVAL '12 hours', event_time)""")
def slot_join(spark, sf):
    right = t.all_slots(spark, sf).select("window_start", "window_end", "compound_score", "data_quality")
    return timejoin.slot_join(t.ticks(spark, sf).select("trade_id", "event_time"), right, "event_time", t.SLOT)


@query("sentiment_asof", "bars slots", """
    SELECT symbol, b.window_start, s.window_start AS sentiment_start, coalesce(compound_score, 0.0) AS compound_score,
           coalesce(positive_ratio, 0.5) AS positive_ratio, coalesce(CAST(post_count AS DOUBLE), 0.0) AS post_count,
           coalesce(date_diff('second', s.window_start, b.window_start) / 60.0, 30.0) AS minutes_since_sentiment
    FROM bars b ASOF LEFT JOIN slots s ON b.window_start >= s.window_start""")
def sentiment_asof(spark, sf):
    out = pf.latest_sentiment(t.bars(spark, sf).select("symbol", "window_start"), t.slots(spark, sf), "4 days")
    return out


@query("gaps", "bars", """
    SELECT symbol, gap_start, window_start AS gap_end, date_diff('second', gap_start, window_start) / 60.0 AS gap_minutes
    FROM (SELECT *, lag(window_end) OVER (PARTITION BY symbol ORDER BY window_start) AS gap_start
          FROM bars WHERE hour(window_start) <> 12) WHERE window_start > gap_start""")
def gaps(spark, sf):
    """The noon bars are taken out to make gaps."""
    return rolling.gaps(t.bars(spark, sf).where(F.hour("window_start") != 12), t.BAR, chunk_rows=t.CHUNK_ROWS)


# ---- evaluation --------------------------------------------------------------------------

@query("realized_vol", "realized", "SELECT symbol, window_start, round(actual_vol, 6) AS actual_vol FROM realized")
def realized_vol(spark, sf):
    out = oe.realized_vol(t.predictions(spark, sf), t.bars(spark, sf), HORIZON, t.BAR, chunk_rows=t.CHUNK_ROWS)
    return rounded(out, "actual_vol")


def _existing(p):
    """Evaluation rows from an earlier pass: one of four bars, predicted a little lower."""
    return p.where(F.hour("window_start") == 6).select(
        "symbol", "window_start", (F.col("predicted_vol") * 0.5).alias("predicted_vol"),
        F.lit(None).cast("double").alias("actual_vol"), "model_version", F.lit(None).cast("double").alias("model_mae"))


@query("prediction_backfill", "predictions realized", """
    , e AS (SELECT symbol, window_start, predicted_vol * 0.5 AS predicted_vol, model_version
            FROM predictions WHERE hour(window_start) = 6),
    n AS (SELECT p.*, a.actual_vol FROM predictions p JOIN realized a USING (symbol, window_start)
          WHERE a.actual_vol IS NOT NULL
            AND p.window_start > (SELECT max(window_start) FROM predictions) - INTERVAL 20 DAY
            AND p.window_start < (SELECT max(window_start) FROM predictions) - INTERVAL 30 HOUR)
    SELECT coalesce(e.symbol, n.symbol) AS symbol, coalesce(e.window_start, n.window_start) AS window_start,
           round(coalesce(e.predicted_vol, n.predicted_vol), 6) AS predicted_vol, round(n.actual_vol, 6) AS actual_vol,
           coalesce(e.model_version, n.model_version) AS model_version,
           round(abs(n.actual_vol - e.predicted_vol), 6) AS model_mae
    FROM e FULL JOIN n ON e.symbol = n.symbol AND e.window_start = n.window_start""")
def prediction_backfill(spark, sf):
    p = t.predictions(spark, sf)
    out = oe.backfill(p, t.bars(spark, sf), _existing(p), fs.latest_instant(p, "window_start"), HORIZON, t.BAR,
                      "20 DAYS", chunk_rows=t.CHUNK_ROWS)
    return rounded(out, "predicted_vol", "actual_vol", "model_mae")


def evaluated(spark, sf):
    p = t.predictions(spark, sf)
    actual = oe.realized_vol(p, t.bars(spark, sf), HORIZON, t.BAR, chunk_rows=t.CHUNK_ROWS)
    return p.join(actual, ["symbol", "window_start"]).where("actual_vol IS NOT NULL")


@query("error_metrics", "evaluated", """
    SELECT symbol, round(CASE WHEN n >= 10 THEN rmse END, 5) AS rmse, round(CASE WHEN n >= 10 THEN mae END, 5) AS mae,
           n, CASE WHEN n >= 10 THEN v ELSE 'none' END AS model_version,
           round(CASE WHEN n >= 10 THEN mae / 0.0015 END, 2) AS degradation, n >= 10 AND mae / 0.0015 > 2.0 AS alert
    FROM (SELECT symbol, sqrt(avg((predicted_vol - actual_vol) ^ 2)) AS rmse, avg(abs(predicted_vol - actual_vol)) AS mae,
                 count(*) AS n, arg_max(model_version, window_start) AS v
          FROM evaluated
          WHERE window_start > (SELECT max(window_start) FROM predictions) - INTERVAL 10 DAY GROUP BY symbol)""")
def error_metrics(spark, sf):
    as_of = fs.latest_instant(t.predictions(spark, sf), "window_start")
    out = oe.error_metrics(evaluated(spark, sf), as_of, "10 DAYS", by=["symbol"])
    return out.withColumns({"rmse": F.round("rmse", 5), "mae": F.round("mae", 5), "degradation": F.round("degradation", 2)})


@query("residuals", "evaluated", """
    SELECT symbol, window_start, model_version, round(actual_vol - predicted_vol, 6) AS residual,
           round(abs(actual_vol - predicted_vol) * 100 / nullif(actual_vol, 0), 3) AS error_pct FROM evaluated""")
def residuals(spark, sf):
    out = oe.residuals(evaluated(spark, sf)).select("symbol", "window_start", "model_version", "residual", "error_pct")
    return out.withColumns({"residual": F.round("residual", 6), "error_pct": F.round("error_pct", 3)})


@query("champion", "promoted", "SELECT version, round(mae, 9) AS mae, round(champion_mae, 9) AS champion_mae, "
       "promoted FROM promoted")
def champion(spark, sf):
    return rounded(oe.promotions(t.registry(spark, sf), block=256), "mae", "champion_mae", digits=9)


@query("serving_version", "promoted", """
    SELECT coalesce(max(CASE WHEN promoted THEN version END), max(version)) AS version,
           CASE WHEN bool_or(promoted) THEN 'production' ELSE 'latest' END AS source FROM promoted""")
def serving_version(spark, sf):
    return oe.serving_version(oe.promotions(t.registry(spark, sf), block=256))


# ---- reports over bars -------------------------------------------------------------------

@query("hourly_rollup", "ticks", """
    SELECT symbol, time_bucket(INTERVAL '1 day', b) AS hour, round(avg(c), 6) AS avg_close, sum(q) AS volume,
           count(*) AS bars
    FROM (SELECT symbol, time_bucket(INTERVAL '1 hour', event_time) AS b, arg_max(price, (event_time, trade_id)) AS c,
                 sum(quantity) AS q FROM ticks GROUP BY 1, 2) GROUP BY 1, 2""")
def hourly_rollup(spark, sf):
    """Hourly bars rolled up by day."""
    return rounded(ops.hourly_rollup(ob.ohlcv(t.ticks(spark, sf), "1 hour"), width="1 day"), "avg_close")


@query("price_change", "bars", """
    SELECT symbol, arg_min(close, window_start) AS first_close, arg_max(close, window_start) AS last_close,
           round((arg_max(close, window_start) / arg_min(close, window_start) - 1) * 100, 4) AS change_pct
    FROM bars GROUP BY symbol""")
def price_change(spark, sf):
    return rounded(rolling.price_change(t.bars(spark, sf)), "change_pct", digits=4)


@query("kpis", "bars", """
    SELECT count(*) AS bars, round(avg(close), 6) AS avg_close, max(high) AS max_high, min(low) AS min_low,
           sum(volume) AS volume, round(avg(volatility), 6) AS avg_volatility FROM bars""")
def kpis(spark, sf):
    return rounded(ops.kpis(t.bars(spark, sf)), "avg_close", "avg_volatility")


@query("hist30", "ticks", """
    , b AS (SELECT min(price) AS lo, max(price) AS hi FROM ticks),
    c AS (SELECT CAST(least(floor((price - lo) / ((hi - lo) / 30)), 29) AS BIGINT) AS bin, count(*) AS n FROM ticks, b GROUP BY 1)
    SELECT bin, round(lo + bin * (hi - lo) / 30, 6) AS bin_start, coalesce(n, 0) AS count
    FROM (SELECT unnest(range(30)) AS bin) LEFT JOIN c USING (bin), b""")
def hist30(spark, sf):
    return rounded(stats.histogram(t.ticks(spark, sf), "price"), "bin_start")


@query("hour_quartiles", "ticks", """
    SELECT CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS n, min(price) AS lowest,
           round(quantile_cont(price, 0.25), 6) AS q1, round(quantile_cont(price, 0.5), 6) AS median,
           round(quantile_cont(price, 0.75), 6) AS q3, max(price) AS highest FROM ticks GROUP BY 1""")
def hour_quartiles(spark, sf):
    return rounded(stats.hour_quartiles(t.ticks(spark, sf), "event_time", "price"), "q1", "median", "q3")


@query("corr_ols", "feats", """
    SELECT round(corr(target_vol, rolling_vol), 6) AS corr, round(regr_slope(target_vol, rolling_vol), 6) AS slope,
           round(regr_intercept(target_vol, rolling_vol), 6) AS intercept,
           CAST(regr_count(target_vol, rolling_vol) AS BIGINT) AS n FROM feats
    WHERE target_vol IS NOT NULL AND rolling_vol IS NOT NULL""")
def corr_ols(spark, sf):
    f = t.features(spark, sf).where("target_vol IS NOT NULL AND rolling_vol IS NOT NULL")
    return rounded(stats.corr_ols(f, "rolling_vol", "target_vol"), "corr", "slope", "intercept")


MATRIX = ["rolling_vol", "price_range_ratio", "vol_ratio", "target_vol"]


@query("corr_matrix", "features", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE AS corr" if a == b else f"round(corr({a}, {b}), 6) AS corr FROM features")
    for a in MATRIX for b in MATRIX))
def corr_matrix(spark, sf):
    out = pf.feature_table(t.bars(spark, sf), t.slots(spark, sf), t.BAR, t.SLOT, chunk_rows=t.CHUNK_ROWS)
    return rounded(stats.corr_matrix(out, MATRIX), "corr")


MEANS = ["rolling_vol", "price_range_ratio", "vol_ratio"]


@query("feature_means", "feats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean_value FROM feats" for c in MEANS))
def feature_means(spark, sf):
    return rounded(stats.feature_means(t.features(spark, sf), MEANS), "mean_value")


@query("variance_filter", "feats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(var_samp({c}), 4) AS variance, round(avg({c}), 6) AS mean_value, "
    f"var_samp({c}) > 1e-15 AS keep FROM {src}" for c, src in
    [("vol_ratio", "feats"), ("price_range_ratio", "feats"), ("flat", "(SELECT 7.0 AS flat FROM feats)")]))
def variance_filter(spark, sf):
    f = t.features(spark, sf).withColumn("flat", F.lit(7.0))
    out = stats.variance_filter(f, ["vol_ratio", "price_range_ratio", "flat"])
    return out.withColumns({"variance": F.round("variance", 4), "mean_value": F.round("mean_value", 6)})


@query("medians", "feats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, round(median({c}), 6) AS median FROM feats" for c in MEANS))
def medians(spark, sf):
    return rounded(stats.medians(t.features(spark, sf), MEANS), "median")


@query("tail_n", "bars", """
    SELECT symbol, window_start, close FROM bars ORDER BY window_start DESC, symbol DESC LIMIT 120""")
def tail_n(spark, sf):
    return ops.newest(t.bars(spark, sf).select("symbol", "window_start", "close"), ["window_start", "symbol"], 120,
                      ascending=True)


@query("version_counts", "predictions", """
    SELECT model_version, count(*) AS predictions, max(window_start) AS last_used FROM predictions GROUP BY 1""")
def version_counts(spark, sf):
    return ops.version_counts(t.predictions(spark, sf))


@query("recent_bars", "bars", """
    SELECT symbol, window_start, close FROM bars
    WHERE window_start > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""")
def recent_bars(spark, sf):
    as_of = fs.latest_instant(t.events(spark, sf), "ts")
    return ops.recent(t.bars(spark, sf), "window_start", as_of, "24 HOURS").select("symbol", "window_start", "close")
