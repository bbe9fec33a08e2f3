"""Ticks to bars as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..operators.bars import tick_order

# Bar width, lateness allowed, and the trigger interval.
WIDTH = "1 minute"
WATERMARK = "1 minute"
TRIGGER = "30 seconds"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once. Named in a lambda, an expression is computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _moments(returns: Column) -> Column:
    """(n, mean, m2): count, mean, sum of squared deviations of an array."""
    n = F.size(returns)
    mean = F.try_divide(F.aggregate(returns, F.lit(0.0), lambda a, x: a + x), n)
    return _let(mean, lambda m: F.struct(
        n.alias("n"), m.alias("mean"), F.aggregate(returns, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)).alias("m2")))


def _steps(prices: Column) -> Column:
    """Simple returns between neighbours; a step from 0 is left out."""
    pairs = F.zip_with(F.slice(prices, F.lit(1), F.greatest(F.size(prices) - 1, F.lit(0))),
                       F.slice(prices, F.lit(2), F.greatest(F.size(prices) - 1, F.lit(0))),
                       lambda a, b: F.try_divide(b - a, a))
    return F.filter(pairs, lambda r: r.isNotNull())


def _part(start: Column, prices: Column) -> Column:
    """A slice's prices, in order, as prices at both ends and return moments."""
    return _let(_let(_steps(prices), _moments), lambda r: F.struct(
        start.alias("at"), F.get(prices, F.lit(0)).alias("open"), F.element_at(prices, -1).alias("close"),
        F.array_max(prices).alias("high"), F.array_min(prices).alias("low"), F.size(prices).cast("bigint").alias("ticks"),
        r["n"].alias("n"), r["mean"].alias("mean"), r["m2"].alias("m2")))


def _merged(parts: Column) -> Column:
    """A bar from its slices in order; the return across each seam counts as one more."""
    size = F.greatest(F.size(parts) - 1, F.lit(0))
    seams = F.filter(F.zip_with(F.slice(parts, F.lit(1), size), F.slice(parts, F.lit(2), size),
                                lambda a, b: F.try_divide(b["open"] - a["close"], a["close"])), lambda r: r.isNotNull())
    add = lambda arr, f: F.aggregate(arr, F.lit(0.0), lambda a, x: a + f(x))

    def volatility(both: Column) -> Column:
        within, seam = both["within"], both["seams"]
        count = add(within, lambda x: x["n"].cast("double")) + F.size(seam)
        centre = F.try_divide(add(within, lambda x: x["n"] * x["mean"]) + add(seam, lambda r: r), count)
        return _let(F.struct(count.alias("n"), centre.alias("c")), lambda t: F.sqrt(F.try_divide(
            add(within, lambda x: x["m2"] + x["n"] * (x["mean"] - t["c"]) * (x["mean"] - t["c"]))
            + add(seam, lambda r: (r - t["c"]) * (r - t["c"])), t["n"])))

    return F.struct(
        F.get(parts, F.lit(0))["open"].alias("open"), F.array_max(F.transform(parts, lambda x: x["high"])).alias("high"),
        F.array_min(F.transform(parts, lambda x: x["low"])).alias("low"), F.element_at(parts, -1)["close"].alias("close"),
        F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x["ticks"]).alias("trade_count"),
        _let(F.struct(F.filter(parts, lambda x: x["n"] > 0).alias("within"), seams.alias("seams")), volatility).alias("volatility"))


def stream_ohlcv(ticks: DataFrame, width: str = WIDTH, late: str = WATERMARK,
                 keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Bars without volatility; the state per open bar is one row."""
    at = tick_order()
    return (ticks.withWatermark("event_time", late).groupBy(F.window("event_time", width).alias("w"), *keys)
            .agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
                 F.max_by("price", at).alias("close"), F.sum("quantity").alias("volume"),
                 F.count("price").alias("trade_count"))
            .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "open", "high", "low", "close", "volume", "trade_count"))


def stream_bars(ticks: DataFrame, width: str = WIDTH, slice_width: str = "1 second", late: str = WATERMARK,
                keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Bars with tick volatility, final once the watermark has passed them (append mode).

    Volatility needs the ticks in order. Instead of holding a bar's ticks in one
    group, ticks are held per ``slice_width`` and reduced to prices at both ends
    and return moments; a bar then merges its few slices. ``width`` must be a
    multiple of ``slice_width``.
    """
    tick = F.struct("event_time", "trade_id", "price")
    slices = (ticks.withWatermark("event_time", late)
              .groupBy(F.window("event_time", slice_width).alias("s"), *keys)
              .agg(F.collect_list(tick).alias("_ticks"), F.sum("quantity").alias("volume")))
    prices = F.transform(F.sort_array("_ticks"), lambda t: t["price"])
    slices = slices.select("s", *keys, "volume", _let(prices, lambda p: _part(F.col("s.start"), p)).alias("part"))
    bars = (slices.groupBy(F.window(F.window_time("s"), width).alias("w"), *keys)
            .agg(F.collect_list("part").alias("_p"), F.sum("volume").alias("volume")))
    bars = bars.withColumn("_bar", _let(F.sort_array("_p"), _merged))
    return bars.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       "_bar.open", "_bar.high", "_bar.low", "_bar.close", "volume", "_bar.trade_count", "_bar.volatility")


def stream_posts(posts: DataFrame, delay: str, key: str = "id", time: str = "created_at") -> DataFrame:
    """Posts without those whose ``key`` was seen up to ``delay`` before; the first to arrive stays.

    The state holds a key until the watermark is ``delay`` past its post, so it does not grow with the stream. A key that
    comes again after that is a new post. Posts later than the watermark are dropped, as are all late rows.
    """
    return posts.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
                  partition_by: Sequence[str] = ()) -> None:
    """Process what there is and stop; continues from ``checkpoint`` next time."""
    writer = (stream.writeStream.format("parquet").outputMode(mode).trigger(availableNow=True)
              .option("checkpointLocation", checkpoint).option("path", path))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
