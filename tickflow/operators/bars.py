"""Ticks to OHLCV bars with realized volatility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..functions.scalar import ratio
from ..session import cut_lineage

#: Slices of time a bar is cut into.
SLICES = 256


def tick_order() -> Column:
    """Event time, then trade id, as one number. Its fixed width keeps ``min_by`` and ``max_by``
    in hash aggregates; with a struct Spark would sort all ticks."""
    micros = F.unix_micros(F.col("event_time").cast("timestamp")).cast("decimal(18,0)")
    trade = F.coalesce(F.col("trade_id"), F.lit(-(1 << 63))).cast("decimal(19,0)")
    return (micros * F.lit("20000000000000000000").cast("decimal(20,0)") + trade).cast("decimal(38,0)")


def _with_bar(ticks: DataFrame, width: str) -> DataFrame:
    return (ticks.withColumn("_bar", F.window("event_time", width))
            .withColumn("window_start", F.col("_bar.start"))
            .withColumn("window_end", F.col("_bar.end"))
            .drop("_bar"))


def ohlcv(ticks: DataFrame, width: str = "1 minute", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Bars without volatility: one aggregate, combined before the shuffle.

    Open and close follow event time and trade id, not arrival.
    """
    at = tick_order()
    return (_with_bar(ticks, width).groupBy(*keys, "window_start", "window_end")
            .agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"),
                 F.min("price").alias("low"), F.max_by("price", at).alias("close"),
                 F.sum("quantity").alias("volume"), F.count("price").alias("trade_count")))


def tick_bars(ticks: DataFrame, width: str = "1 minute", keys: Sequence[str] = ("symbol",),
              slices: int = SLICES) -> DataFrame:
    """Bars with the population deviation of simple tick-to-tick returns.

    Returns whose prior price is 0 are left out; a bar without any return has
    NULL volatility. Needing tick order, the ticks are shuffled once, by slices: every
    bar is cut into ``slices`` parts by time, so a busy one spreads over tasks. Each
    part is reduced to its prices at both ends and its return moments, and the parts
    (at most ``slices`` per bar) are merged.
    """
    keys = list(keys)
    bar = [*keys, "window_start", "window_end"]
    rows = _with_bar(ticks, width)
    span = F.timestamp_diff("MICROSECOND", F.col("window_start"), F.col("window_end"))
    into = F.timestamp_diff("MICROSECOND", F.col("window_start"), F.col("event_time"))
    rows = rows.withColumn("_slice", F.floor(into * slices / span).cast("int"))
    part = [*bar, "_slice"]
    at = tick_order()
    prior = F.lag("price").over(Window.partitionBy(*part).orderBy("event_time", "trade_id"))
    parts = (rows.withColumn("_prior", prior)
             .withColumn("_ret", ratio(F.col("price") - F.col("_prior"), "_prior"))
             .groupBy(*part)
             .agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"),
                  F.min("price").alias("low"), F.max_by("price", at).alias("close"),
                  F.sum("quantity").alias("volume"), F.count("price").alias("trade_count"),
                  F.count("_ret").alias("_n"), F.avg("_ret").alias("_mean"),
                  (F.var_pop("_ret") * F.count("_ret")).alias("_m2")))
    return merge_parts(parts, bar, "_slice")


def ranged_bars(ticks: DataFrame, width: str = "1 minute", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """:func:`tick_bars` by a segmented scan: for ticks that crowd into an instant, where slices of time would not part them.

    The ticks are laid in ranges of their order, so that every task holds about as many, however they are spread over
    bars or time. What a range has of a bar is reduced to its prices at both ends and its return moments,
    and the seams between ranges are joined from these rows, at most one per range and bar.
    """
    keys = list(keys)
    bar = [*keys, "window_start", "window_end"]
    # the last key lets ticks of one time and id fall into several ranges
    order = ["event_time", "trade_id", "price", "_row"]
    rows = _with_bar(ticks, width).withColumn("_row", F.monotonically_increasing_id())
    # ranges come from a sample; written, they are the same for both uses
    ranged = cut_lineage(rows.repartitionByRange(*bar, *order).withColumn("_part", F.spark_partition_id()))
    part = [*bar, "_part"]
    prior = F.lag("price").over(Window.partitionBy(*part).orderBy(*order))
    place = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    parts = (ranged.withColumns({"_prior": prior, "_place": place})
             .withColumn("_ret", ratio(F.col("price") - F.col("_prior"), "_prior"))
             .groupBy(*part)
             .agg(F.min_by("price", "_place").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
                  F.max_by("price", "_place").alias("close"), F.sum("quantity").alias("volume"), F.count("price").alias("trade_count"),
                  F.count("_ret").alias("_n"), F.avg("_ret").alias("_mean"), (F.var_pop("_ret") * F.count("_ret")).alias("_m2")))
    return merge_parts(parts, bar, "_part")


def merge_parts(parts: DataFrame, bar: Sequence[str], position: str) -> DataFrame:
    """Join consecutive parts of a bar: the return across each seam counts as one more."""
    along = Window.partitionBy(*bar).orderBy(position)
    whole = Window.partitionBy(*bar)
    before = F.lag("close").over(along)
    seam = parts.withColumn("_seam", ratio(F.col("open") - before, before))
    weight = F.col("_n") + F.when(F.col("_seam").isNotNull(), 1).otherwise(0)
    total = F.coalesce(F.col("_n") * F.col("_mean"), F.lit(0.0)) + F.coalesce("_seam", F.lit(0.0))
    centred = (seam.withColumn("_all", ratio(F.sum(total).over(whole), F.sum(weight).over(whole)))
               .withColumn("_dev",
                           F.coalesce(F.col("_m2") + F.col("_n") * F.pow(F.col("_mean") - F.col("_all"), 2), F.lit(0.0))
                           + F.coalesce(F.pow(F.col("_seam") - F.col("_all"), 2), F.lit(0.0))))
    return (centred.groupBy(*bar)
            .agg(F.min_by("open", position).alias("open"), F.max("high").alias("high"),
                 F.min("low").alias("low"), F.max_by("close", position).alias("close"),
                 F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"),
                 F.sqrt(ratio(F.sum("_dev"), F.sum(weight))).alias("volatility")))


def kline_volatility(open_: str = "open", high: str = "high", low: str = "low",
                     close: str = "close") -> Column:
    """Sample deviation of the three steps open > high > low > close, from column arithmetic."""
    path = [F.col(c) for c in (open_, high, low, close)]
    steps = [ratio(b - a, a) for a, b in zip(path, path[1:])]
    mean = (steps[0] + steps[1] + steps[2]) / 3
    return F.sqrt(sum(((s - mean) * (s - mean) for s in steps[1:]),
                      (steps[0] - mean) * (steps[0] - mean)) / 2)


def log_or_simple_return(price: Column, prior: Column, kind: str = "simple") -> Column:
    if kind == "log":
        return F.when((price > 0) & (prior > 0), F.ln(price / prior))
    return ratio(price - prior, prior)
