"""Window features over bars: returns, trailing and forward volatility, volume ratio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ratio
from ..plans.chunks import CHUNK_ROWS, bounded_frames, chunk_width, running
from .bars import log_or_simple_return

#: Rows of the frames: volatility so far (with returns, so one bar more), mean volume, volatility ahead.
TRAILING, VOLUME_ROWS, FORWARD = 5, 10, 5


def rolling_features(bars: DataFrame, width: str = "1 minute", keys: Sequence[str] = ("symbol",),
                     trailing: int = TRAILING, volume_rows: int = VOLUME_ROWS, forward: int = FORWARD,
                     min_periods: str = "partial", kind: str = "simple",
                     chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``ret, rolling_vol, price_range_ratio, vol_ratio, target_vol`` in one pass.

    ``min_periods="full"`` gives NULL until a trailing frame is complete (the way
    a live scorer sees it); ``"partial"`` takes what there is. ``target_vol`` looks
    only ahead of the bar and never includes it. All frames share one window, so
    the bars are sorted once.
    """
    def compute(rows, window):
        close = F.col("close")
        rows = rows.withColumn("ret", log_or_simple_return(close, F.lag("close").over(window), kind))
        back = window.rowsBetween(-(trailing - 1), 0)
        volume = window.rowsBetween(-(volume_rows - 1), 0)
        ahead = window.rowsBetween(1, forward)
        rolling = F.stddev_samp("ret").over(back)
        mean_volume = F.avg("volume").over(volume)
        if min_periods == "full":
            rolling = F.when(F.count("ret").over(back) == trailing, rolling)
            mean_volume = F.when(F.count("volume").over(volume) == volume_rows, mean_volume)
        return (rows.withColumn("rolling_vol", rolling)
                .withColumn("price_range_ratio", ratio(F.col("high") - F.col("low"), "close"))
                .withColumn("vol_ratio", ratio("volume", mean_volume))
                .withColumn("target_vol", F.stddev_samp("ret").over(ahead)))

    return bounded_frames(bars, keys, ["window_start"], chunk_width(width, chunk_rows),
                          before=max(trailing, volume_rows - 1), after=forward, compute=compute)


def returns(bars: DataFrame, width: str = "1 minute", keys: Sequence[str] = ("symbol",),
            kind: str = "simple", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``ret`` alone; frames reach one row back."""
    def compute(rows, window):
        return rows.withColumn("ret", log_or_simple_return(
            F.col("close"), F.lag("close").over(window), kind))

    return bounded_frames(bars, keys, ["window_start"], chunk_width(width, chunk_rows), 1, 0, compute)


def forward_fill(df: DataFrame, columns: Sequence[str], order: str, width: str,
                 keys: Sequence[str] = (), mode: str = "last") -> DataFrame:
    """Replace NULLs by the last value seen (``mode="last"``) or every value by the
    highest seen so far (``mode="running_max"``, what a MAX over an open frame gives).

    ``width`` is the time span of one chunk of work.
    """
    kinds = {"last": "last", "running_max": "max"}
    return running(df, keys, [order], {c: (kinds[mode], c) for c in columns}, width=width)


def gaps(bars: DataFrame, width: str, keys: Sequence[str] = ("symbol",),
         chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Stretches with no bar: ``gap_start`` (end of the last bar), ``gap_end``, minutes."""
    def compute(rows, window):
        return rows.withColumn("gap_start", F.lag("window_end").over(window))

    found = bounded_frames(bars.select(*keys, "window_start", "window_end"), keys, ["window_start"],
                           chunk_width(width, chunk_rows), 1, 0, compute)
    return (found.where(F.col("window_start") > F.col("gap_start"))
            .select(*keys, "gap_start", F.col("window_start").alias("gap_end"),
                    (F.timestamp_diff("SECOND", F.col("gap_start"), F.col("window_start")) / 60.0)
                    .alias("gap_minutes")))


def price_change(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """First and last close over the table and the change in percent."""
    out = bars.groupBy(*keys).agg(F.min_by("close", "window_start").alias("first_close"),
                                  F.max_by("close", "window_start").alias("last_close"))
    return out.withColumn("change_pct", (ratio("last_close", "first_close") - 1) * 100)
