"""The model's feature table: bars, sentiment and their joins in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..functions.scalar import minutes_between
from ..operators.rolling import forward_fill, rolling_features
from ..operators.timejoin import asof_join, interval_join, time_series
from ..plans.chunks import CHUNK_ROWS, bounded_frames, chunk_width
from ..schemas import FEATURES, TARGET

SENTIMENT_VALUES = ["compound_score", "positive_ratio", "post_count"]

# What a scorer assumes while no sentiment is known.
DEFAULTS = {"compound_score": 0.0, "positive_ratio": 0.5, "post_count": 0.0, "minutes_since_sentiment": 30.0}


def sentiment_series(bars: DataFrame, slots: DataFrame, width: str = "1 minute", slot: str = "30 minutes",
                     mode: str = "last", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Sentiment at every bar instant from the first bar to the last, gaps filled forward.

    ``mode="last"`` carries the last known value; ``"running_max"`` the highest
    so far. ``last_sentiment_ts`` is the start of the latest slot in both.
    """
    block = chunk_width(width, chunk_rows)
    grid = time_series(bars, "window_start", width, block, "t")
    known = slots.select("window_start", "window_end", *SENTIMENT_VALUES)
    laid = (interval_join(grid, known, "t", "window_start", "window_end", slot)
            .withColumnRenamed("window_start", "last_sentiment_ts").drop("window_end"))
    filled = forward_fill(laid, [*SENTIMENT_VALUES, "last_sentiment_ts"], "t", block, mode=mode)
    return filled.withColumnRenamed("t", "window_start")


def feature_table(bars: DataFrame, slots: DataFrame, width: str = "1 minute", slot: str = "30 minutes",
                  keys: Sequence[str] = ("symbol",), mode: str = "last",
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Features and forward-looking target per bar; rows lacking target, trailing
    volatility or any sentiment so far are left out."""
    priced = rolling_features(bars, width, keys, chunk_rows=chunk_rows)
    priced = priced.where("target_vol IS NOT NULL AND rolling_vol IS NOT NULL")
    mood = sentiment_series(bars, slots, width, slot, mode, chunk_rows).where("compound_score IS NOT NULL")
    return priced.join(mood, "window_start").select(
        *keys, "window_start", "rolling_vol", "price_range_ratio", "vol_ratio", "compound_score", "positive_ratio",
        F.col("post_count").cast("double").alias("post_count"),
        minutes_between("last_sentiment_ts", "window_start").alias("minutes_since_sentiment"), "target_vol")


def latest_sentiment(bars: DataFrame, slots: DataFrame, width: str, key: str = "symbol", spread: int = 64) -> DataFrame:
    """Each bar with the latest slot started at or before it, its age in minutes, and
    defaults while there is none. ``width`` is the time span of a chunk of work; bars of one
    chunk are spread over ``spread`` groups by ``key``, each with a copy of the chunk's few slots."""
    marks = slots.select(F.col("window_start").alias("sentiment_start"), *SENTIMENT_VALUES,
                         F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_spread"))
    bars = bars.withColumn("_spread", F.pmod(F.xxhash64(key), F.lit(spread)).cast("int"))
    out = asof_join(bars, marks, "window_start", "sentiment_start", width, keys=["_spread"]).drop("_spread")
    out = out.withColumn("post_count", F.col("post_count").cast("double")).withColumn(
        "minutes_since_sentiment", minutes_between("sentiment_start", "window_start"))
    for name, value in DEFAULTS.items():
        out = out.withColumn(name, F.coalesce(name, F.lit(value)))
    return out


def sentiment_in_force(bars: DataFrame, slots: DataFrame, slot: str, until: Column) -> DataFrame:
    """Each bar with the latest slot started at or before it, its age in minutes, and defaults while there is none.

    A slot holds until the next one starts, the last one until ``until``, an instant after all bars. These intervals
    are cut at the ends of ``slot`` long buckets, and a bar meets those of its bucket; Spark sends them to the bars
    where they are few.
    """
    columns = bars.columns

    def compute(rows, window):
        return rows.withColumn("sentiment_end", F.lead("sentiment_start").over(window))

    starts = slots.where("window_start IS NOT NULL").select(F.col("window_start").alias("sentiment_start"), *SENTIMENT_VALUES)
    held = bounded_frames(starts, [], ["sentiment_start"], chunk_width(slot, CHUNK_ROWS), 0, 1, compute)
    held = held.withColumn("sentiment_end", F.coalesce("sentiment_end", until)).where("sentiment_end > sentiment_start")
    out = interval_join(bars, held, "window_start", "sentiment_start", "sentiment_end", slot).withColumn(
        "post_count", F.col("post_count").cast("double")).withColumn(
        "minutes_since_sentiment", minutes_between("sentiment_start", "window_start"))
    for name, value in DEFAULTS.items():
        out = out.withColumn(name, F.coalesce(name, F.lit(value)))
    return out.select(*columns, "sentiment_start", *DEFAULTS)


def training_rows(features: DataFrame, minimum: int = 10) -> DataFrame:
    """Inputs and target with NULLs as 0; too little data to train on is an error."""
    if len(features.take(minimum)) < minimum:
        raise ValueError(f"fewer than {minimum} feature rows")
    return features.fillna(0, subset=[*FEATURES, TARGET])
