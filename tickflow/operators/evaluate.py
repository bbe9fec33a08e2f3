"""Predictions against what happened, model choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..functions.scalar import ratio
from ..plans.chunks import CHUNK_ROWS, running
from .rolling import returns
from .timejoin import range_join

# The acceptance and degradation limits.
BASELINE_MAE = 0.0015
DEGRADATION = 2.0
MIN_PREDICTIONS = 10


def realized_vol(predictions: DataFrame, bars: DataFrame, horizon: str = "5 minutes", width: str = "1 minute",
                 keys: Sequence[str] = ("symbol",), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Sample deviation of the bar returns in ``(t, t + horizon]`` for every prediction at t."""
    keys = list(keys)
    rets = returns(bars, width, keys, chunk_rows=chunk_rows).select(*keys, "window_start", "ret")
    pairs = range_join(predictions.select(*keys, "window_start"), rets, "window_start", "window_start", horizon, keys)
    return pairs.groupBy(*keys, "window_start").agg(F.stddev_samp("r_ret").alias("actual_vol"))


def backfill(predictions: DataFrame, bars: DataFrame, existing: DataFrame, as_of: Column,
             horizon: str = "5 minutes", width: str = "1 minute", lookback: str = "7 DAYS",
             keys: Sequence[str] = ("symbol",), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The evaluation table after filling in actuals.

    Predictions younger than ``lookback`` and at least ``horizon`` old get their
    realized volatility. A row already there keeps its prediction, gets the new
    actual, and the error of that actual against the *stored* prediction; a new
    row has no error yet. Of the bars only the look-back's are read, and those a little before it: a prediction
    stands on a bar, so the first return after it needs none that is older.
    """
    keys = [*keys, "window_start"]
    due = predictions.where((F.col("window_start") > as_of - F.expr(f"INTERVAL {lookback}"))
                            & (F.col("window_start") < as_of - F.expr(f"INTERVAL {horizon}")))
    back = as_of - F.expr(f"INTERVAL {lookback}") - F.expr(f"INTERVAL {horizon}") - F.expr(f"INTERVAL {width}")
    near = bars.where((F.col("window_start") > back) & (F.col("window_start") <= as_of))
    actual = (realized_vol(due, near, horizon, width, keys[:-1], chunk_rows).where("actual_vol IS NOT NULL"))
    fresh = (due.join(actual, keys).select(
        *keys, F.col("predicted_vol").alias("new_predicted"), F.col("actual_vol").alias("new_actual"),
        F.col("model_version").alias("new_version")))
    both = existing.join(fresh, keys, "full_outer")
    known = F.col("predicted_vol").isNotNull()
    return both.select(
        *keys, F.coalesce("predicted_vol", "new_predicted").alias("predicted_vol"),
        F.coalesce("new_actual", "actual_vol").alias("actual_vol"),
        F.when(known, F.col("model_version")).otherwise(F.col("new_version")).alias("model_version"),
        F.when(known & F.col("new_actual").isNotNull(), F.abs(F.col("new_actual") - F.col("predicted_vol")))
        .otherwise(F.col("model_mae")).alias("model_mae"))


def error_metrics(evaluated: DataFrame, as_of: Column | None = None, horizon: str = "12 HOURS",
                  minimum: int = MIN_PREDICTIONS, baseline: float = BASELINE_MAE,
                  limit: float = DEGRADATION, order: Sequence[str] = ("window_start",),
                  by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, degradation against the baseline; NULL below ``minimum`` predictions."""
    rows = evaluated.where("actual_vol IS NOT NULL")
    if as_of is not None:
        rows = rows.where(F.col("window_start") > as_of - F.expr(f"INTERVAL {horizon}"))
    error = F.col("predicted_vol") - F.col("actual_vol")
    enough = F.col("n") >= minimum
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(error * error).alias("_mse"), F.avg(F.abs(error)).alias("_mae"),
        F.max_by("model_version", F.struct(*order)).alias("_version"))
    return out.select(
        *by, F.when(enough, F.sqrt("_mse")).alias("rmse"), F.when(enough, F.col("_mae")).alias("mae"), "n",
        F.when(enough, F.col("_version")).otherwise("none").alias("model_version"),
        F.when(enough, F.col("_mae") / baseline).alias("degradation"),
        F.when(enough, F.col("_mae") / baseline > limit).otherwise(False).alias("alert"))


def residuals(evaluated: DataFrame) -> DataFrame:
    """Predicted and actual side by side."""
    return (evaluated.where("actual_vol IS NOT NULL")
            .withColumn("residual", F.col("actual_vol") - F.col("predicted_vol"))
            .withColumn("error_pct", ratio(F.abs("residual") * 100, "actual_vol")))


def promotions(registry: DataFrame, limit: float = BASELINE_MAE, version: str = "version",
               block: int = 10_000) -> DataFrame:
    """Which versions became champion, trained in version order.

    A version is promoted if its error is under ``limit`` and under that of the
    champion before it. The champion's error is the lowest passing error so far,
    so the history is one running minimum, taken in blocks of versions.
    """
    passing = F.when(F.col("mae") < limit, F.col("mae"))
    before = running(registry, [], [version], {"champion_mae": ("min", passing)},
                     chunk=F.floor(F.col(version) / block), inclusive=False)
    better = F.col("champion_mae").isNull() | (F.col("mae") < F.col("champion_mae"))
    return before.withColumn("promoted", (F.col("mae") < limit) & better)


def serving_version(promoted: DataFrame, version: str = "version") -> DataFrame:
    """The latest promoted version, else the highest there is."""
    return promoted.agg(
        F.coalesce(F.max(F.when(F.col("promoted"), F.col(version))), F.max(version)).alias("version"),
        F.when(F.bool_or("promoted"), "production").otherwise("latest").alias("source"))
