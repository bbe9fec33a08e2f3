"""What happens to each micro-batch of bars: store, featurize, score, log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ml import score
from ..operators.rolling import TRAILING, VOLUME_ROWS, rolling_features
from ..plans.features import sentiment_in_force
from ..sinks.tables import Table, log_run
from ..sources.ticks import checked, dead_letters, good_ticks
from .ring import Ring

#: Bars before a batch that its rolling features reach: the longest trailing frame, and one more for the first return.
REACH = max(TRAILING, VOLUME_ROWS) + 1
#: Bars that may still come again (update mode) or late; with them the ring reaches back from the oldest of these.
OPEN_BARS = 5


@dataclass
class BarSink:
    """``foreachBatch`` target. Everything stays a DataFrame plan; replaying a batch
    after a failure leaves the same tables.

    ``policy`` is ``"upsert"`` (latest emission of a bar wins) or ``"first_wins"``
    (a bar stays as first written; later ones count as rejected). ``version`` names a bar column that only grows
    while a bar is open, such as ``trade_count``; with it an older emission never replaces a later one. ``model`` returns
    the current ``(model, version)``, or ``(None, None)`` to skip scoring.

    A batch reads its own days of the bar table, the ring of each symbol's last bars, and of the sentiment table its
    own days and the last one before them, however long the stream has run.
    """
    bars: Table
    predictions: Table
    sentiment: Table
    runs_path: str
    width: str = "1 minute"
    slot: str = "30 minutes"
    policy: str = "upsert"
    version: str | None = None
    source: str = "ticks"
    model: Callable[[], tuple] = field(default=lambda: (None, None))
    ring_path: str | None = None

    def __post_init__(self):
        self.ring = Ring(self.bars.spark, self.ring_path or f"{self.bars.path.rstrip('/')}_ring", REACH + OPEN_BARS,
                         "first" if self.policy == "first_wins" else "last")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fresh = batch.persist()      # computed again, it would run its state stores again
        # a query that starts anew counts its batches from 0 again
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run = f"{query + '-' if query else ''}{batch_id}"
        try:
            if not batch.count():
                return
            if self.version is not None:
                batch = self._not_older(batch).persist()
            written, rejected = self._store(batch)
            scored, version = self._score(batch, run)
            self.ring.merge(batch.where("symbol IS NOT NULL AND window_start IS NOT NULL"), run)
            log_run(batch.sparkSession, self.runs_path, "bar_stream", self.source, "bars", written, rejected, "ok",
                    {"batch_id": str(batch_id), "model_version": str(version), "scored": str(scored)},
                    run_id=f"bar_stream-{run}")
        finally:
            batch.unpersist()
            fresh.unpersist()

    def _not_older(self, batch: DataFrame) -> DataFrame:
        """The batch without emissions older than what is stored."""
        keys = ["symbol", "window_start"]
        stored = self.bars.days_of(batch).select(*keys, F.col(self.version).alias("_stored"))
        return batch.join(stored, keys, "left").where(F.col("_stored").isNull() | (F.col(self.version) >= F.col("_stored"))).drop("_stored")

    def _store(self, batch: DataFrame) -> tuple[int, int]:
        if self.policy == "first_wins":
            return self.bars.insert_absent(batch)
        n, lost = batch.count(), self.bars.upsert(batch, version=self.version)
        return n - lost, lost

    def features(self, batch: DataFrame, run: str) -> DataFrame:
        """Features of the batch's bars, trailing frames complete only, with the sentiment in force."""
        rolled = rolling_features(self.ring.around(batch, run), self.width, min_periods="full")
        keys = ["symbol", "window_start"]
        rolled = rolled.join(batch.select(*keys), keys, "left_semi").where("rolling_vol IS NOT NULL").drop("target_vol")
        first, last = batch.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b")).select(F.to_date("a"), F.to_date("b")).first()
        moods = self.sentiment.days_from_before(first, last).select("window_start", *[
            F.col(c).cast("double").alias(c) for c in ("compound_score", "positive_ratio", "post_count")])
        return sentiment_in_force(rolled, moods, self.slot, F.lit(last).cast("timestamp") + F.expr("INTERVAL 1 DAY"))

    def _score(self, batch: DataFrame, run: str) -> tuple[int, str]:
        model, version = self.model()
        if model is None:
            return 0, "none"
        out = score(model, self.features(batch, run), version).withColumn("inference_latency_ms", F.lit(None).cast("int"))
        out = out.persist()
        try:
            n = out.count()
            if n:
                self.predictions.upsert(out)
            return n, version
        finally:
            out.unpersist()


def split_messages(good_path: str, dead_path: str, value: str = "value") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` target that parts raw messages into ticks and dead letters.

    Each batch has its own folder, overwritten on replay.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = checked(batch, value).persist()
        try:
            good_ticks(rows).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            dead_letters(rows).write.mode("overwrite").parquet(f"{dead_path}/batch={batch_id}")
        finally:
            rows.unpersist()
    return write


def start(bars: DataFrame, sink, checkpoint: str, mode: str = "append", trigger: str | None = None):
    """Start the query; without ``trigger`` it processes what there is and stops."""
    writer = bars.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode(mode)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
