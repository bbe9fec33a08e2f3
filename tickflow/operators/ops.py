"""Logs, runs and metric tables: filters, roll-ups, newest rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.column import Column

from ..functions.scalar import hour_start, ratio
from ..session import shared_dir

ERROR_LEVELS = ("ERROR", "CRITICAL")


def recent(df: DataFrame, time: str, as_of: Column, span: str) -> DataFrame:
    """Rows younger than ``span``, seen from ``as_of`` (a literal, so the filter is pushed down)."""
    return df.where(F.col(time) > as_of - F.expr(f"INTERVAL {span}"))


def newest(df: DataFrame, order: Sequence[str], n: int, ascending: bool = False) -> DataFrame:
    """The ``n`` newest rows; ``order`` ends with a tie-break. Spark keeps the top ``n``
    of each task, so nothing is sorted as a whole."""
    top = df.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(n)
    return top.orderBy(*order) if ascending else top


def page(df: DataFrame, order: Sequence[str], start: int, n: int) -> DataFrame:
    """Rows ``start .. start + n`` in ``order``."""
    return df.orderBy(*order).offset(start).limit(n)


class PagedTable:
    """A table laid out once in its order, whose pages open only the partitions they lie in.

    Rows are written in ranges of ``order``, a folder per range, in the shared folder; their counts give every range its
    first position. A page then reads one range, or a few where it lies across their ends, and sorts no other. How many
    there are is up to AQE, unless ``ranges`` says.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], ranges: int | None = None):
        spark = df.sparkSession
        self.spark, self.order, self.schema = spark, list(order), df.schema
        self.path = f"{shared_dir(spark)}/pages-{uuid.uuid4().hex}"
        placed = (df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)).withColumn("_range", F.spark_partition_id())
        placed.write.partitionBy("_range").parquet(self.path)
        # one row per range, so its size is bounded by the job's parallelism
        counts = sorted(tuple(r) for r in self._stored().groupBy("_range").count().collect())
        self.starts, self.rows = [], 0
        for name, n in counts:
            self.starts.append((name, self.rows, n))
            self.rows += n

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_range", T.IntegerType())])).parquet(self.path)

    def page(self, start: int, n: int) -> DataFrame:
        """Rows ``start .. start + n`` in the order."""
        hit = [(name, first) for name, first, size in self.starts if first < start + n and first + size > start]
        if not hit:
            return self.spark.createDataFrame([], self.schema)
        rows = self._stored().where(F.col("_range").isin([name for name, _ in hit])).drop("_range")
        return page(rows, self.order, start - hit[0][1], n)


def filter_logs(logs: DataFrame, service: str | None = None, level: str | None = None,
                limit: int = 200, tie_break: str | None = None) -> DataFrame:
    """Newest log rows; each filter applies only when given."""
    if service:
        logs = logs.where(F.col("service") == service)
    if level:
        logs = logs.where(F.col("level") == level)
    return newest(logs, ["timestamp", *([tie_break] if tie_break else [])], limit)


def alert_history(logs: DataFrame, limit: int = 30, tie_break: str | None = None) -> DataFrame:
    return filter_logs(logs.where(F.col("level").isin(*ERROR_LEVELS)), limit=limit, tie_break=tie_break)


def level_counts(logs: DataFrame, as_of: Column, span: str = "24 HOURS") -> DataFrame:
    return recent(logs, "timestamp", as_of, span).groupBy("level").agg(F.count(F.lit(1)).alias("count"))


def services(logs: DataFrame) -> DataFrame:
    return logs.select("service").distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def error_series(logs: DataFrame, as_of: Column, span: str = "7 DAYS") -> DataFrame:
    errors = recent(logs, "timestamp", as_of, span).where(F.col("level").isin(*ERROR_LEVELS))
    return errors.groupBy(hour_start("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("errors"))


def run_success(runs: DataFrame, ok: Sequence[str] = ("ok", "promoted")) -> DataFrame:
    """Runs and success rate in percent per pipeline."""
    good = F.sum(F.when(F.col("quality_status").isin(*ok), 1).otherwise(0))
    return runs.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("runs"), good.alias("succeeded"),
        F.round(good * 100.0 / F.count(F.lit(1)), 1).alias("success_rate"))


def overall_success(rates: DataFrame) -> DataFrame:
    """Mean of the pipelines' rates."""
    return rates.agg(F.round(F.avg("success_rate"), 1).alias("mean_success_rate"))


def run_errors(runs: DataFrame, as_of: Column, span: str = "24 HOURS") -> DataFrame:
    return recent(runs, "finished_at", as_of, span).groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(F.col("quality_status") == "failed", 1).otherwise(0)).alias("failures"),
        F.max("finished_at").alias("last_run"))


def run_timeline(runs: DataFrame) -> DataFrame:
    """Start, end and duration of the runs that have finished."""
    return (runs.where("started_at IS NOT NULL AND finished_at IS NOT NULL")
            .select("run_id", "pipeline_name", "quality_status", "started_at", "finished_at",
                    F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at")).alias("duration_s")))


def newest_runs(runs: DataFrame, n: int = 100) -> DataFrame:
    """Newest runs first; runs that have not finished come last."""
    return runs.orderBy(F.desc_nulls_last("finished_at"), "run_id").limit(n)


def log_summary(runs: DataFrame, audit: DataFrame, as_of: Column, span: str = "1 HOUR",
                service: str = "pipeline_orchestrator") -> DataFrame:
    """Log rows for the last hour: runs (if any), failures (if any), audit events (always)."""
    r = recent(runs, "finished_at", as_of, span).agg(
        F.count(F.lit(1)).alias("pipeline_runs_1h"),
        F.count_if(F.col("quality_status") == "failed").alias("pipeline_failed_1h"))
    a = recent(audit, "changed_at", as_of, span).agg(F.count(F.lit(1)).alias("audit_events_1h"))
    stats = ["pipeline_runs_1h", "pipeline_failed_1h", "audit_events_1h"]
    entry = lambda level, col, text: F.struct(
        F.lit(level).alias("level"), F.col(col).alias("n"),
        F.concat(F.col(col).cast("string"), F.lit(f" {text} in last hour")).alias("message"))
    entries = F.array(
        F.when(F.col(stats[0]) > 0, entry("INFO", stats[0], "pipeline runs")),
        F.when(F.col(stats[1]) > 0, entry("ERROR", stats[1], "pipeline failures")),
        entry("INFO", stats[2], "audit events"))
    return (r.withColumn("audit_events_1h", a.scalar()).withColumn("extra", F.to_json(F.struct(*stats)))
            .select(F.explode(F.array_compact(entries)).alias("e"), "extra")
            .select(F.lit(service).alias("service"), "e.level", "e.message", "extra"))


def hourly_rollup(bars: DataFrame, keys: Sequence[str] = ("symbol",), width: str = "1 hour") -> DataFrame:
    return bars.groupBy(*keys, F.window("window_start", width).getField("start").alias("hour")).agg(
        F.avg("close").alias("avg_close"), F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("bars"))


def kpis(bars: DataFrame) -> DataFrame:
    return bars.agg(F.count(F.lit(1)).alias("bars"), F.avg("close").alias("avg_close"),
                    F.max("high").alias("max_high"), F.min("low").alias("min_low"),
                    F.sum("volume").alias("volume"), F.avg("volatility").alias("avg_volatility"))


def version_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("predictions"), F.max("window_start").alias("last_used"))


def top_groups_series(df: DataFrame, group: str, columns: Sequence[str], n: int = 5) -> DataFrame:
    """All rows of the ``n`` most frequent groups."""
    top = (df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), group).limit(n).select(group))
    return df.select(*columns).join(F.broadcast(top), group, "left_semi")   # n rows


def usage_columns(cpu: DataFrame) -> DataFrame:
    """Used CPU is what is not idle."""
    return cpu.withColumn("usage_total", F.round(100 - F.col("usage_idle"), 1))


def status_with_memory(status: DataFrame, memory: DataFrame) -> DataFrame:
    """Latest status of each container with its latest memory reading, if any."""
    return status.join(memory, "container_name", "left")


def share_pct(part: str, whole: str) -> Column:
    return F.round(ratio(F.col(part) * 100.0, whole), 2)
