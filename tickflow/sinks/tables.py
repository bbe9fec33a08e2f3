"""Writers: date-partitioned Parquet tables, posts, topics, CSV, run lineage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from pyspark.sql.types import DateType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from ..schemas import RUNS, conform
from ..session import shared_dir
from . import folders, policies

DATE = "dt"
_DAY = re.compile(r"\d{4}-\d\d-\d\d")


class Table:
    """A Parquet table partitioned by the day of its time column."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
                 time: str = "window_start"):
        self.spark, self.path, self.schema, self.keys, self.time = spark, path, schema, list(keys), time
        if time not in self.keys:
            raise ValueError("the time column must be part of the key: a key lives in one day's folder")
        self.stored = StructType([*schema.fields, StructField(DATE, DateType())])

    def _stored_rows(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.stored).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None      # nothing written yet

    def _plain(self, rows: DataFrame | None) -> DataFrame:
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        return rows.select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        return self._plain(self._stored_rows())

    def days_between(self, first: Column | None = None, last: Column | None = None) -> DataFrame:
        """Rows of the days of two instants and all between; other folders are not opened."""
        rows = self._stored_rows()
        if rows is not None and first is not None:
            rows = rows.where(F.col(DATE) >= F.to_date(first))
        if rows is not None and last is not None:
            rows = rows.where(F.col(DATE) <= F.to_date(last))
        return self._plain(rows)

    def days_of(self, batch: DataFrame) -> DataFrame:
        """Rows of the days the batch touches. A day is a partition, so the filter prunes
        files; its values are days, a list that grows with the calendar and not with the rows."""
        rows = self._stored_rows()
        if rows is None:
            return self._plain(None)
        days = [r[0] for r in batch.select(F.to_date(self.time)).distinct().collect()]
        return self._plain(rows.where(F.col(DATE).isin(days)))

    def days_from_before(self, first: date, last: date) -> DataFrame:
        """Rows of the days from ``first`` to ``last`` and of the last stored day before them."""
        rows = self._stored_rows()
        if rows is not None:
            start = max([d for d in self.days() if d < first], default=first)
            rows = rows.where((F.col(DATE) >= F.lit(start)) & (F.col(DATE) <= F.lit(last)))
        return self._plain(rows)

    def days(self) -> list[date]:
        """Days that have a folder, from the names of the folders."""
        names = [n.removeprefix(f"{DATE}=") for n in folders.children(self.spark, self.path)]
        return [date.fromisoformat(n) for n in names if _DAY.fullmatch(n)]

    def folders(self, last: Column) -> list:
        """Days up to that of ``last`` that have a folder."""
        edge = self.spark.range(1).select(F.to_date(last)).first()[0]
        return [d for d in self.days() if d <= edge]

    def delete_path(self, path: str) -> None:
        """Remove a folder, on whatever file system it is."""
        folders.delete(self.spark, path)

    def _keyed(self) -> Column:
        """Whether a row has its whole key; as with NOT NULL columns, others are not stored."""
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])

    @contextmanager
    def _staged(self, df: DataFrame):
        """``df`` computed once, in the shared folder; merging reads it several times."""
        stage = f"{shared_dir(self.spark)}/stage-{uuid.uuid4().hex}"
        try:
            conform(df, self.schema).write.parquet(stage)
            yield self.spark.read.schema(self.schema).parquet(stage)
        finally:
            self.delete_path(stage)

    @contextmanager
    def _usable(self, batch: DataFrame):
        """(staged rows with their whole key, number of rows without)."""
        with self._staged(batch) as rows:
            lost = rows.where(~self._keyed()).count()
            yield rows.where(self._keyed()), lost

    def _write(self, df: DataFrame, mode: str) -> None:
        (df.withColumn(DATE, F.to_date(self.time)).hint("rebalance", DATE)
         .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(self.path))

    def append(self, df: DataFrame) -> None:
        self._write(conform(df, self.schema), "append")

    def replace_days(self, df: DataFrame) -> None:
        """Overwrite exactly the days in ``df``. The rows are staged first, as a table
        cannot be overwritten while it is read."""
        with self._staged(df) as rows:
            self._write(rows, "overwrite")

    def insert_absent(self, batch: DataFrame, order: Sequence[str] | None = None) -> tuple[int, int]:
        """Append rows with unknown keys; returns (written, rejected). Of several rows with
        one key the first in ``order`` counts (default: all columns). Rows that lack a part
        of the key are rejected."""
        with self._usable(batch) as (rows, lost):
            known = self.days_of(rows)
            counts = policies.insert_counts(rows, known, self.keys).first()
            if counts["rows_written"]:
                self.append(policies.absent(rows, known, self.keys, order or self._rest()))
        return counts["rows_written"], counts["rows_rejected"] + lost

    def upsert(self, batch: DataFrame, update: Sequence[str] | None = None, compute=None,
               order: Sequence[str] | None = None, version: str | None = None) -> int:
        """Merge by key, rewriting only the days touched. Replaying a batch changes nothing.
        Of several rows with one key the last in ``order`` counts (default: all columns). With ``version``, a
        column that grows from one state of a row to the next, a stored row only gives way to one that is not older.
        Rows that lack a part of the key are rejected; returns their number."""
        with self._usable(batch) as (rows, lost):
            last = policies.last_in_batch(rows, self.keys, order or ([version] if version else []) + self._rest())
            self.replace_days(policies.upsert(self.days_of(rows), last, self.keys, update, compute, version))
        return lost

    def _rest(self) -> list[str]:
        return [c for c in self.schema.fieldNames() if c not in self.keys]


def load_tables(targets: dict[str, tuple[Table, str]], frames: dict[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """Write several frames, each by its table's policy: ``append``, ``absent`` or ``upsert``."""
    done = {}
    for name, df in frames.items():
        table, policy = targets[name]
        if policy == "absent":
            done[name] = table.insert_absent(df)
            continue
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        lost = table.append(df) or 0 if policy == "append" else table.upsert(df)
        done[name] = (seen.get["rows"] - lost, lost)
    return done


def post_lake(posts: DataFrame, path: str, slot: str = "30 minutes", time: str = "created_at") -> None:
    """Posts into ``year/month/day/slot`` folders by their slot's start.

    A slot that is written again replaces its folder, so a retry leaves it as it was.
    Rebalancing gives a folder one file, or several of even size if it is large.
    """
    start = F.window(time, slot).getField("start")
    (posts.withColumn("_start", start)
     .withColumn("year", F.date_format("_start", "yyyy")).withColumn("month", F.date_format("_start", "MM"))
     .withColumn("day", F.date_format("_start", "dd")).withColumn("slot", F.date_format("_start", "HH_mm"))
     .drop("_start").hint("rebalance", "year", "month", "day", "slot").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day", "slot").parquet(path))


def topic_messages(predictions: DataFrame) -> DataFrame:
    """Predictions as the JSON put on a topic."""
    return predictions.select(F.to_json(F.struct(
        F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss").alias("window_start"),
        F.col("predicted_vol"), F.col("model_version"))).alias("value"))


def to_topic(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    messages.write.format(fmt).options(**options).mode("append").save()


def stream_topic(messages: DataFrame, fmt: str, checkpoint: str, trigger: str | None = None, **options: str):
    """Follow a stream of messages and put them on a topic; without ``trigger`` what there is, once."""
    writer = messages.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def to_csv(df: DataFrame, path: str) -> None:
    """A result as CSV with a header; quotes inside a value are doubled."""
    df.write.mode("overwrite").options(header="true", escape='"').csv(path)


def run_row(spark: SparkSession, pipeline: str, source: str, target: str, written: int, rejected: int,
            status: str, params: dict[str, str], run_id: str | None = None) -> DataFrame:
    """A finished run as a row of the run table."""
    import json
    row = spark.range(1).select(
        F.lit(run_id or str(uuid.uuid4())).alias("run_id"), F.lit(pipeline).alias("pipeline_name"),
        F.lit(source).alias("source"), F.lit(target).alias("target_table"),
        F.lit(written).alias("rows_processed"), F.lit(rejected).alias("rows_rejected"),
        F.lit(status).alias("quality_status"), F.current_timestamp().alias("started_at"),
        F.current_timestamp().alias("finished_at"), F.lit(json.dumps(params)).alias("params"))
    return conform(row, RUNS)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table: a folder per run."""
    try:
        return spark.read.schema(RUNS).parquet(path).select(*RUNS.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS)


def _write_runs(rows: DataFrame, path: str) -> None:
    (rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))


def log_run(spark: SparkSession, path: str, *args, **kwargs) -> None:
    """Store a run. A run that is there already stays as it was first logged: what a
    replay writes or rejects says nothing about the run."""
    row = run_row(spark, *args, **kwargs)
    run_id = kwargs.get("run_id")
    if run_id is None or read_runs(spark, path).where(F.col("run_id") == run_id).isEmpty():
        _write_runs(row, path)


def mark_run_failed(spark: SparkSession, path: str, run_ids: Sequence[str], as_of: Column | None = None) -> None:
    """Set stored runs to failed and finished; other runs' folders are not touched."""
    hit = read_runs(spark, path).where(F.col("run_id").isin(list(run_ids)))
    failed = policies.mark_failed(hit, hit.select("run_id"), as_of if as_of is not None else F.current_timestamp())
    # a table cannot be overwritten while it is read, so the few rows are kept first
    stage = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}"
    failed.write.parquet(stage)
    _write_runs(spark.read.schema(RUNS).parquet(stage), path)
    target = spark._jvm.org.apache.hadoop.fs.Path(stage)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def purge(table: Table, as_of, span: str = "30 DAYS") -> None:
    """Retention delete: the day of the limit is rewritten without its older rows, whole
    days before it lose their folder."""
    limit = as_of - F.expr(f"INTERVAL {span}")
    days = table.folders(limit)        # listed before the files below them change
    if not days:
        return
    edge = table.spark.range(1).select(F.to_date(limit)).first()[0]
    kept = policies.retain(table.days_between(limit, limit), table.time, as_of, span)
    some_kept = not kept.isEmpty()
    if some_kept:
        table.replace_days(kept)
    for day in days:
        if not (day == edge and some_kept):
            table.delete_path(f"{table.path}/{DATE}={day}")
