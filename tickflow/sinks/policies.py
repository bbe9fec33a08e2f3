"""What happens when written rows meet rows already there.

The functions return the resulting table or the rows to append; writing is in
``tickflow.sinks.tables``. Keys are unique on the target side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column


def first_in_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in batch.columns if c not in keys]
    return (batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
            .select(*[F.col(c) if c in keys else F.col("_r").getField(c).alias(c) for c in batch.columns]))


def last_in_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in batch.columns if c not in keys]
    return (batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
            .select(*[F.col(c) if c in keys else F.col("_r").getField(c).alias(c) for c in batch.columns]))


def absent(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Rows to append under insert-if-absent: the first of each key not in the target."""
    new = first_in_batch(batch, keys, order) if order else batch
    return new.join(target.select(*keys), list(keys), "left_anti")


def insert_counts(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows insert-if-absent would write and reject (a repeat within the batch is rejected too)."""
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    known = target.select(*keys, F.lit(True).alias("_known"))
    both = per_key.join(known, list(keys), "left")
    written = F.count_if(F.col("_known").isNull())
    return both.agg(written.alias("rows_written"), (F.coalesce(F.sum("_n"), F.lit(0)) - written).alias("rows_rejected"))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None,
           compute: dict[str, Column] | None = None, version: str | None = None) -> DataFrame:
    """Target after an upsert. For a known key the ``update`` columns (default: all)
    take the batch's value, also when that is NULL, and others keep theirs.
    ``compute`` sets columns of known keys from both sides: ``old.x`` and ``new.x``. With ``version`` a known
    row stays whole where its value there is greater than the batch's.
    """
    keys = list(keys)
    values = [c for c in target.columns if c not in keys]
    update = values if update is None else list(update)
    absent_here = [c for c in values if c not in batch.columns]
    for c in absent_here:
        batch = batch.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    pack = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    both = pack(target, "old").join(pack(batch, "new"), keys, "full_outer")
    old, new = F.col("old").isNotNull(), F.col("new").isNotNull()
    stale = F.coalesce(F.col(f"old.{version}") > F.col(f"new.{version}"), F.lit(False)) if version else F.lit(False)
    out = []
    for c in values:
        met = (compute or {}).get(c)
        if met is None:
            met = F.col(f"new.{c}") if c in update and c not in absent_here else F.col(f"old.{c}")
        out.append(F.when(old & new & stale, F.col(f"old.{c}")).when(old & new, met).when(old, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c))
    return both.select(*keys, *out).select(*target.columns)


def mark_failed(runs: DataFrame, failed: DataFrame, as_of: Column) -> DataFrame:
    """Runs with the given ids set to failed and finished."""
    hit = failed.select("run_id", F.lit(True).alias("_hit")).distinct()
    return (runs.join(hit, "run_id", "left")
            .withColumn("quality_status", F.when(F.col("_hit"), "failed").otherwise(F.col("quality_status")))
            .withColumn("finished_at", F.when(F.col("_hit"), as_of).otherwise(F.col("finished_at")))
            .select(*runs.columns))


def retain(df: DataFrame, time: str, as_of: Column, span: str = "30 DAYS") -> DataFrame:
    """Rows that survive a retention delete (rows without a time do)."""
    return df.where(F.col(time).isNull() | (F.col(time) >= as_of - F.expr(f"INTERVAL {span}")))
