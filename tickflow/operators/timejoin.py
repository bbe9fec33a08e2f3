"""Joins over time: interval, range, as-of, and generated series.

Each is an equi-join on a time bucket plus the exact condition, so Spark hashes
or sorts by key; written plainly they would be nested loops over both inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import slot_start
from ..plans.chunks import running


def time_series(df: DataFrame, time: str, step: str, block: str, name: str = "window_start") -> DataFrame:
    """Every ``step`` instant from the earliest to the latest ``time``.

    Blocks are laid out first and spread over tasks, then filled.
    """
    bounds = df.agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    blocks = bounds.select("_lo", "_hi", F.explode(F.sequence(
        F.col("_lo"), F.col("_hi"), F.expr(f"INTERVAL {block}"))).alias("_block"))
    ends = F.least(F.col("_block") + F.expr(f"INTERVAL {block}") - F.expr(f"INTERVAL {step}"), F.col("_hi"))
    return (blocks.where("_block IS NOT NULL").repartition("_block")
            .select(F.explode(F.sequence(F.col("_block"), ends, F.expr(f"INTERVAL {step}"))).alias(name)))


def interval_join(left: DataFrame, right: DataFrame, time: str, start: str, end: str,
                  bucket: str, keys: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Left rows with the right rows whose ``[start, end)`` holds ``time``.

    A right row is copied to every bucket it touches, so ``bucket`` should be
    about as long as the intervals.
    """
    keys = list(keys)
    first = slot_start(start, bucket)
    last = slot_start(F.col(end) - F.expr("INTERVAL 1 MICROSECOND"), bucket)
    spread = (right.withColumn("_first", first).withColumn("_last", last)
              .where(F.col(end) > F.col(start))
              .withColumn("_bucket", F.explode(F.sequence("_first", "_last", F.expr(f"INTERVAL {bucket}"))))
              .drop("_first", "_last"))
    a = left.withColumn("_bucket", slot_start(time, bucket)).alias("a")
    b = spread.alias("b")
    on = F.col("a._bucket") == F.col("b._bucket")
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    on = on & (F.col(f"b.{start}") <= F.col(f"a.{time}")) & (F.col(f"b.{end}") > F.col(f"a.{time}"))
    taken = set(left.columns)
    return a.join(b, on, how).select(
        *[F.col(f"a.{c}") for c in left.columns],
        *[F.col(f"b.{c}") for c in right.columns if c not in keys and c not in taken])


def slot_join(left: DataFrame, slots: DataFrame, time: str, slot: str,
              start: str = "window_start", end: str = "window_end", how: str = "left") -> DataFrame:
    """:func:`interval_join` for slots of one fixed width: the slot start is the key itself."""
    right = slots.withColumnRenamed(start, "_start")
    a = left.withColumn("_start", slot_start(time, slot))
    return a.join(right.drop(end), "_start", how).drop("_start")


def range_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, horizon: str,
               keys: Sequence[str] = ()) -> DataFrame:
    """Pairs with ``left_time < right_time <= left_time + horizon``.

    Right rows sit in one bucket of length ``horizon``; a left row looks into its
    own and the next. For right rows on a grid the pairs per left row are bounded
    by ``horizon`` / grid step. Right columns are prefixed ``r_``.
    """
    keys = list(keys)
    reach = F.expr(f"INTERVAL {horizon}")
    own = slot_start(left_time, horizon)
    probes = left.withColumn("_own", own).withColumn(
        "_bucket", F.explode(F.array("_own", F.col("_own") + reach))).drop("_own")
    targets = (right.select(*[F.col(c).alias(c if c in keys else f"r_{c}") for c in right.columns])
               .withColumn("_bucket", slot_start(f"r_{right_time}", horizon)))
    return (probes.join(targets, [*keys, "_bucket"])
            .where((F.col(f"r_{right_time}") > F.col(left_time))
                   & (F.col(f"r_{right_time}") <= F.col(left_time) + reach))
            .drop("_bucket"))


def asof_join(left: DataFrame, right: DataFrame, time: str, right_time: str, width: str,
              keys: Sequence[str] = ()) -> DataFrame:
    """Each left row with the latest right row at or before it (NULLs if none).

    Both sides are laid in one order and the last right row is carried along,
    chunk by chunk; nothing is paired. Right columns keep their names; a clash
    with a left column is an error.
    """
    keys = list(keys)
    payload = [c for c in right.columns if c not in keys]
    clash = set(payload) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    rows = left.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"),
                       F.struct(*left.columns).alias("_left"),
                       F.lit(None).cast(right.select(F.struct(*payload)).schema[0].dataType).alias("_right"))
    marks = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
                         F.lit(None).cast(rows.schema["_left"].dataType).alias("_left"),
                         F.struct(*payload).alias("_right"))
    filled = running(rows.unionByName(marks), keys, ["_t", "_side"], {"_right": ("last", "_right")}, width=width)
    return filled.where("_side = 1").select("_left.*", *[F.col("_right").getField(c).alias(c) for c in payload])
