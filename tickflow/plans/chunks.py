"""Ordered computations that never put one key's whole history in one task.

A key (symbol) may hold any share of the rows, so ``Window.partitionBy(symbol)``
does not scale. The order is cut into chunks of time instead:

* :func:`bounded_frames` - frames of a fixed number of rows before / after.
  Each chunk also gets copies of the neighbouring rows its frames reach (halo).
* :func:`running` - frames from the start of the series. Each chunk is reduced
  to one summary row; the summaries are accumulated and handed back as the
  value carried into the chunk.

Chunks are a function of the row alone, so both references to a chunk agree
even when a lost executor makes Spark compute the rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column
from pyspark.sql.window import WindowSpec

CHUNK = "_chunk"
HALO = "_halo"

#: Rows a chunk of a regular series should hold at most.
CHUNK_ROWS = 4096


def chunk_width(row_width: str, rows: int = CHUNK_ROWS) -> str:
    """Interval text spanning ``rows`` steps of ``row_width`` ("1 minute", 3 -> "3 minute")."""
    count, unit = row_width.split()
    return f"{int(count) * rows} {unit}"


def by_time(df: DataFrame, order: str, width: str) -> DataFrame:
    return df.withColumn(CHUNK, F.window(F.col(order), width).getField("start"))


def bounded_frames(df: DataFrame, keys: Sequence[str], order: Sequence[str], width: str,
                   before: int, after: int,
                   compute: Callable[[DataFrame, WindowSpec], DataFrame]) -> DataFrame:
    """Apply ``compute(rows, window)`` where no frame reaches more than ``before``
    rows back or ``after`` rows ahead; ``order[0]`` is the time column.

    Equals computing over ``Window.partitionBy(keys).orderBy(order)``.
    """
    keys = list(keys)
    base = by_time(df, order[0], width)
    group = [*keys, CHUNK]
    ordered = Window.partitionBy(*group).orderBy(*order)
    ranked = (base.withColumn("_from_head", F.row_number().over(ordered))
              .withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy(*group))))
    at_head = F.col("_from_head") <= after
    at_tail = F.col("_from_head") > F.col("_size") - before
    row = F.struct(*order, *[c for c in df.columns if c not in order])
    edges = (ranked.where(at_head | at_tail)
             .groupBy(*group)
             .agg(F.array_sort(F.collect_list(F.when(at_tail, row))).alias("_tail"),
                  F.array_sort(F.collect_list(F.when(at_head, row))).alias("_head")))

    # Every chunk has at least one row, so `before` chunks back hold `before` rows.
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    parts = []
    if before:
        reach = F.flatten(F.collect_list("_tail").over(along.rowsBetween(-before, -1)))
        parts.append(F.when(F.size(reach) > before, F.slice(reach, -before, before)).otherwise(reach))
    if after:
        reach = F.flatten(F.collect_list("_head").over(along.rowsBetween(1, after)))
        parts.append(F.when(F.size(reach) > after, F.slice(reach, 1, after)).otherwise(reach))
    halo = (edges.withColumn("_copies", F.concat(*parts))
            .select(CHUNK, F.explode("_copies").alias("_row"))
            .select(*[F.col("_row").getField(c).alias(c) for c in df.columns], CHUNK,
                    F.lit(True).alias(HALO)))
    padded = base.withColumn(HALO, F.lit(False)).unionByName(halo)
    return compute(padded, ordered).where(~F.col(HALO)).drop(HALO, CHUNK)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            specs: dict[str, tuple[str, str | Column]], width: str | None = None,
            chunk: Column | None = None, inclusive: bool = True) -> DataFrame:
    """Add columns accumulated from the start of the series.

    ``specs`` maps an output column to ``(kind, input)``; kind is ``last`` (last
    non-NULL), ``max``, ``min``, ``sum`` or ``count``. ``inclusive=False`` leaves
    the current row out. Chunks come from ``width`` over ``order[0]`` or from
    ``chunk``, any expression that never decreases along the order.
    """
    keys = list(keys)
    base = by_time(df, order[0], width) if chunk is None else df.withColumn(CHUNK, chunk)
    group = [*keys, CHUNK]
    for name, (_, source) in specs.items():
        base = base.withColumn(f"_in_{name}", F.col(source) if isinstance(source, str) else source)

    at = F.struct(*order)
    whole, add_up = {}, {}
    for name, (kind, _) in specs.items():
        value = F.col(f"_in_{name}")
        whole[name] = {
            "last": lambda v=value: F.max_by(v, F.when(v.isNotNull(), at)),
            "max": lambda v=value: F.max(v),
            "min": lambda v=value: F.min(v),
            "sum": lambda v=value: F.sum(v),
            "count": lambda v=value: F.count(v),
        }[kind]()
        add_up[name] = {
            "last": lambda c: F.last(c, ignorenulls=True),
            "max": F.max, "min": F.min, "sum": F.sum, "count": F.sum,
        }[kind]

    def merged(kind: str, carried: Column, local: Column) -> Column:
        if kind == "last":
            return F.coalesce(local, carried)
        if kind == "max":
            return F.greatest(carried, local)
        if kind == "min":
            return F.least(carried, local)
        total = F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
        return total if kind == "count" else F.when(carried.isNotNull() | local.isNotNull(), total)

    summary = base.groupBy(*group).agg(*[e.alias(f"_all_{n}") for n, e in whole.items()])
    along = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(CHUNK)
    carried = summary.select(*group, *[
        add_up[n](F.col(f"_all_{n}")).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_carry_{n}")
        for n in specs])

    upto = 0 if inclusive else -1
    local_frame = (Window.partitionBy(*group).orderBy(*order)
                   .rowsBetween(Window.unboundedPreceding, upto))
    out = base.join(carried, group, "left")
    for name, (kind, _) in specs.items():
        local = {"last": lambda c: F.last(c, ignorenulls=True), "max": F.max, "min": F.min,
                 "sum": F.sum, "count": F.count}[kind](F.col(f"_in_{name}")).over(local_frame)
        out = out.withColumn(name, merged(kind, F.col(f"_carry_{name}"), local))
    kept = [c for c in df.columns if c not in specs]
    return out.select(*kept, *specs)
