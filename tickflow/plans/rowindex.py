"""Dense row numbers and exact quantiles over a total order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..session import cut_lineage

_LOCAL_BITS = 33   # Spark's monotonically_increasing_id: partition above, position below


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Add ``name`` = 0-based position in ``order`` over the whole table.

    One range shuffle sorts the rows; position inside a partition comes with
    ``monotonically_increasing_id``; the offsets of the partitions are a table of
    one row per partition. The sorted rows are checkpointed, as both uses must
    see the same partitions.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()))
    placed = (placed.withColumn("_part", F.shiftright("_place", _LOCAL_BITS))
              .withColumn("_local", F.col("_place").bitwiseAND((1 << _LOCAL_BITS) - 1)))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    # one row per shuffle partition, so its size is bounded by the job's parallelism
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_local"))
            .drop("_place", "_part", "_local", "_offset"))


#: Chunks per doubling of the value, and a shift that keeps positive numbers above 0.
_PER_DOUBLING, _SHIFT = 256, 300_000


def _value_chunk(value: Column) -> Column:
    """A whole number that never falls as the value rises; values of one chunk differ by 0.3 % at most."""
    size = F.floor(F.log2(F.abs(value)) * _PER_DOUBLING) + _SHIFT
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("bigint"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probabilities: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per key (``{"q1": 0.25}`` -> column ``q1``); NULL and NaN don't count.

    Equal values are counted before anything is ordered, so a value that repeats in any number of
    rows is one row. Counts per chunk of close values tell which chunk holds a rank, and only these
    chunks are ordered inside. Nothing is sorted as a whole.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    counts = (df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, (v + F.lit(0.0)).alias("_v"))
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_chunk", _value_chunk(F.col("_v"))))
    chunks = counts.groupBy(*keys, "_chunk").agg(F.sum("_c").alias("_in"))
    along = Window.partitionBy(*keys).orderBy("_chunk")
    chunks = chunks.withColumns({
        "_before": F.coalesce(F.sum("_in").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_n": F.sum("_in").over(Window.partitionBy(*keys))})
    spots = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probabilities.items()])
    wanted = chunks.select(*keys, "_chunk", "_before", "_in", "_n", F.explode(spots).alias("_s"))
    at = F.col("_s.p") * (F.col("_n") - 1)
    ends = F.array(F.struct(F.floor(at).alias("rank"), F.lit(0).alias("end")), F.struct(F.ceil(at).alias("rank"), F.lit(1).alias("end")))
    wanted = (wanted.select(*keys, "_chunk", "_before", "_in", "_n", F.col("_s.name").alias("_name"),
                            (at - F.floor(at)).alias("_share"), F.explode(ends).alias("_e"))
              .select("*", "_e.*").where((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_in")))
              .drop("_e", "_in"))
    opened = counts.join(wanted.select(*keys, "_chunk", "_before").distinct(), [*keys, "_chunk"])
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_v")
    ranked = opened.withColumn("_last", F.col("_before") + F.sum("_c").over(inside)).withColumn(
        "_first", F.col("_last") - F.col("_c")).drop("_before", "_c")
    hits = wanted.drop("_before").join(ranked, [*keys, "_chunk"]).where(
        (F.col("rank") >= F.col("_first")) & (F.col("rank") < F.col("_last")))
    low, high = (F.max(F.when(F.col("end") == e, F.col("_v"))) for e in (0, 1))
    points = hits.groupBy(*keys, "_name", "_n", "_share").agg(low.alias("_lo"), high.alias("_hi"))
    points = points.withColumn("_q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_share"))
    return (points.groupBy(*keys)
            .agg(F.max("_n").alias("n"),
                 *[F.max(F.when(F.col("_name") == n, F.col("_q"))).alias(n) for n in probabilities]))
