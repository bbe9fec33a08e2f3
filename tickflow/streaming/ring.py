"""The last bars of every symbol, kept from one micro-batch to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import folders

#: What the features of a bar are made of.
VALUES = ("window_end", "open", "high", "low", "close", "volume")


def newest_per_key(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """Last ``n`` rows of each key. Spark keeps ``n`` per key in every task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


class Ring:
    """One row per symbol with an array of its last ``size`` bars, in order.

    Every run (a query's batch) leaves a version of its own, made from the version before it, so a
    replayed run starts from what it started from the first time and leaves the same. Only the last two versions
    are kept. A version is a row per symbol, whatever the number of bars that came before; a batch that brings more
    bars of a symbol than ``size`` passes on the last ones. ``keep="last"`` lets a bar that comes again replace
    its earlier self, ``keep="first"`` ignores it.
    """

    def __init__(self, spark: SparkSession, path: str, size: int, keep: str = "last"):
        if keep not in ("first", "last"):
            raise ValueError(f"keep is first or last, not {keep}")
        self.spark, self.path, self.size, self.keep = spark, path.rstrip("/"), size, keep
        times = {"window_start", "window_end"}
        bar = T.StructType([T.StructField(c, T.TimestampType() if c in times else T.DoubleType()) for c in ("window_start", *VALUES)])
        self.schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("bars", T.ArrayType(bar))])

    def _versions(self) -> list[tuple[int, str]]:
        """(number, run) of the finished versions."""
        found = []
        for name in folders.children(self.spark, self.path):
            for run in folders.children(self.spark, f"{self.path}/{name}"):
                if folders.exists(self.spark, f"{self.path}/{name}/{run}/_SUCCESS"):
                    found.append((int(name.removeprefix("v")), run))
        return sorted(found)

    def _read(self, number: int, run: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{number:012d}/{run}")

    def before(self, run: str) -> DataFrame:
        """(symbol, bars) as ``run`` finds them."""
        earlier = [v for v in self._versions() if v[1] != run]
        mine = [n for n, r in self._versions() if r == run]
        earlier = [v for v in earlier if not mine or v[0] < mine[0]]
        return self._read(*earlier[-1]) if earlier else self.spark.createDataFrame([], self.schema)

    def now(self) -> DataFrame:
        versions = self._versions()
        return self._read(*versions[-1]) if versions else self.spark.createDataFrame([], self.schema)

    def around(self, batch: DataFrame, run: str) -> DataFrame:
        """The batch's bars with the bars of the ring before them, for symbols of the batch, as doubles. A bar
        older than a full ring has lost its neighbours and is left out."""
        new = batch.select("symbol", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema["bars"].dataType.elementType.fields])
        known = self.before(run)
        held = known.join(new.select("symbol").distinct(), "symbol", "left_semi").select("symbol", F.inline("bars"))
        keys = ["symbol", "window_start"]
        if self.keep == "last":
            held = held.join(new.select(*keys), keys, "left_anti")
        else:
            new = new.join(held.select(*keys), keys, "left_anti")
        oldest = known.select("symbol", F.when(F.size("bars") >= self.size, F.col("bars")[0]["window_start"]).alias("_oldest"))
        new = new.join(oldest, "symbol", "left").where("_oldest IS NULL OR window_start >= _oldest").drop("_oldest")
        return held.unionByName(new)

    def merge(self, batch: DataFrame, run: str) -> None:
        """Write the version that follows ``run``."""
        versions = self._versions()
        mine = [n for n, r in versions if r == run]
        number = mine[0] if mine else (versions[-1][0] + 1 if versions else 0)
        bar = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema["bars"].dataType.elementType.fields])
        fresh = newest_per_key(batch.select("symbol", "window_start", *VALUES), "symbol", "window_start", self.size)
        fresh = fresh.groupBy("symbol").agg(F.collect_list(bar).alias("_new"))
        old, new = (F.coalesce(c, F.array().cast(self.schema["bars"].dataType)) for c in ("bars", "_new"))
        winner, other = (new, old) if self.keep == "last" else (old, new)
        starts = F.transform(winner, lambda b: b["window_start"])
        both = F.array_sort(F.concat(winner, F.filter(other, lambda b: ~F.array_contains(starts, b["window_start"]))))
        last = F.when(F.size(both) > self.size, F.slice(both, -self.size, self.size)).otherwise(both)
        merged = self.before(run).join(fresh, "symbol", "full_outer").select("symbol", last.alias("bars"))
        merged.write.mode("overwrite").parquet(f"{self.path}/v{number:012d}/{run}")
        for name in folders.children(self.spark, self.path):
            if int(name.removeprefix("v")) < number - 1:
                folders.delete(self.spark, f"{self.path}/{name}")

    def seed(self, bars: DataFrame) -> None:
        """Start from a table of bars, once."""
        if self._versions():
            raise ValueError("the ring has bars already")
        self.merge(bars, "seed")
