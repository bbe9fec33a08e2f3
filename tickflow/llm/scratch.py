"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickflow.session import shared_dir


class Scratch:
    """Writes DataFrames to a folder of its own under ``spark.checkpoint.dir`` and reads them back.

    A written table cuts the lineage, fixes what is computed once and used twice, and is still
    there when an executor is lost. :meth:`drop` removes a table no later step reads; tables
    behind a returned DataFrame stay, for it reads them when it runs.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path
        # Spark removes the shuffle files of a finished step when the driver's JVM finds its plan unused
        self.spark._jvm.System.gc()
        return kept

    def drop(self, df: DataFrame) -> None:
        """Remove a table returned by :meth:`keep`."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
