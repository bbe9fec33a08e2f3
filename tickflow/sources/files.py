"""Post and table readers: Parquet, CSV, JDBC, external tables, SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def raw_posts(spark: SparkSession, path: str) -> DataFrame:
    """The posts of a lake laid out as ``year/month/day/slot``; these are columns, and a filter on
    them opens only the folders it names. An empty lake is an error."""
    posts = spark.read.parquet(path)
    if posts.isEmpty():
        raise ValueError(f"no posts under {path}")
    return posts


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Make existing files queryable by name; nothing is copied."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def harvested_csv(spark: SparkSession, path: str, keyword: str, latest_only: bool = True, in_folders: bool = False) -> DataFrame:
    """Posts of the newest CSV file under ``path``, tagged with the keyword they were searched by.

    With ``in_folders`` a harvest is a folder of CSV files, and all files beside the newest one count. A file with line breaks in its
    values cannot be split and is one task, so large harvests belong in several files.
    """
    if latest_only:      # from the listing alone; the other files are not opened
        listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path", "modificationTime")
        path = listing.orderBy(F.desc("modificationTime"), F.desc("path")).first()["path"]
        path = path.rsplit("/", 1)[0] if in_folders else path
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    rows = (rows.option("pathGlobFilter", "*.csv") if latest_only and in_folders else rows).csv(path)
    return rows.withColumn("keyword", F.lit(keyword))


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower=None, upper=None, partitions: int | None = None, **options: str) -> DataFrame:
    """A database table. With a partition column it is read by many tasks."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                                numPartitions=str(partitions))
    return reader.load()


def sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL over tables of any catalog and the given frames, by name."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)
