"""Catalog listings, glossary look-ups and column lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.rowindex import row_index


def tables(spark: SparkSession) -> DataFrame:
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "table_name string, table_type string, temporary boolean")


def columns(spark: SparkSession, table: str) -> DataFrame:
    rows = [(table, i, c.name, c.dataType, c.nullable, c.description)
            for i, c in enumerate(spark.catalog.listColumns(table), 1)]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, nullable boolean, comment string")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_or_empty(spark: SparkSession, name: str, schema) -> DataFrame:
    """The table, or no rows of its schema while nothing has created it yet."""
    return spark.table(name) if table_exists(spark, name) else spark.createDataFrame([], schema)


def lookup(df: DataFrame, order: Sequence[str], **equals) -> DataFrame:
    """Rows of a metadata or glossary table with the given values, sorted."""
    for name, value in equals.items():
        df = df.where(F.col(name) == value)
    return df.orderBy(*order)


def upstream(edges: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """Edges that lead into a table (one hop)."""
    hit = edges.where(F.col("target_table") == table)
    return hit if column is None else hit.where(F.col("target_column") == column)


def downstream(edges: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """Edges that leave a table (one hop)."""
    hit = edges.where(F.col("source_table") == table)
    return hit if column is None else hit.where(F.col("source_column") == column)


def _ends(edges: DataFrame) -> DataFrame:
    name = lambda side: F.concat_ws(".", f"{side}_table", f"{side}_column")
    return edges.select(name("source").alias("source"), name("target").alias("target")).distinct()


def lineage_nodes(*edge_sets: DataFrame) -> DataFrame:
    """Sorted distinct ends of all edges with dense ids from 0."""
    ends = _all(edge_sets)
    names = ends.select(F.explode(F.array("source", "target")).alias("node")).distinct()
    return row_index(names, ["node"], "node_id")


def lineage_graph(*edge_sets: DataFrame) -> DataFrame:
    """Edges as pairs of node ids."""
    nodes = lineage_nodes(*edge_sets)
    ends = _all(edge_sets)
    source = nodes.select(F.col("node").alias("source"), F.col("node_id").alias("source_id"))
    target = nodes.select(F.col("node").alias("target"), F.col("node_id").alias("target_id"))
    return ends.join(source, "source").join(target, "target")


def _all(edge_sets: Sequence[DataFrame]) -> DataFrame:
    out = _ends(edge_sets[0])
    for more in edge_sets[1:]:
        out = out.unionByName(_ends(more))
    return out.distinct()
