"""Change audit by comparing two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """One row per inserted, updated or deleted key.

    As with an after-row trigger, ``old_data`` is kept for DELETE only and
    ``new_data`` for INSERT and UPDATE. Rows are compared by content, columns by
    name: the new snapshot is put in the old one's order, and other columns are an error.
    """
    keys = list(keys)
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns of one snapshot only: {sorted(set(old.columns) ^ set(new.columns))}")
    new = new.select(*old.columns)
    pack = lambda df, name: df.select(*keys, F.struct(*df.columns).alias(name))
    both = pack(old, "_old").join(pack(new, "_new"), keys, "full_outer")
    before, after = F.col("_old"), F.col("_new")
    operation = (F.when(before.isNull(), "INSERT").when(after.isNull(), "DELETE")
                 .when(~before.eqNullSafe(after), "UPDATE"))
    return (both.withColumn("operation", operation).where("operation IS NOT NULL")
            .select(F.lit(table).alias("table_name"), *keys, "operation",
                    F.when(F.col("operation") == "DELETE", F.to_json(before)).alias("old_data"),
                    F.when(F.col("operation") != "DELETE", F.to_json(after)).alias("new_data")))
