"""Profiling, rule splits and validation summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.column import Column

from ..functions.scalar import age_minutes, json_field

#: Fixed value: share of NULLs (percent) from which a column fails.
NULL_LIMIT_PCT = 10.0


def _value(df: DataFrame, name: str, numeric: bool) -> Column:
    """What counts as a value of a column: NaN is none, both zeros are one. Texts are
    known by their SHA-256; those declared numeric keep their wording, to be parsed."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c + F.lit(0.0).cast(kind))
    text = c.cast("string")
    return text if numeric or not isinstance(kind, T.StringType) else F.sha2(text, 256)


def profile(df: DataFrame, table: str, numeric: Sequence[str] | None = None,
            limit: float = NULL_LIMIT_PCT, distinct_rsd: float | None = None,
            checked_at: Column | None = None) -> DataFrame:
    """One row per column, also for an empty table: NULLs, distinct values, numbers that do not
    parse, min, max, mean.

    Reads every row once. The columns are turned into (column, value) pairs and
    counted per value in two steps, so the distinct count of all columns needs
    one shuffle, combined before it; no column lands in one task. With ``distinct_rsd``
    distinct values are estimated by a sketch of that deviation instead, and nothing but one row
    per task and column is shuffled. ``numeric`` names columns declared numeric (default: those
    typed so); ``checked_at`` adds a column of that name, for a history of profiles.
    """
    declared = set(numeric if numeric is not None else
                   [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    cells = F.array(*[F.struct(F.lit(i).alias("at"), _value(df, c, c in declared).alias("value"))
                      for i, c in enumerate(df.columns)])
    is_numeric = F.col("at").isin(*[i for i, c in enumerate(df.columns) if c in declared]) if declared else F.lit(False)
    values = df.select(F.explode(cells).alias("cell")).select("cell.*")
    if distinct_rsd is None:
        # the number behind a value is worked out once per distinct value, not per cell
        values = values.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"))
        distinct = F.count("value")
    else:
        values = values.withColumn("n", F.lit(1).cast("bigint"))
        distinct = F.approx_count_distinct("value", distinct_rsd)
    values = values.withColumns({"numeric": is_numeric, "number": F.when(is_numeric, F.col("value").try_cast("double"))})
    null = F.col("value").isNull()
    per_column = values.groupBy("at").agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(null, F.col("n"))).alias("null_count"), distinct.alias("distinct_count"),
        F.sum(F.when(F.col("numeric") & ~null & F.col("number").isNull(), F.col("n"))).alias("type_mismatch"),
        F.min("number").alias("min_value"), F.max("number").alias("max_value"),
        F.try_divide(F.sum(F.col("number") * F.col("n")),
                     F.sum(F.when(F.col("number").isNotNull(), F.col("n")))).alias("mean_value"))
    names = df.sparkSession.createDataFrame(list(enumerate(df.columns)), "at int, column_name string")
    counts = ["total_rows", "null_count", "distinct_count", "type_mismatch"]
    out = names.join(per_column, "at", "left").drop("at").fillna(0, counts)
    pct = F.coalesce(F.round(F.try_divide(F.col("null_count") * 100.0, F.col("total_rows")), 2), F.lit(0.0))
    out = (out.withColumn("null_percent", pct)
           .withColumn("quality_status", F.when(F.col("null_percent") < limit, "ok").otherwise("failed"))
           .withColumn("table_name", F.lit(table)))
    return out if checked_at is None else out.withColumn("checked_at", checked_at)


def profile_alerts(profiled: DataFrame, limit: float = NULL_LIMIT_PCT) -> DataFrame:
    """A message for every column at or over the limit."""
    return (profiled.where(F.col("null_percent") >= limit)
            .select("table_name", "column_name", "null_percent",
                    F.concat(F.format_string("%s.%s: null ", "table_name", "column_name"),
                             F.col("null_percent").cast("decimal(9,1)").cast("string"),
                             F.lit(f"% (threshold {limit}%)")).alias("message")))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row of each key, by an aggregate rather than a window, so a key with
    very many rows is reduced before the shuffle."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
            .select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]))


def daily_profile(df: DataFrame, table: str, time: str, lg_k: int = 12) -> DataFrame:
    """A row per column and day that adds up: counts, sum, extremes and a sketch of the distinct values.

    A sketch has up to 2**``lg_k`` bytes whatever the day holds, and its relative error is about 1.04 / 2**(``lg_k`` / 2).
    """
    columns = [f for f in df.schema.fields if f.name != time]
    rows = df.withColumn("day", F.to_date(time)).groupBy("day")
    parts = []
    for f in columns:
        number = F.col(f.name).cast("double") if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")
        parts += [F.count(f.name).alias(f"_n_{f.name}"), F.min(number).alias(f"_lo_{f.name}"), F.max(number).alias(f"_hi_{f.name}"),
                  F.sum(number).alias(f"_s_{f.name}"), F.hll_sketch_agg(F.col(f.name).cast("string"), lg_k).alias(f"_d_{f.name}")]
    one = rows.agg(F.count(F.lit(1)).alias("total_rows"), *parts)
    each = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"_n_{f.name}").alias("values"), F.col(f"_lo_{f.name}").alias("min_value"),
                              F.col(f"_hi_{f.name}").alias("max_value"), F.col(f"_s_{f.name}").alias("sum"), F.col(f"_d_{f.name}").alias("distinct"))
                     for f in columns])
    return one.select(F.lit(table).alias("table_name"), "day", "total_rows", F.inline(each))


def merge_profiles(stored: DataFrame) -> DataFrame:
    """The profile of all days of ``stored`` per table and column; narrow it to the days wanted before. No row of the tables is read again."""
    return stored.groupBy("table_name", "column_name").agg(
        F.sum("total_rows").alias("total_rows"), (F.sum("total_rows") - F.sum("values")).alias("null_count"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.try_divide(F.sum("sum"), F.sum(
            F.when(F.col("sum").isNotNull(), F.col("values")))).alias("mean_value"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_estimate"))


def summary(stats: DataFrame) -> DataFrame:
    """Per table, from the latest profile of each column: completeness, failures, type errors."""
    last = latest_per_key(stats, ["table_name", "column_name"], ["checked_at"])
    return last.groupBy("table_name").agg(
        F.round(F.avg(100.0 - F.coalesce("null_percent", F.lit(0.0))), 1).alias("completeness_pct"),
        F.count(F.lit(1)).alias("columns_checked"), F.max("checked_at").alias("last_checked"),
        F.count_if(F.col("quality_status") != "ok").alias("failed_columns"),
        F.sum(F.coalesce("type_mismatch", F.lit(0))).alias("total_type_errors"))


def null_heatmap(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest NULL percent as a table x column grid; ``columns`` fixes the grid's width."""
    last = latest_per_key(stats, ["table_name", "column_name"], ["checked_at"])
    return last.groupBy("table_name").pivot("column_name", list(columns)).agg(F.first("null_percent"))


def split_by_rules(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with a ``reasons`` array). A NULL condition passes, as in a CHECK."""
    tagged = with_reasons(df, rules)
    return (tagged.where(F.size("reasons") == 0).drop("reasons"), tagged.where(F.size("reasons") > 0))


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    broken = [F.when(~cond, F.lit(name)) for name, cond in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of: Column) -> DataFrame:
    """Latest timestamp and age in minutes per table; an empty table keeps its row."""
    rows = [df.agg(F.max(ts).alias("last_data_at")).select(F.lit(name).alias("table_name"), "last_data_at")
            for name, (df, ts) in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b), rows)
    return stacked.withColumn("age_minutes", age_minutes("last_data_at", as_of))


def validation_history(runs: DataFrame, pipeline: str, fields: Iterable[str], limit: int = 50) -> DataFrame:
    """Latest validation runs with counters read from their JSON; an absent key is NULL."""
    return (runs.where(F.col("pipeline_name") == pipeline)
            .select("run_id", "started_at", "quality_status", *[json_field("params", f).alias(f) for f in fields])
            .orderBy(F.desc("started_at"), "run_id").limit(limit))
