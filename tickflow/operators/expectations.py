"""Expectation suites, evaluated in one pass over a table."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..functions.scalar import one_row

NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
PAIR = "expect_column_pair_values_A_to_be_greater_than_B"
UNIQUE = "expect_compound_columns_to_be_unique"
ROW_COUNT = "expect_table_row_count_to_be_between"


def _expect(kind: str, severity: str, **kwargs) -> dict:
    return {"expectation_type": kind, "kwargs": kwargs, "meta": {"severity": severity}}


# The rules the three tables are held to.
def bar_suite(keys: tuple[str, ...] = ("window_start",)) -> list[dict]:
    c, w = "critical", "warning"
    return [
        _expect(NOT_NULL, c, column="window_start", mostly=1.0),
        _expect(NOT_NULL, c, column="open", mostly=1.0),
        _expect(NOT_NULL, c, column="high", mostly=1.0),
        _expect(NOT_NULL, c, column="low", mostly=1.0),
        _expect(NOT_NULL, c, column="close", mostly=1.0),
        _expect(BETWEEN, c, column="open", min_value=0, strict_min=True),
        _expect(BETWEEN, c, column="close", min_value=0, strict_min=True),
        _expect(BETWEEN, w, column="volume", min_value=0),
        _expect(BETWEEN, w, column="trade_count", min_value=1),
        _expect(BETWEEN, w, column="volatility", min_value=0),
        _expect(PAIR, c, column_A="high", column_B="low", or_equal=True),
        _expect(UNIQUE, c, column_list=list(keys)),
        _expect(ROW_COUNT, w, min_value=1),
    ]


def sentiment_suite() -> list[dict]:
    c, w = "critical", "warning"
    return [
        _expect(NOT_NULL, c, column="window_start", mostly=1.0),
        _expect(NOT_NULL, c, column="compound_score", mostly=1.0),
        _expect(BETWEEN, c, column="compound_score", min_value=-1.0, max_value=1.0),
        _expect(BETWEEN, w, column="positive_ratio", min_value=0.0, max_value=1.0),
        _expect(BETWEEN, w, column="negative_ratio", min_value=0.0, max_value=1.0),
        _expect(BETWEEN, w, column="neutral_ratio", min_value=0.0, max_value=1.0),
        _expect(BETWEEN, w, column="post_count", min_value=0),
        _expect(IN_SET, c, column="data_quality", value_set=["ok", "low_sample", "stale"]),
        _expect(NOT_NULL, c, column="data_quality", mostly=1.0),
        _expect(BETWEEN, w, column="weighted_compound", min_value=-1.0, max_value=1.0),
        _expect(UNIQUE, c, column_list=["window_start"]),
        _expect(ROW_COUNT, w, min_value=1),
    ]


def prediction_suite(keys: tuple[str, ...] = ("window_start",)) -> list[dict]:
    c, w = "critical", "warning"
    return [
        _expect(NOT_NULL, c, column="window_start", mostly=1.0),
        _expect(NOT_NULL, c, column="predicted_vol", mostly=1.0),
        _expect(BETWEEN, c, column="predicted_vol", min_value=0.0),
        _expect(NOT_NULL, w, column="model_version", mostly=1.0),
        _expect(BETWEEN, w, column="inference_latency_ms", min_value=0),
        _expect(BETWEEN, w, column="rolling_vol", min_value=0.0),
        _expect(UNIQUE, c, column_list=list(keys)),
        _expect(ROW_COUNT, w, min_value=1),
    ]


def load_suite(text: str) -> list[dict]:
    """Expectations of a suite kept as JSON."""
    return json.loads(text)["expectations"]


def _row_test(kind: str, kw: dict) -> tuple[Column, Column]:
    """(row is considered, row breaks the rule)."""
    if kind == PAIR:
        a, b = F.col(kw["column_A"]), F.col(kw["column_B"])
        holds = (a >= b) if kw.get("or_equal") else (a > b)
        seen = a.isNotNull() & b.isNotNull()
        return seen, seen & ~holds
    value = F.col(kw["column"])
    if kind == NOT_NULL:
        return F.lit(True), value.isNull()
    seen = value.isNotNull()
    if kind == IN_SET:
        return seen, seen & ~value.isin(*kw["value_set"])
    if kind == BETWEEN:
        holds = F.lit(True)
        if kw.get("min_value") is not None:
            low = F.lit(kw["min_value"])
            holds = holds & ((value > low) if kw.get("strict_min") else (value >= low))
        if kw.get("max_value") is not None:
            high = F.lit(kw["max_value"])
            holds = holds & ((value < high) if kw.get("strict_max") else (value <= high))
        return seen, seen & ~holds
    raise ValueError(f"unknown expectation {kind}")


def evaluate(df: DataFrame, suite: list[dict], table: str) -> DataFrame:
    """One row per expectation: considered rows, unexpected rows, success.

    All row rules and the row count are one aggregate; each uniqueness rule is a
    further count per key. ``mostly`` counts only where ``kwargs`` has it: it is
    the share of considered rows that must hold. NULLs are not considered except
    by the not-null rule; a table without rows passes all but the row count.
    """
    aggs, unique = [F.count(F.lit(1)).alias("rows")], {}
    for i, e in enumerate(suite):
        kind, kw = e["expectation_type"], e["kwargs"]
        if kind == UNIQUE:
            unique[i] = kw["column_list"]
        elif kind != ROW_COUNT:
            seen, bad = _row_test(kind, kw)
            aggs += [F.count_if(seen).alias(f"seen_{i}"), F.count_if(bad).alias(f"bad_{i}")]
    totals = df.agg(*aggs)
    for i, cols in unique.items():
        sizes = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        repeated = one_row(sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("seen"),
                                     F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("bad")))
        totals = totals.withColumns({f"seen_{i}": repeated["seen"], f"bad_{i}": repeated["bad"]})

    rows = []
    for i, e in enumerate(suite):
        kind, kw = e["expectation_type"], e["kwargs"]
        if kind == ROW_COUNT:
            seen, n = F.col("rows"), F.col("rows")
            ok = F.lit(True)
            if kw.get("min_value") is not None:
                ok = ok & (n >= kw["min_value"])
            if kw.get("max_value") is not None:
                ok = ok & (n <= kw["max_value"])
            bad = F.when(ok, F.lit(0)).otherwise(n)
        else:
            seen, bad = F.col(f"seen_{i}"), F.col(f"bad_{i}")
            ok = (bad == 0) if kw.get("mostly") is None else \
                ((seen == 0) | ((seen - bad) >= seen * F.lit(float(kw["mostly"]))))
        target = ",".join(kw.get("column_list", [])) or kw.get("column") or \
            ",".join(kw[k] for k in ("column_A", "column_B") if k in kw)
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(i).alias("position"), F.lit(kind).alias("expectation"),
            F.lit(target).alias("target"), F.lit(e.get("meta", {}).get("severity")).alias("severity"),
            seen.cast("bigint").alias("considered"), bad.cast("bigint").alias("unexpected"), ok.alias("success")))
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def roll_up(results: DataFrame) -> DataFrame:
    """Passed and failed per table."""
    return results.groupBy("table_name").agg(
        F.count_if("success").alias("passed"), F.count_if(~F.col("success")).alias("failed"),
        F.every("success").alias("success"))


def totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if("success").alias("checks_passed"),
                       F.count_if(~F.col("success")).alias("checks_failed"))


def evaluate_all(tables: list[tuple[str, DataFrame, list[dict]]]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [evaluate(df, suite, name) for name, df, suite in tables])
