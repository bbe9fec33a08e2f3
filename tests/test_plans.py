"""Plans stay the ones that scale."""

import re

import pytest
from pyspark.sql import functions as F

from checks import market, operations, social, tables as t
from conftest import SF
from tickflow.functions.scalar import latest_instant
from tickflow.operators import ops


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


JOINS = [market.interval_join_slot, market.slot_join, market.realized_vol, market.feature_view, market.sentiment_asof,
         market.hist30, social.posts_per_minute_join, social.stale_carry, operations.audit_diff, operations.expectation_rows,
         operations.log_summary, operations.alert_sustained, operations.status_with_memory]


@pytest.mark.parametrize("query", JOINS, ids=lambda q: q.__name__)
def test_no_nested_loops_or_cartesian_products(spark, query):
    text = plan(query(spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("query", [market.rolling_vol, market.returns, market.bars_ohlcv, market.realized_vol, market.gaps],
                         ids=["rolling_vol", "returns", "bars_ohlcv", "realized_vol", "gaps"])
def test_windows_are_split_by_time(spark, query):
    """No row-level window runs in one task or over a symbol's whole history."""
    text = plan(query(spark, SF))
    assert "SinglePartition" not in text
    for spec in re.findall(r"windowspecdefinition\((\w+)#\d+, (\w+)#", text):
        # the only windows along a whole symbol are those over one row per chunk
        assert spec[1] in ("_chunk", "window_start"), spec
    sorts = re.findall(r"Window \[(?:lag|stddev_samp|avg)\([^\]]*windowspecdefinition\(symbol#\d+, (\w+)#", text)
    assert sorts and set(sorts) <= {"_chunk", "window_start"}


def test_filters_and_columns_reach_the_scan(spark):
    ev = t.events(spark, SF)
    text = plan(ops.recent(ev, "ts", latest_instant(ev, "ts"), "24 HOURS").groupBy("event_type").count())
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_no_python_in_the_plans(spark):
    for query in (market.bars_ohlcv, market.feature_view, social.post_sentiment, market.tick_parse, operations.column_profile):
        assert "Python" not in plan(query(spark, SF))


def test_profile_and_rules_scan_once(spark):
    assert plan(operations.column_profile(spark, SF)).count("FileScan") == 2           # customer and orders, once each
    text = plan(market.hourly_rollup(spark, SF))
    assert text.count("FileScan") == 1


def test_only_chunk_summaries_meet_in_one_task(spark):
    """A series without keys: the one task sees a row per chunk."""
    df = spark.range(100).select(F.timestamp_seconds(F.col("id") * 60).alias("t"), F.col("id").alias("v"))
    from tickflow.operators.rolling import forward_fill
    text = plan(forward_fill(df, ["v"], "t", "10 minutes"))
    lines = text.splitlines()
    at = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    below = next(line for line in lines[at[0] + 1:] if "Aggregate" in line)
    assert len(at) == 1 and "=[_chunk" in below


def test_bars_are_hash_aggregates_over_one_scan(spark):
    from checks import tables as t
    for df in (t.bars(spark, SF), __import__("tickflow.operators.bars", fromlist=["ohlcv"]).ohlcv(t.ticks(spark, SF))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and plan.count("FileScan") == 1
