"""Write policies, data quality, alerts, logs, runs, catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tickflow.functions import scalar as fs
from tickflow.operators import alerts, audit, catalog, expectations, ops, quality, stats
from tickflow.session import cut_lineage, shared_dir
from tickflow.sinks import policies, tables as sinks
from tickflow.sources import files

from . import tables as t
from .registry import query, rnd, rounded

# ---- write policies ----------------------------------------------------------------------

@query("insert_absent", "bars", "SELECT symbol, window_start, close FROM bars WHERE hour(window_start) <> 0")
def insert_absent(spark, sf):
    b = t.bars(spark, sf)
    return policies.absent(b, b.where("hour(window_start) = 0"), ["symbol", "window_start"]).select(
        "symbol", "window_start", "close")


@query("insert_counts", "bars", """
    SELECT CAST(sum(CASE WHEN hour(window_start) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_written,
           CAST(sum(CASE WHEN hour(window_start) = 0 THEN 1 ELSE 0 END) + count(*) AS BIGINT) AS rows_rejected FROM bars""")
def insert_counts(spark, sf):
    """Every bar offered twice; the midnight ones are there already."""
    b = t.bars(spark, sf)
    return policies.insert_counts(b.unionByName(b), b.where("hour(window_start) = 0"), ["symbol", "window_start"])


@query("upsert_latest", "predictions", """
    SELECT symbol, window_start, round(CASE WHEN hour(window_start) IN (6, 12) THEN predicted_vol + 1 ELSE predicted_vol END, 6)
           AS predicted_vol, round(CASE WHEN hour(window_start) = 12 THEN rolling_vol + 5 ELSE rolling_vol END, 6)
           AS rolling_vol, CASE WHEN hour(window_start) IN (6, 12) THEN 'v9' ELSE model_version END AS model_version
    FROM predictions""")
def upsert_latest(spark, sf):
    """Target lacks noon; the batch brings 6 and 12 o'clock, and only two columns update."""
    p = t.predictions(spark, sf)
    batch = p.where("hour(window_start) IN (6, 12)").withColumns({
        "predicted_vol": F.col("predicted_vol") + 1, "rolling_vol": F.col("rolling_vol") + 5,
        "model_version": F.lit("v9")})
    out = policies.upsert(p.where("hour(window_start) <> 12"), batch, ["symbol", "window_start"],
                          update=["predicted_vol", "model_version"])
    return rounded(out.drop("inference_latency_ms"), "predicted_vol", "rolling_vol")


@query("stored_bars", "bars", f"""
    SELECT symbol, window_start, window_end, {rnd('open', 'close', 'volume', 'volatility')},
           CAST(trade_count AS INTEGER) AS trade_count FROM bars""")
def stored_bars(spark, sf):
    """Bars stored under both policies, one batch replayed, and the table read back."""
    table = sinks.Table(spark, f"{shared_dir(spark)}/bars-{uuid.uuid4().hex}", t.BAR_SCHEMA, ["symbol", "window_start"])
    b = cut_lineage(t.bars(spark, sf))
    early = b.where("day(window_start) <= 20")
    table.insert_absent(early)
    table.insert_absent(early.withColumn("close", F.col("close") + 1))       # all rejected
    table.upsert(b.where("day(window_start) >= 15"))                         # overlaps, then new days
    table.upsert(b.where("day(window_start) >= 15"))
    out = table.read().withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    out = out.withColumns({c: F.col(c).cast("double") for c in ("open", "close", "volume", "volatility")})
    return rounded(out.drop("high", "low"), "open", "close", "volume", "volatility")


@query("prediction_payload", "predictions", """
    SELECT '{"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S') || '","predicted_vol":'
           || CAST(CAST(predicted_vol AS DECIMAL(18, 4)) AS VARCHAR) || ',"model_version":"' || model_version || '"}' AS value
    FROM predictions""")
def prediction_payload(spark, sf):
    p = t.predictions(spark, sf).withColumn("predicted_vol", F.col("predicted_vol").cast("decimal(18,4)"))
    return sinks.topic_messages(p)


@query("retention", "logs", """
    SELECT log_id, timestamp FROM logs WHERE timestamp >= (SELECT max(timestamp) FROM logs) - INTERVAL 10 DAY""")
def retention(spark, sf):
    logs = t.app_logs(spark, sf)
    return policies.retain(logs, "timestamp", fs.latest_instant(logs, "timestamp"), "10 DAYS").select("log_id", "timestamp")


@query("mark_failed", "runs", """
    SELECT run_id, CASE WHEN run_id % 100 = 3 THEN 'failed' ELSE quality_status END AS quality_status,
           CASE WHEN run_id % 100 = 3 THEN (SELECT max(started_at) FROM runs) ELSE finished_at END AS finished_at
    FROM runs""")
def mark_failed(spark, sf):
    r = t.runs(spark, sf)
    out = policies.mark_failed(r, r.where("run_id % 100 = 3"), fs.latest_instant(r, "started_at"))
    return out.select("run_id", "quality_status", "finished_at")


# ---- data quality ------------------------------------------------------------------------

SPARSE = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "o_orderkey", "o_orderstatus",
          "o_totalprice", "o_orderdate", "o_orderpriority"]
NUMERIC = {"c_custkey", "c_nationkey", "c_acctbal", "o_orderkey", "o_totalprice"}
PROFILE_SQL = " UNION ALL ".join(
    f"SELECT 'sparse_orders' AS table_name, '{c}' AS column_name, count(*) AS total_rows, "
    f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, CAST(0 AS BIGINT) AS type_mismatch, "
    + (f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, round(avg({c}), 4) AS mean_value, "
       if c in NUMERIC else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, "
                            "CAST(NULL AS DOUBLE) AS mean_value, ")
    + f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_percent, "
      f"CASE WHEN round((count(*) - count({c})) * 100.0 / count(*), 2) < 10 THEN 'ok' ELSE 'failed' END AS quality_status "
      f"FROM sparse" for c in SPARSE)


@query("column_profile", "sparse", PROFILE_SQL)
def column_profile(spark, sf):
    return rounded(quality.profile(t.sparse_orders(spark, sf), "sparse_orders"), "mean_value", digits=4)


@query("profile_alerts", "sparse", f"""
    SELECT table_name, column_name, null_percent, table_name || '.' || column_name || ': null '
           || CAST(CAST(null_percent AS DECIMAL(9, 1)) AS VARCHAR) || '% (threshold 10.0%)' AS message
    FROM ({PROFILE_SQL}) WHERE null_percent >= 10""")
def profile_alerts(spark, sf):
    return quality.profile_alerts(quality.profile(t.sparse_orders(spark, sf), "sparse_orders"))


def _stats(spark, sf):
    """An older and a newer profile of the same table, and one of another."""
    at = lambda df, day: df.withColumn("checked_at", F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz"))
    sparse = quality.profile(t.sparse_orders(spark, sf), "sparse_orders")
    older = sparse.withColumn("null_percent", F.lit(0.0)).withColumn("quality_status", F.lit("ok"))
    whole = quality.profile(t.table(spark, sf, "customer"), "customer", numeric=["c_name", "c_acctbal"])
    return at(older, 1).unionByName(at(sparse, 2)).unionByName(at(whole, 3))


@query("dq_summary", "sparse", f"""
    SELECT table_name, round(avg(100.0 - null_percent), 1) AS completeness_pct, count(*) AS columns_checked,
           TIMESTAMP '2024-01-02' AS last_checked,
           count(*) FILTER (WHERE quality_status <> 'ok') AS failed_columns, CAST(0 AS BIGINT) AS total_type_errors
    FROM ({PROFILE_SQL}) GROUP BY table_name UNION ALL
    SELECT 'customer', 100.0, 5, TIMESTAMP '2024-01-03', 0, (SELECT count(*) FROM customer)""")
def dq_summary(spark, sf):
    return quality.summary(_stats(spark, sf))


@query("heatmap", "sparse", f"""
    SELECT 'sparse_orders' AS table_name, CAST(0 AS DOUBLE) AS c_custkey, CAST(0 AS DOUBLE) AS c_name,
           max(null_percent) FILTER (WHERE column_name = 'o_orderkey') AS o_orderkey,
           max(null_percent) FILTER (WHERE column_name = 'o_totalprice') AS o_totalprice FROM ({PROFILE_SQL})
    UNION ALL SELECT 'customer', 0.0, 0.0, NULL, NULL""")
def heatmap(spark, sf):
    return quality.null_heatmap(_stats(spark, sf), ["c_custkey", "c_name", "o_orderkey", "o_totalprice"])


def _suites(spark, sf):
    """Validation reads stored tables: these are written first."""
    keys = ("symbol", "window_start")
    odd = cut_lineage(t.bars(spark, sf)).withColumns({
        "open": F.col("open") - 20, "volume": F.when(F.col("trade_count") % 5 != 0, F.col("volume") - 500)})
    s = cut_lineage(t.all_slots(spark, sf))
    p = cut_lineage(t.predictions(spark, sf))
    return [("bars", odd, expectations.bar_suite(keys)), ("sentiment", s.unionByName(s.where("day(window_start) = 1")),
                                                        expectations.sentiment_suite()),
            ("predictions", p, expectations.prediction_suite(keys))]


def _not_null(table, src, cols):
    return [f"SELECT '{table}' AS table_name, 'not_null:{c}' AS rule, count(*) AS considered, "
            f"count(*) - count({c}) AS unexpected FROM {src}" for c in cols]


def _where(table, src, rule, col, bad):
    return [f"SELECT '{table}' AS table_name, '{rule}:{col}' AS rule, count({col}) AS considered, "
            f"count(CASE WHEN {bad} THEN 1 END) AS unexpected FROM {src}"]


def _unique(table, src, cols):
    return [f"SELECT '{table}' AS table_name, 'unique:{cols}' AS rule, CAST(sum(n) AS BIGINT) AS considered, "
            f"CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS unexpected "
            f"FROM (SELECT count(*) AS n FROM {src} GROUP BY {cols})"]


def _rows(table, src):
    return [f"SELECT '{table}' AS table_name, 'rows:' AS rule, count(*) AS considered, "
            f"CASE WHEN count(*) >= 1 THEN 0 ELSE count(*) END AS unexpected FROM {src}"]


ODD = "(SELECT * REPLACE (open - 20 AS open, CASE WHEN trade_count % 5 <> 0 THEN volume - 500 END AS volume) FROM bars)"
TWICE = "(SELECT * FROM all_slots UNION ALL SELECT * FROM all_slots WHERE day(window_start) = 1)"
RULES_SQL = " UNION ALL ".join(
    _not_null("bars", ODD, ["window_start", "open", "high", "low", "close"])
    + _where("bars", ODD, "between", "open", "open <= 0") + _where("bars", ODD, "between", "close", "close <= 0")
    + _where("bars", ODD, "between", "volume", "volume < 0")
    + _where("bars", ODD, "between", "trade_count", "trade_count < 1")
    + _where("bars", ODD, "between", "volatility", "volatility < 0")
    + _where("bars", ODD, "pair", "high", "high < low")
    + _unique("bars", ODD, "symbol,window_start") + _rows("bars", ODD)
    + _not_null("sentiment", TWICE, ["window_start", "compound_score", "data_quality"])
    + [x for c, lo in [("compound_score", -1), ("positive_ratio", 0), ("negative_ratio", 0), ("neutral_ratio", 0),
                       ("weighted_compound", -1)]
       for x in _where("sentiment", TWICE, "between", c, f"{c} < {lo} OR {c} > 1")]
    + _where("sentiment", TWICE, "between", "post_count", "post_count < 0")
    + _where("sentiment", TWICE, "in_set", "data_quality", "data_quality NOT IN ('ok', 'low_sample', 'stale')")
    + _unique("sentiment", TWICE, "window_start") + _rows("sentiment", TWICE)
    + _not_null("predictions", "predictions", ["window_start", "predicted_vol", "model_version"])
    + [x for c in ("predicted_vol", "inference_latency_ms", "rolling_vol")
       for x in _where("predictions", "predictions", "between", c, f"{c} < 0")]
    + _unique("predictions", "predictions", "symbol,window_start") + _rows("predictions", "predictions"))


@query("expectations", "bars all_slots predictions", f"SELECT *, unexpected = 0 AS success FROM ({RULES_SQL})")
def expectation_rows(spark, sf):
    out = expectations.evaluate_all(_suites(spark, sf))
    short = {expectations.NOT_NULL: "not_null", expectations.BETWEEN: "between", expectations.IN_SET: "in_set",
             expectations.PAIR: "pair", expectations.UNIQUE: "unique", expectations.ROW_COUNT: "rows"}
    name = F.create_map(*[F.lit(x) for kv in short.items() for x in kv])
    target = F.when(F.col("expectation") == expectations.PAIR, F.split_part("target", F.lit(","), F.lit(1))) \
        .otherwise(F.col("target"))
    return out.select("table_name", F.concat(name[F.col("expectation")], F.lit(":"), target).alias("rule"),
                      "considered", "unexpected", "success")


@query("expectation_rollup", "bars all_slots predictions", f"""
    SELECT table_name, count(CASE WHEN unexpected = 0 THEN 1 END) AS passed,
           count(CASE WHEN unexpected > 0 THEN 1 END) AS failed, bool_and(unexpected = 0) AS success
    FROM ({RULES_SQL}) GROUP BY table_name""")
def expectation_rollup(spark, sf):
    return expectations.roll_up(expectations.evaluate_all(_suites(spark, sf)))


@query("expectation_totals", "bars all_slots predictions", f"""
    SELECT count(CASE WHEN unexpected = 0 THEN 1 END) AS checks_passed,
           count(CASE WHEN unexpected > 0 THEN 1 END) AS checks_failed FROM ({RULES_SQL})""")
def expectation_totals(spark, sf):
    return expectations.totals(expectations.evaluate_all(_suites(spark, sf)))


@query("audit_diff", "audit_old audit_new", """
    SELECT 'orders' AS table_name, coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
           CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation,
           CASE WHEN n.o_orderkey IS NULL THEN '{"o_orderkey":' || o.o_orderkey || ',"o_orderstatus":"' || o.o_orderstatus
                || '","o_totalprice":' || o.o_totalprice || '}' END AS old_data,
           CASE WHEN n.o_orderkey IS NOT NULL THEN '{"o_orderkey":' || n.o_orderkey || ',"o_orderstatus":"'
                || n.o_orderstatus || '","o_totalprice":' || n.o_totalprice || '}' END AS new_data
    FROM audit_old o FULL JOIN audit_new n ON o.o_orderkey = n.o_orderkey
    WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_totalprice <> n.o_totalprice
          OR o.o_orderstatus <> n.o_orderstatus""")
def audit_diff(spark, sf):
    return audit.audit_diff(t.audit_old(spark, sf), t.audit_new(spark, sf), ["o_orderkey"], "orders")


@query("audit_counts", "audit_old audit_new", """
    SELECT operation, count(*) AS count FROM (
        SELECT CASE WHEN o.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation
        FROM audit_old o FULL JOIN audit_new n ON o.o_orderkey = n.o_orderkey
        WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_totalprice <> n.o_totalprice) GROUP BY 1""")
def audit_counts(spark, sf):
    return ops.value_counts(audit.audit_diff(t.audit_old(spark, sf), t.audit_new(spark, sf), ["o_orderkey"], "orders"),
                            "operation")


# ---- alerts ------------------------------------------------------------------------------

HOURLY = alerts.scaled(alerts.RULES, 60)     # the test events are minutes apart


def _metric_tables(spark, sf):
    m = t.container_metrics(spark, sf)
    used = F.col("usage_percent")
    return {
        "predictions": t.predictions(spark, sf).select("symbol", "window_start", "predicted_vol"),
        "sentiment": t.all_slots(spark, sf).withColumn("created_at", F.col("window_start")),
        "bars": t.bars(spark, sf),
        "mem": m.select("time", used.alias("used_percent")),
        "disk": m.select("time", used.alias("used_percent"),
                         F.concat(F.lit("/var/lib/"), F.when(F.col("metric_id") % 3 == 0, "docker/x").otherwise("data"))
                         .alias("path")),
        "cpu": m.select("time", (100 - used).alias("usage_idle")),
        "container_status": m,
    }


# (rule, source, time, value of a row (NULL = not counted), measure, look-back hours, condition, state without data, severity)
ALERT_SQL = [
    ("no_new_predictions", "predictions", "window_start", "1", "count", 15, "= 0", "Alerting", "warning"),
    ("high_volatility", "predictions", "window_start", "predicted_vol", "avg", 60, "> 0.1", "NoData", "critical"),
    ("pipeline_stale", "all_slots", "window_start", "1", "count", 120, "= 0", "Alerting", "warning"),
    ("data_gap", "bars", "window_start", "1", "count", 5, "= 0", "Alerting", "critical"),
    ("host_disk_high", "containers", "time", "CASE WHEN metric_id % 3 <> 0 THEN usage_percent END", "max", 5, "> 90",
     "NoData", "critical"),
    ("host_cpu_high", "containers", "time", "usage_percent", "avg", 5, "> 90", "NoData", "warning"),
    ("container_metrics_stale", "containers", "time", "1", "count", 2, "= 0", "Alerting", "critical"),
    ("container_failed", "containers", "time", "CASE WHEN status = 'exited' THEN 1 END", "count", 5, "> 0", "NoData",
     "warning"),
]
NOW = "(SELECT max(ts) FROM events)"


def _alert_now(rule, src, ts, value, measure, hours, cond, no_data, severity):
    return (f"SELECT '{rule}' AS rule_id, '{severity}' AS severity, CAST({measure}({value}) AS DOUBLE) AS value, "
            f"'{cond}' AS c, '{no_data}' AS no_data, CAST({measure}({value}) AS DOUBLE) {cond} AS hit FROM {src} "
            f"WHERE {ts} > {NOW} - INTERVAL {hours} HOUR AND {ts} <= {NOW}")


@query("alert_rules", "predictions all_slots containers", f"""
    SELECT rule_id, severity, round(value, 6) AS value, coalesce(hit, no_data = 'Alerting') AS breach,
           CASE WHEN value IS NULL THEN no_data WHEN hit THEN 'Alerting' ELSE 'Normal' END AS state
    FROM ({' UNION ALL '.join(_alert_now(*a) for a in ALERT_SQL)} UNION ALL
          SELECT 'host_memory_high', 'critical', arg_max(usage_percent, time), '', 'NoData',
                 arg_max(usage_percent, time) > 85 FROM containers)""")
def alert_rules(spark, sf):
    as_of = fs.latest_instant(t.events(spark, sf), "ts")
    return rounded(alerts.evaluate_at(_metric_tables(spark, sf), HOURLY, as_of), "value")


def _alert_series(rule, src, ts, value, measure, hours, cond, no_data, severity):
    hold = {r.rule_id: r.hold for r in HOURLY}[rule]
    back = -(-hold // 60)
    filled = {"count": "coalesce(CAST(count(v) AS DOUBLE), 0)", "last": "max(v)[2]"}.get(measure, f"{measure}(v)")
    since = "" if measure == "last" else f"x.at > instant - INTERVAL {hours} HOUR AND"
    return f"""
    SELECT rule_id, severity, instant, value, breach,
           CASE WHEN NOT breach THEN 'Normal'
                WHEN bool_and(breach) OVER f AND count(*) OVER f = {back + 1} THEN 'Firing' ELSE 'Pending' END AS state
    FROM (SELECT '{rule}' AS rule_id, '{severity}' AS severity, instant, round({filled}, 9) AS value,
                 coalesce({filled} {cond}, '{no_data}' = 'Alerting') AS breach
          FROM (SELECT unnest(generate_series(
                    (SELECT min(time_bucket(INTERVAL '1 hour', {ts} - INTERVAL 1 MICROSECOND)) FROM {src}) + INTERVAL 1 HOUR,
                    (SELECT max(time_bucket(INTERVAL '1 hour', {ts} - INTERVAL 1 MICROSECOND)) FROM {src}) + INTERVAL 1 HOUR,
                    INTERVAL 1 HOUR)) AS instant) g
          LEFT JOIN (SELECT {ts} AS at, {value} AS v FROM {src}) x
                 ON {since} x.at <= instant
          GROUP BY instant)
    WINDOW f AS (ORDER BY instant ROWS BETWEEN {back} PRECEDING AND CURRENT ROW)"""


_SERIES = " UNION ALL ".join(f"SELECT * FROM ({_alert_series(*a)})" for a in [
    *ALERT_SQL, ("host_memory_high", "containers", "time", "(time, usage_percent)", "last", 0, "> 85", "NoData", "critical")])


@query("alert_sustained", "predictions all_slots containers", _SERIES)
def alert_sustained(spark, sf):
    out = alerts.sustained_alerts(_metric_tables(spark, sf), HOURLY, 60, "5 days", chunk_rows=100)
    return rounded(out, "value", digits=9)


@query("alert_episodes", "predictions all_slots containers", f"""
    , series AS ({_SERIES}),
    marked AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY instant)
                         - row_number() OVER (PARTITION BY rule_id, breach ORDER BY instant) AS island FROM series)
    SELECT rule_id, severity, min(instant) AS started_at, max(instant) AS ended_at, count(*) AS evaluations,
           (count(*) - 1) * 60 AS minutes, CASE WHEN rule_id IN ('no_new_predictions', 'pipeline_stale', 'data_gap', 'container_metrics_stale')
           THEN min(value) ELSE max(value) END AS peak, bool_or(state = 'Firing') AS fired
    FROM marked WHERE breach GROUP BY rule_id, severity, island""")
def alert_episodes(spark, sf):
    """Each stretch of evaluations in breach, from its first to its last, and whether it lasted long enough to fire."""
    series = cut_lineage(alerts.sustained_alerts(_metric_tables(spark, sf), HOURLY, 60, "5 days", chunk_rows=100))
    return rounded(alerts.episodes(series, HOURLY, 60, chunk_rows=100), "peak", digits=9)


LAST_STATUS = "(SELECT container_name, arg_max(status, (time, metric_id)) AS status FROM containers GROUP BY 1)"


@query("container_rollup", "containers", f"""
    SELECT count(*) AS total, count(CASE WHEN status = 'running' THEN 1 END) AS running,
           count(CASE WHEN status = 'exited' THEN 1 END) AS stopped,
           count(CASE WHEN status = 'restarting' THEN 1 END) AS restarting,
           count(CASE WHEN status = 'exited' AND container_name IN ('c1', 'c3', 'c5', 'c7', 'c9') THEN 1 END) AS critical_stopped
    FROM {LAST_STATUS}""")
def container_rollup(spark, sf):
    return alerts.container_status(t.container_metrics(spark, sf), ["c1", "c3", "c5", "c7", "c9"])


@query("containers_down", "containers", f"""
    SELECT container_name, status, container_name IN ('c1', 'c3', 'c5', 'c7', 'c9') AS critical
    FROM {LAST_STATUS} WHERE status IN ('exited', 'restarting')""")
def containers_down(spark, sf):
    return alerts.containers_down(t.container_metrics(spark, sf), ["c1", "c3", "c5", "c7", "c9"])


_DAILY = ("event_id", "user_id", "event_type", "value", "props")


@query("merged_profile", sql=" UNION ALL ".join(
    f"SELECT 'events' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, "
    + (f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, round(avg({c}), 4) AS mean_value, "
       if c in ("event_id", "user_id", "value") else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS mean_value, ")
    + "TRUE AS distinct_within FROM events" for c in _DAILY))
def merged_profile(spark, sf):
    """A profile of the month put together from stored days; distinct counts are estimates, here held against exact ones."""
    events = t.events(spark, sf)
    path = f"{shared_dir(spark)}/daily-{uuid.uuid4().hex}"
    quality.daily_profile(events, "events", "ts").write.partitionBy("day").parquet(path)
    merged = quality.merge_profiles(spark.read.parquet(path))
    exact = events.agg(*[F.count_distinct(c).alias(c) for c in _DAILY]).select(
        F.explode(F.map_from_arrays(F.array(*map(F.lit, _DAILY)), F.array(*_DAILY))).alias("column_name", "exact"))
    out = merged.join(exact, "column_name").withColumn(
        "distinct_within", F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact"))).drop("distinct_estimate", "exact")
    return rounded(out, "mean_value", digits=4)


@query("hour_quantile_sketch", sql="""
    SELECT hour(ts) AS hour, count(*) AS n, TRUE AS within FROM events WHERE value IS NOT NULL GROUP BY 1""")
def hour_quantile_sketch(spark, sf):
    """Quartiles by hour of day from stored sketches of single days; ranks of the estimates are held against the rows."""
    events = t.events(spark, sf).select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), "value")
    path = f"{shared_dir(spark)}/sketches-{uuid.uuid4().hex}"
    stats.quantile_sketches(events, ["day", "hour"], "value").write.parquet(path)
    found = stats.merged_quantiles(spark.read.parquet(path), ["hour"], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    ranks = events.join(F.broadcast(found), "hour").groupBy("hour").agg(F.count("value").alias("n"), *[    # a row per hour of the day
        (F.count_if(F.col("value") <= F.col(q)) / F.count("value")).alias(q) for q in ("q1", "median", "q3")])
    within = [F.abs(F.col(q) - p) <= 0.02 + 1 / F.col("n") for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
    return ranks.select("hour", "n", (within[0] & within[1] & within[2]).alias("within"))


@query("document_profile", sql="""
    SELECT 'documents' AS table_name, c.name AS column_name, c.total_rows, c.total_rows - c.n AS null_count, c.d AS distinct_count,
           CAST(0 AS BIGINT) AS type_mismatch, c.lo AS min_value, c.hi AS max_value, round(c.mean, 4) AS mean_value,
           round((c.total_rows - c.n) * 100.0 / c.total_rows, 2) AS null_percent, 'ok' AS quality_status FROM (
        """ + " UNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) AS total_rows, count({c}) AS n, count(DISTINCT {c}) AS d, "
    + (f"CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi, avg({c}) AS mean FROM documents" if c in ("doc_id", "n_chars")
       else "CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi, CAST(NULL AS DOUBLE) AS mean FROM documents")
    for c in ("doc_id", "text", "lang", "source", "n_chars")) + ") c")
def document_profile(spark, sf):
    return rounded(quality.profile(t.table(spark, sf, "documents"), "documents"), "mean_value", digits=4)


@query("status_with_memory", "containers", """
    SELECT container_name, arg_max(status, (time, metric_id)) AS status,
           arg_max(usage_percent, (time, metric_id)) FILTER (WHERE metric_id % 2 = 0) AS usage_percent
    FROM containers GROUP BY 1""")
def status_with_memory(spark, sf):
    m = t.container_metrics(spark, sf)
    last = lambda df: quality.latest_per_key(df, ["container_name"], ["time", "metric_id"])
    return ops.status_with_memory(last(m.drop("usage_percent")).select("container_name", "status"),
                                  last(m.where("metric_id % 2 = 0")).select("container_name", "usage_percent"))


@query("host_alerts", "containers", """
    SELECT metric_id, metric, value, lim AS "limit" FROM (
        SELECT metric_id, 'memory_percent' AS metric, usage_percent AS value, 85.0::DOUBLE AS lim FROM containers
        UNION ALL SELECT metric_id, 'disk_percent', usage_percent - 5, 90.0 FROM containers
        UNION ALL SELECT metric_id, 'cpu_percent', 100 - usage_percent, 90.0 FROM containers) WHERE value > lim""")
def host_alerts(spark, sf):
    used = F.col("usage_percent")
    return alerts.host_alerts(t.container_metrics(spark, sf).select(
        "metric_id", used.alias("memory_percent"), (used - 5).alias("disk_percent"), (100 - used).alias("cpu_percent")))


@query("traffic_lights", "containers", """
    SELECT metric_id, usage_percent,
           CASE WHEN usage_percent < 50 THEN 'green' WHEN usage_percent < 80 THEN 'amber' ELSE 'red' END AS cpu,
           CASE WHEN usage_percent < 60 THEN 'green' WHEN usage_percent < 85 THEN 'amber' ELSE 'red' END AS memory,
           CASE WHEN usage_percent < 70 THEN 'green' WHEN usage_percent < 90 THEN 'amber' ELSE 'red' END AS disk,
           CASE WHEN usage_percent < 95 THEN 'red' WHEN usage_percent < 99 THEN 'amber' ELSE 'green' END AS completeness,
           CASE WHEN usage_percent < 30 THEN 'green' WHEN usage_percent < 120 THEN 'amber' ELSE 'red' END AS age,
           round(100 - (usage_percent + 0.001), 1) AS usage_total FROM containers""")
def traffic_lights(spark, sf):
    m = t.container_metrics(spark, sf).select("metric_id", "usage_percent", (F.col("usage_percent") + 0.001).alias("usage_idle"))
    return ops.usage_columns(m).select(
        "metric_id", "usage_percent", fs.band("usage_percent", fs.CPU_BANDS, "red").alias("cpu"),
        fs.band("usage_percent", fs.MEMORY_BANDS, "red").alias("memory"),
        fs.band("usage_percent", fs.DISK_BANDS, "red").alias("disk"),
        fs.band("usage_percent", fs.COMPLETENESS_BANDS, "green").alias("completeness"),
        fs.band("usage_percent", fs.AGE_BANDS, "red").alias("age"), "usage_total")


# ---- logs and runs -----------------------------------------------------------------------

@query("log_filter", "logs", """
    SELECT log_id, timestamp, service, level, message FROM logs WHERE service = 'svc3' AND level = 'ERROR'
    ORDER BY timestamp DESC, log_id DESC LIMIT 200""")
def log_filter(spark, sf):
    return ops.filter_logs(t.app_logs(spark, sf), "svc3", "ERROR", tie_break="log_id")


@query("alert_history", "logs", """
    SELECT log_id, timestamp, service, level, message FROM logs WHERE level IN ('ERROR', 'CRITICAL')
    ORDER BY timestamp DESC, log_id DESC LIMIT 30""")
def alert_history(spark, sf):
    return ops.alert_history(t.app_logs(spark, sf), tie_break="log_id")


@query("log_levels", "logs", """
    SELECT level, count(*) AS count FROM logs
    WHERE timestamp > (SELECT max(timestamp) FROM logs) - INTERVAL 24 HOUR GROUP BY level""")
def log_levels(spark, sf):
    logs = t.app_logs(spark, sf)
    return ops.level_counts(logs, fs.latest_instant(logs, "timestamp"))


@query("log_services", "logs", "SELECT DISTINCT service FROM logs")
def log_services(spark, sf):
    return ops.services(t.app_logs(spark, sf))


@query("error_series", "logs", """
    SELECT date_trunc('hour', timestamp) AS hour, count(*) AS errors FROM logs WHERE level IN ('ERROR', 'CRITICAL')
      AND timestamp > (SELECT max(timestamp) FROM logs) - INTERVAL 7 DAY GROUP BY 1""")
def error_series(spark, sf):
    logs = t.app_logs(spark, sf)
    return ops.error_series(logs, fs.latest_instant(logs, "timestamp"))


@query("log_predicates", "logs", """
    SELECT log_id, service, level FROM logs WHERE level IN ('ERROR', 'WARNING') AND service <> 'svc0'
      AND service NOT LIKE 'svc1%' AND message IS NOT NULL AND log_id BETWEEN 100 AND (SELECT max(log_id) FROM logs)""")
def log_predicates(spark, sf):
    c = F.col
    top = t.app_logs(spark, sf).agg(F.max("log_id")).first()[0]
    return t.app_logs(spark, sf).where(
        c("level").isin("ERROR", "WARNING") & (c("service") != "svc0") & ~c("service").like("svc1%")
        & c("message").isNotNull() & c("log_id").between(100, top)).select("log_id", "service", "level")


@query("log_summary", "runs", """
    , a AS (SELECT max(finished_at) AS now FROM runs),
    s AS (SELECT count(*) AS r, count(CASE WHEN quality_status = 'failed' THEN 1 END) AS f FROM runs, a
          WHERE finished_at > now - INTERVAL 72 HOUR),
    d AS (SELECT count(*) AS n FROM logs_at, a WHERE changed_at > now - INTERVAL 72 HOUR),
    x AS (SELECT '{"pipeline_runs_1h":' || r || ',"pipeline_failed_1h":' || f || ',"audit_events_1h":' || n || '}' AS extra,
                 r, f, n FROM s, d)
    SELECT 'pipeline_orchestrator' AS service, 'INFO' AS level, r || ' pipeline runs in last hour' AS message, extra FROM x WHERE r > 0
    UNION ALL SELECT 'pipeline_orchestrator', 'ERROR', f || ' pipeline failures in last hour', extra FROM x WHERE f > 0
    UNION ALL SELECT 'pipeline_orchestrator', 'INFO', n || ' audit events in last hour', extra FROM x""".replace(
    "logs_at", "(SELECT o_orderdate AS changed_at FROM orders)"))
def log_summary(spark, sf):
    r = t.runs(spark, sf)
    events = t.table(spark, sf, "orders").select(F.col("o_orderdate").alias("changed_at"))
    return ops.log_summary(r, events, fs.latest_instant(r, "finished_at"), "72 HOURS")


@query("run_success", "runs", """
    SELECT pipeline_name, count(*) AS runs, CAST(sum(CASE WHEN quality_status IN ('ok', 'promoted') THEN 1 ELSE 0 END) AS BIGINT)
           AS succeeded, round(sum(CASE WHEN quality_status IN ('ok', 'promoted') THEN 1 ELSE 0 END) * 100.0 / count(*), 1)
           AS success_rate FROM runs GROUP BY 1""")
def run_success(spark, sf):
    return ops.run_success(t.runs(spark, sf)).withColumn("success_rate", F.col("success_rate").cast("double"))


@query("run_overall", "runs", """
    SELECT round(avg(r), 1) AS mean_success_rate FROM (
        SELECT round(sum(CASE WHEN quality_status IN ('ok', 'promoted') THEN 1 ELSE 0 END) * 100.0 / count(*), 1) AS r
        FROM runs GROUP BY pipeline_name)""")
def run_overall(spark, sf):
    return ops.overall_success(ops.run_success(t.runs(spark, sf)))


@query("run_errors", "runs", """
    SELECT pipeline_name, count(*) AS runs, CAST(sum(CASE WHEN quality_status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failures,
           max(finished_at) AS last_run FROM runs
    WHERE finished_at > (SELECT max(finished_at) FROM runs) - INTERVAL 720 HOUR GROUP BY 1""")
def run_errors(spark, sf):
    r = t.runs(spark, sf)
    return ops.run_errors(r, fs.latest_instant(r, "finished_at"), "720 HOURS")


@query("run_timeline", "runs", """
    SELECT run_id, pipeline_name, quality_status, started_at, finished_at,
           date_diff('second', started_at, finished_at) AS duration_s FROM runs WHERE finished_at IS NOT NULL""")
def run_timeline(spark, sf):
    return ops.run_timeline(t.runs(spark, sf))


@query("nulls_last", "runs", """
    SELECT run_id, pipeline_name, finished_at FROM runs ORDER BY finished_at DESC NULLS LAST, run_id LIMIT 100""")
def nulls_last(spark, sf):
    return ops.newest_runs(t.runs(spark, sf)).select("run_id", "pipeline_name", "finished_at")


@query("dq_history", "runs", """
    SELECT run_id, started_at, quality_status, checks_passed, checks_failed, CAST(NULL AS VARCHAR) AS table_name
    FROM runs WHERE pipeline_name = '1-URGENT' ORDER BY started_at DESC, run_id LIMIT 50""")
def dq_history(spark, sf):
    return quality.validation_history(t.runs(spark, sf), "1-URGENT", ["checks_passed", "checks_failed", "table_name"])


@query("run_status_counts", "runs", "SELECT quality_status, count(*) AS count FROM runs GROUP BY 1")
def run_status_counts(spark, sf):
    return ops.value_counts(t.runs(spark, sf), "quality_status")


@query("freshness", "bars all_slots predictions runs", f"""
    SELECT table_name, last_data_at, date_diff('second', last_data_at, {NOW}) // 60 AS age_minutes FROM (
        SELECT 'bars' AS table_name, max(window_start) AS last_data_at FROM bars UNION ALL
        SELECT 'sentiment', max(window_start) FROM all_slots UNION ALL
        SELECT 'predictions', max(window_start) FROM predictions UNION ALL
        SELECT 'audit', max(timestamp) FROM (SELECT ts AS timestamp FROM events WHERE ts < TIMESTAMP '2000-01-01'))""")
def freshness(spark, sf):
    """One of the tables has no rows."""
    ev = t.events(spark, sf)
    return quality.freshness({
        "bars": (t.bars(spark, sf), "window_start"), "sentiment": (t.all_slots(spark, sf), "window_start"),
        "predictions": (t.predictions(spark, sf), "window_start"),
        "audit": (ev.where(F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz")), "ts"),
    }, fs.latest_instant(ev, "ts"))


@query("top_groups_series", "containers", """
    SELECT container_name, time, usage_percent FROM containers WHERE container_name IN (
        SELECT container_name FROM containers GROUP BY 1 ORDER BY count(*) DESC, container_name LIMIT 5)""")
def top_groups_series(spark, sf):
    return ops.top_groups_series(t.container_metrics(spark, sf), "container_name",
                                 ["container_name", "time", "usage_percent"])


@query("latest_per_key", "containers", """
    SELECT container_name, arg_max(status, (time, metric_id)) AS status, max(time) AS time,
           arg_max(usage_percent, (time, metric_id)) AS usage_percent, arg_max(metric_id, (time, metric_id)) AS metric_id
    FROM containers GROUP BY 1""")
def latest_per_key(spark, sf):
    return quality.latest_per_key(t.container_metrics(spark, sf), ["container_name"], ["time", "metric_id"])


@query("newest_n", "containers", "SELECT * FROM containers ORDER BY time DESC, metric_id DESC LIMIT 50")
def newest_n(spark, sf):
    return ops.newest(t.container_metrics(spark, sf), ["time", "metric_id"], 50)


@query("latest_record", "containers", """
    SELECT arg_max(usage_percent, (time, metric_id)) AS usage_percent, max(time) AS time FROM containers""")
def latest_record(spark, sf):
    return ops.newest(t.container_metrics(spark, sf), ["time", "metric_id"], 1).select("usage_percent", "time")


@query("deep_page", "", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 40 OFFSET (SELECT count(*) // 2 FROM orders)")
def deep_page(spark, sf):
    """A page from the middle of the table: one partition of its order is opened."""
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    book = ops.PagedTable(orders, ["o_totalprice", "o_orderkey"])
    return book.page(book.rows // 2, 40)


@query("page", "", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25 OFFSET 100")
def page(spark, sf):
    return ops.page(t.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"],
                    100, 25)


# ---- SQL and catalog ---------------------------------------------------------------------

@query("federated_sql", "bars scored", """
    SELECT b.symbol, b.window_start, b.close, coalesce(p.n, 0) AS posts FROM bars b
    LEFT JOIN (SELECT time_bucket(INTERVAL '6 hours', created_at) AS w, count(*) AS n FROM scored GROUP BY 1) p
      ON p.w = b.window_start""")
def federated_sql(spark, sf):
    """SQL text joining a market view with the post lake."""
    return files.sql(spark, """
        SELECT b.symbol, b.window_start, b.close, coalesce(p.n, 0) AS posts FROM market_bars b
        LEFT JOIN (SELECT window(created_at, '6 hours').start AS w, count(*) AS n FROM lake_posts GROUP BY 1) p
          ON p.w = b.window_start""", {"market_bars": t.bars(spark, sf), "lake_posts": t.posts(spark, sf).select("id", "created_at")})


@query("sql_surface", "", """
    SELECT o_orderpriority, count(*) AS orders, round(avg(o_totalprice), 2) AS mean_price FROM orders
    WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority HAVING count(*) > 1""")
def sql_surface(spark, sf):
    return files.sql(spark, """
        SELECT o_orderpriority, count(*) AS orders, round(avg(o_totalprice), 2) AS mean_price FROM order_table
        WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority HAVING count(*) > 1""",
                     {"order_table": t.table(spark, sf, "orders")})


@query("external_table", "", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def external_table(spark, sf):
    events = files.register_external(spark, f"events_{uuid.uuid4().hex[:8]}", f"{sf}/events.parquet")
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("glossary_lookup", "", "SELECT n_regionkey, n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def glossary_lookup(spark, sf):
    return catalog.lookup(t.table(spark, sf, "nation"), ["n_regionkey", "n_name"], n_regionkey=2).select(
        "n_regionkey", "n_nationkey", "n_name")


@query("lineage_up", "edges", "SELECT * FROM edges WHERE target_table = 'nation' AND target_column = 'NATION_7'")
def lineage_up(spark, sf):
    return catalog.upstream(t.lineage(spark, sf), "nation", "NATION_7")


@query("lineage_down", "edges", "SELECT * FROM edges WHERE source_table = 'region' AND source_column = 'ASIA'")
def lineage_down(spark, sf):
    return catalog.downstream(t.lineage(spark, sf), "region", "ASIA")


NODES = """
    n AS (SELECT node, row_number() OVER (ORDER BY node) - 1 AS node_id FROM (
        SELECT source_table || '.' || source_column AS node FROM edges UNION
        SELECT target_table || '.' || target_column FROM edges UNION
        SELECT 'nation.' || n_name FROM nation UNION SELECT 'customer.' || c_name FROM customer))"""


def _nation_customers(spark, sf):
    c, n = t.table(spark, sf, "customer"), t.table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.lit("nation").alias("source_table"), F.col("n_name").alias("source_column"),
        F.lit("customer").alias("target_table"), F.col("c_name").alias("target_column"))


@query("lineage_nodes", "edges", f", {NODES} SELECT node, node_id FROM n")
def lineage_nodes(spark, sf):
    return catalog.lineage_nodes(t.lineage(spark, sf), _nation_customers(spark, sf))


@query("lineage_graph", "edges", f""", {NODES},
    e AS (SELECT source_table || '.' || source_column AS source, target_table || '.' || target_column AS target FROM edges
          UNION SELECT 'nation.' || n_name, 'customer.' || c_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT e.source, e.target, a.node_id AS source_id, b.node_id AS target_id
    FROM e JOIN n a ON a.node = e.source JOIN n b ON b.node = e.target""")
def lineage_graph(spark, sf):
    return catalog.lineage_graph(t.lineage(spark, sf), _nation_customers(spark, sf))
