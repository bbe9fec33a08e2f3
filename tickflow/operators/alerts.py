"""Alert rules as data: aggregate over a look-back, compare, hold for a while."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ..functions.scalar import slot_start
from ..plans.chunks import CHUNK_ROWS, bounded_frames, chunk_width, running
from .quality import latest_per_key
from .timejoin import time_series


@dataclass(frozen=True)
class Rule:
    """``measure`` over the rows of the last ``lookback`` minutes, compared with ``limit``.

    Measures: ``count``, ``avg``, ``max`` of ``value`` and ``last`` (latest value
    of the whole table). ``where`` narrows the rows. ``hold`` is how many minutes
    the breach must last; ``no_data`` is the state when there is no value.
    """
    rule_id: str
    table: str
    time: str
    measure: str
    lookback: int
    op: str
    limit: float
    hold: int
    severity: str
    no_data: str = "NoData"
    value: str | None = None
    where: str | None = None


# The nine rules in use.
RULES = [
    Rule("no_new_predictions", "predictions", "window_start", "count", 15, "==", 0, 5, "warning", "Alerting"),
    Rule("high_volatility", "predictions", "window_start", "avg", 60, ">", 0.1, 2, "critical", value="predicted_vol"),
    Rule("pipeline_stale", "sentiment", "created_at", "count", 120, "==", 0, 10, "warning", "Alerting"),
    Rule("data_gap", "bars", "window_start", "count", 5, "==", 0, 2, "critical", "Alerting"),
    Rule("host_memory_high", "mem", "time", "last", 5, ">", 85, 2, "critical", value="used_percent"),
    Rule("host_disk_high", "disk", "time", "max", 5, ">", 90, 5, "critical", value="used_percent",
         where="path NOT LIKE '/var/lib/docker/%'"),
    Rule("host_cpu_high", "cpu", "time", "avg", 5, ">", 90, 5, "warning", value="100 - usage_idle"),
    Rule("container_metrics_stale", "container_status", "time", "count", 2, "==", 0, 3, "critical", "Alerting"),
    Rule("container_failed", "container_status", "time", "count", 5, ">", 0, 2, "warning",
         where="status = 'exited'"),
]

# Host limits of the health check.
HOST_LIMITS = {"memory_percent": 85, "disk_percent": 90, "cpu_percent": 90}


def scaled(rules: Sequence[Rule], factor: int) -> list[Rule]:
    """The same rules on tables whose grid is ``factor`` times coarser."""
    return [replace(r, lookback=r.lookback * factor, hold=r.hold * factor) for r in rules]


def _compare(value: Column, op: str, limit: float) -> Column:
    return {"==": value == limit, ">": value > limit, "<": value < limit,
            ">=": value >= limit, "<=": value <= limit}[op]


def evaluate_at(tables: dict[str, DataFrame], rules: Sequence[Rule], as_of: Column) -> DataFrame:
    """One row per rule: value, breach and state at the instant ``as_of``.

    Rules on the same table share one scan, each as conditional aggregates; the scan takes
    the longest look-back of its rules, or up to ``as_of`` if one asks for the last value.
    """
    out = []
    for name in dict.fromkeys(r.table for r in rules):
        group = [r for r in rules if r.table == name]
        aggs = []
        for r in group:
            ts = F.col(r.time)
            until = ts <= as_of
            inside = until if r.measure == "last" else until & (ts > as_of - F.expr(f"INTERVAL {r.lookback} MINUTES"))
            if r.where:
                inside = inside & F.expr(r.where)
            value = F.when(inside, F.expr(r.value) if r.value else F.lit(1))
            aggs.append({"count": lambda v=value: F.count(v), "avg": lambda v=value: F.avg(v),
                         "max": lambda v=value: F.max(v),
                         "last": lambda v=value, t=ts: F.max_by(v, F.when(v.isNotNull(), t))}[r.measure]()
                        .cast("double").alias(r.rule_id))
        rows = []
        for r in group:
            value = F.col(r.rule_id)
            breach = _compare(value, r.op, r.limit)
            rows.append(F.struct(
                F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"), value.alias("value"),
                F.coalesce(breach, F.lit(r.no_data == "Alerting")).alias("breach"),
                F.when(value.isNull(), r.no_data).when(breach, "Alerting").otherwise("Normal").alias("state")))
        ts = F.col(group[0].time)
        needed = ts <= as_of
        if len({r.time for r in group}) == 1:
            if all(r.measure != "last" for r in group):
                needed = needed & (ts > as_of - F.expr(f"INTERVAL {max(r.lookback for r in group)} MINUTES"))
            rows_needed = tables[name].where(needed)
        else:
            rows_needed = tables[name]
        out.append(rows_needed.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), out)


def evaluate_series(df: DataFrame, rule: Rule, step_minutes: int, block: str) -> DataFrame:
    """The rule at every step from the first to the last row of its table.

    Rows are first reduced to one partial per step; only partials are copied to
    the ``lookback / step`` instants that see them, and a last value is carried on until the next.
    ``lookback`` must be a multiple of the step.
    """
    if rule.measure != "last" and rule.lookback % step_minutes:
        raise ValueError("look-back must be a multiple of the step")
    step = f"{step_minutes} minutes"
    # instant e sees rows in (e - lookback, e]: a row belongs to the first instant at or after it
    tick = F.expr("INTERVAL 1 MICROSECOND")
    cell = slot_start(F.col(rule.time) - tick, step) + F.expr(f"INTERVAL {step}")
    # the grid covers every row of the table, also those the rule filters out
    grid = time_series(df.select(cell.alias("_cell")), "_cell", step, block, "instant")
    value = (F.expr(rule.value) if rule.value else F.lit(1)).cast("double")
    kept = df.where(rule.where) if rule.where else df
    if rule.measure == "last":
        values = kept.select(cell.alias("instant"), value.alias("_v"), F.col(rule.time).alias("_at")).where("_v IS NOT NULL")
        newest = values.groupBy("instant").agg(F.max_by("_v", F.struct("_at", "_v")).alias("_v"))
        out = running(grid.join(newest, "instant", "left"), [], ["instant"], {"value": ("last", "_v")}, width=block)
        return _judged(out, rule)
    cells = (kept.select(cell.alias("_cell"), value.alias("_v")).groupBy("_cell")
             .agg(F.count("_v").alias("_n"), F.sum("_v").alias("_s"), F.max("_v").alias("_m")))
    span = F.expr(f"INTERVAL {rule.lookback - step_minutes} MINUTES")
    seen = (cells.withColumn("instant", F.explode(F.sequence(
        F.col("_cell"), F.col("_cell") + span, F.expr(f"INTERVAL {step}"))))
        .groupBy("instant").agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.max("_m").alias("_m")))
    measured = {"count": F.coalesce("_n", F.lit(0)).cast("double"), "avg": F.try_divide("_s", "_n"),
                "max": F.col("_m")}[rule.measure]
    return _judged(grid.join(seen, "instant", "left").withColumn("value", measured), rule)


def _judged(series: DataFrame, rule: Rule) -> DataFrame:
    return series.select(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.severity).alias("severity"), "instant", "value",
                      F.coalesce(_compare(F.col("value"), rule.op, rule.limit),
                                 F.lit(rule.no_data == "Alerting")).alias("breach"))


def sustain(series: DataFrame, rules: Sequence[Rule], step_minutes: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``state`` to the series of some rules: a breach is ``Pending`` until it has held
    for the rule's ``hold`` minutes, then ``Firing``. Holding means every evaluation of
    a frame of fixed length breached, so frames are bounded and a series can be cut
    anywhere; all rules share one pass."""
    back = {r.rule_id: -(-r.hold // step_minutes) for r in rules}

    def compute(rows, window):
        held = F.lit(False)
        for n in sorted(set(back.values())):
            frame = window.rowsBetween(-n, 0)
            held = F.when(F.col("rule_id").isin(*[r for r, b in back.items() if b == n]),
                          F.count_if("breach").over(frame) == n + 1).otherwise(held)
        return rows.withColumn("state", F.when(~F.col("breach"), "Normal").when(held, "Firing").otherwise("Pending"))

    return bounded_frames(series, ["rule_id"], ["instant"], chunk_width(f"{step_minutes} minutes", chunk_rows),
                          max(back.values()), 0, compute)


def sustained_alerts(tables: dict[str, DataFrame], rules: Sequence[Rule], step_minutes: int, block: str,
                     chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    series = [evaluate_series(tables[r.table], r, step_minutes, block) for r in rules]
    return sustain(reduce(lambda a, b: a.unionByName(b), series), rules, step_minutes, chunk_rows)


def episodes(sustained: DataFrame, rules: Sequence[Rule], step_minutes: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A row per stretch of consecutive breaches: first and last instant, evaluations, minutes, the value
    furthest beyond the limit, and whether it fired.

    A breach after a calm evaluation starts a stretch; its start is carried along, from chunk to chunk over their
    seams, and names the stretch. A stretch of any length is summed before it is shuffled.
    """
    width = chunk_width(f"{step_minutes} minutes", chunk_rows)

    def compute(rows, window):
        calm = ~F.coalesce(F.lag("breach").over(window), F.lit(False))
        return rows.withColumn("_start", F.when(F.col("breach") & calm, F.col("instant")))

    marked = bounded_frames(sustained, ["rule_id"], ["instant"], width, 1, 0, compute)
    named = running(marked, ["rule_id"], ["instant"], {"started_at": ("last", "_start")}, width=width).where("breach")
    falling = [r.rule_id for r in rules if r.op in ("<", "<=", "==")]
    peak = F.when(F.col("rule_id").isin(*falling), F.min("value")).otherwise(F.max("value")) if falling else F.max("value")
    return (named.groupBy("rule_id", "severity", "started_at")
            .agg(F.max("instant").alias("ended_at"), F.count(F.lit(1)).alias("evaluations"),
                 (F.count(F.lit(1)) * step_minutes - step_minutes).alias("minutes"), peak.alias("peak"),
                 F.max(F.col("state") == "Firing").alias("fired")))


def _last_status(metrics: DataFrame) -> DataFrame:
    return latest_per_key(metrics.select("container_name", "status", "time", "metric_id"),
                          ["container_name"], ["time", "metric_id"])


def container_status(metrics: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Totals by latest status; works on one row per container, however many readings there are."""
    status = F.col("status")
    return _last_status(metrics).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(status == "running").alias("running"),
        F.count_if(status == "exited").alias("stopped"), F.count_if(status == "restarting").alias("restarting"),
        F.count_if((status == "exited") & F.col("container_name").isin(*critical)).alias("critical_stopped"))


def containers_down(metrics: DataFrame, critical: Sequence[str]) -> DataFrame:
    """A row per container that is stopped or restarting, and whether it is a critical one."""
    down = _last_status(metrics).where(F.col("status").isin("exited", "restarting"))
    return down.select("container_name", "status", F.col("container_name").isin(*critical).alias("critical"))


def host_alerts(readings: DataFrame, limits: dict[str, float] = HOST_LIMITS) -> DataFrame:
    """A row and message for each reading over its limit."""
    tests = F.array_compact(F.array(*[
        F.when(F.col(c) > v, F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"),
                                      F.lit(float(v)).alias("limit"))) for c, v in limits.items()]))
    return readings.select(*[c for c in readings.columns if c not in limits], F.explode(tests).alias("r")) \
        .select(*[c for c in readings.columns if c not in limits], "r.*")
