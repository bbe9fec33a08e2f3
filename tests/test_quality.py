import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, minute, rows
from tickflow.operators import alerts, catalog, expectations as ex, ops, quality, stats
from tickflow.functions.scalar import COMPLETENESS_BANDS, band, sentiment_sign


def test_profile_counts_mismatches_and_long_texts(spark):
    df = spark.createDataFrame([("1", 1, "x" * 100), ("oops", 2, "x" * 100), (None, None, "y" * 100), ("3", 2, None)],
                               "a string, b int, c string")
    got = {r["column_name"]: r for r in quality.profile(df, "t", numeric=["a", "b"]).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["null_count"], a["type_mismatch"], a["distinct_count"], a["min_value"], a["mean_value"]) == (1, 1, 3, 1.0, 2.0)
    assert (b["null_percent"], b["quality_status"], b["max_value"]) == (25.0, "failed", 2.0)
    assert (c["distinct_count"], c["min_value"], c["total_rows"]) == (2, None, 4)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "z")], "k string, t int, v string")
    assert rows(quality.latest_per_key(df, ["k"], ["t"]), "k") == [("a", 2, None), ("b", 1, "z")]


def expect(df, kind, **kw):
    return ex.evaluate(df, [{"expectation_type": kind, "kwargs": kw, "meta": {"severity": "x"}}], "t").first()


def test_mostly_at_its_limit(spark):
    df = spark.createDataFrame([(i if i < 9 else None, i) for i in range(10)], "v int, w int")
    assert expect(df, ex.NOT_NULL, column="v", mostly=0.9)["success"]
    assert not expect(df, ex.NOT_NULL, column="v", mostly=0.91)["success"]
    assert not expect(df, ex.NOT_NULL, column="v")["success"]
    r = expect(df, ex.BETWEEN, column="v", min_value=0, strict_min=True)
    assert (r["considered"], r["unexpected"], r["success"]) == (9, 1, False)


def test_mostly_in_meta_has_no_effect(spark):
    df = spark.createDataFrame([(-1,), (1,)], "v int")
    suite = [{"expectation_type": ex.BETWEEN, "kwargs": {"column": "v", "min_value": 0}, "meta": {"severity": "w", "mostly": 0.1}}]
    assert not ex.evaluate(df, suite, "t").first()["success"]


def test_expectation_kinds(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (2, 1, None)], "x int, y int, s string")
    assert not expect(df, ex.PAIR, column_A="x", column_B="y")["success"]
    assert expect(df, ex.PAIR, column_A="x", column_B="y", or_equal=True)["success"]
    assert expect(df, ex.IN_SET, column="s", value_set=["a", "b"])["success"]
    assert expect(df, ex.UNIQUE, column_list=["x", "y"])["success"]
    assert expect(df, ex.UNIQUE, column_list=["x"])["unexpected"] == 2
    assert not expect(df, ex.ROW_COUNT, min_value=1, max_value=2)["success"]
    with pytest.raises(ValueError):
        expect(df, "expect_magic", column="x")


def test_expectations_on_an_empty_table(spark):
    df = spark.createDataFrame([], "window_start timestamp, compound_score double, positive_ratio double, "
                                   "negative_ratio double, neutral_ratio double, post_count bigint, "
                                   "data_quality string, weighted_compound double")
    got = ex.evaluate(df, ex.sentiment_suite(), "t").collect()
    assert [r["expectation"] for r in got if not r["success"]] == [ex.ROW_COUNT]


def test_suite_from_json():
    import json
    text = json.dumps({"expectations": ex.bar_suite()})
    assert ex.load_suite(text) == ex.bar_suite() and len(ex.bar_suite()) == 13
    assert (len(ex.sentiment_suite()), len(ex.prediction_suite())) == (12, 8)


def alert_frame(spark, minutes):
    return spark.createDataFrame([(minute(m),) for m in minutes], "t timestamp_ntz")


def test_hold_is_broken_by_one_good_evaluation(spark):
    rule = alerts.Rule("quiet", "x", "t", "count", 1, "==", 0, 3, "warning", "Alerting")
    # rows at 0, 6 and 20: nothing seen at 1..5 and 7..19
    out = alerts.sustain(alerts.evaluate_series(alert_frame(spark, [0, 6, 20]), rule, 1, "10 minutes"), [rule], 1, chunk_rows=4)
    state = {int((r["instant"] - T0) / timedelta(minutes=1)): r["state"] for r in out.collect()}
    assert [state[i] for i in range(0, 8)] == ["Normal", "Pending", "Pending", "Pending", "Firing", "Firing", "Normal", "Pending"]
    assert [state[i] for i in (9, 10, 19, 20)] == ["Pending", "Firing", "Firing", "Normal"]


def test_look_back_is_open_at_its_start(spark):
    rule = alerts.Rule("n", "x", "t", "count", 2, ">", 0, 0, "warning")
    out = {r["instant"]: r["value"] for r in alerts.evaluate_series(alert_frame(spark, [0, 1, 5]), rule, 1, "10 minutes").collect()}
    assert out == {minute(0): 1, minute(1): 2, minute(2): 1, minute(3): 0, minute(4): 0, minute(5): 1}


def test_no_data_states(spark):
    df = alert_frame(spark, [0]).withColumn("v", F.lit(5.0))
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    rules = [alerts.Rule("a", "x", "t", "avg", 5, ">", 1, 0, "w", value="v"),
             alerts.Rule("b", "x", "t", "count", 5, "==", 0, 0, "w", "Alerting"),
             alerts.Rule("c", "x", "t", "last", 5, ">", 1, 0, "w", value="v")]
    got = {r["rule_id"]: (r["state"], r["breach"]) for r in alerts.evaluate_at({"x": df}, rules, as_of).collect()}
    assert got == {"a": ("NoData", False), "b": ("Alerting", True), "c": ("Alerting", True)}
    assert len(alerts.RULES) == 9


def test_container_rollup(spark):
    df = spark.createDataFrame([("a", "running", minute(0), 1), ("a", "exited", minute(1), 2), ("b", "exited", minute(0), 3),
                                ("b", "running", minute(0), 4), ("c", "restarting", minute(0), 5)],
                               "container_name string, status string, time timestamp_ntz, metric_id int")
    assert rows(alerts.container_status(df, ["a", "z"])) == [(3, 1, 1, 1, 1)]
    assert rows(alerts.containers_down(df, ["a", "z"]), "container_name") == [("a", "exited", True), ("c", "restarting", False)]


def test_bands(spark):
    df = spark.createDataFrame([(94.9,), (95.0,), (99.0,), (None,)], "v double")
    got = [r[0] for r in df.select(band("v", COMPLETENESS_BANDS, "green")).collect()]
    assert got == ["red", "amber", "green", None]
    c = spark.createDataFrame([(0.05,), (0.06,), (-0.05,), (-0.06,)], "c double")
    assert [r[0] for r in c.select(sentiment_sign("c")).collect()] == ["neutral", "positive", "neutral", "negative"]


def test_log_summary_error_row_only_when_needed(spark):
    schema = "pipeline_name string, quality_status string, finished_at timestamp_ntz"
    audit = spark.createDataFrame([(minute(0),)], "changed_at timestamp_ntz")
    as_of = F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")
    good = spark.createDataFrame([("p", "ok", minute(0))], schema)
    assert [r["level"] for r in ops.log_summary(good, audit, as_of).collect()] == ["INFO", "INFO"]
    bad = good.unionByName(spark.createDataFrame([("p", "failed", minute(1))], schema))
    got = ops.log_summary(bad, audit, as_of).collect()
    assert [(r["level"], r["message"]) for r in got] == [
        ("INFO", "2 pipeline runs in last hour"), ("ERROR", "1 pipeline failures in last hour"),
        ("INFO", "1 audit events in last hour")]
    none = ops.log_summary(good.where("false"), audit.where("false"), as_of).collect()
    assert [(r["level"], r["message"]) for r in none] == [("INFO", "0 audit events in last hour")]


def test_catalog(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    df.createOrReplaceTempView("catalog_probe")
    assert "catalog_probe" in [r["table_name"] for r in catalog.tables(spark).collect()]
    assert [(r["column_name"], r["data_type"]) for r in catalog.columns(spark, "catalog_probe").collect()] == [
        ("id", "int"), ("name", "string")]
    assert catalog.table_or_empty(spark, "catalog_probe", df.schema).count() == 1
    empty = catalog.table_or_empty(spark, "never_made", df.schema)
    assert empty.count() == 0 and empty.columns == ["id", "name"]


def test_profile_of_zeros_nan_and_nothing(spark):
    df = spark.createDataFrame([(0.0, "a"), (-0.0, "b" * 200), (float("nan"), None), (None, "a")], "x double, s string")
    got = {r["column_name"]: r for r in quality.profile(df, "t").collect()}
    assert (got["x"]["distinct_count"], got["x"]["null_count"], got["x"]["mean_value"], got["x"]["total_rows"]) == (1, 2, 0.0, 4)
    assert (got["s"]["distinct_count"], got["s"]["null_count"]) == (2, 1)
    empty = {r["column_name"]: r for r in quality.profile(df.limit(0), "t").collect()}
    assert set(empty) == {"x", "s"} and all((r["total_rows"], r["null_percent"], r["quality_status"]) == (0, 0.0, "ok") for r in empty.values())
    rough = {r["column_name"]: r["distinct_count"] for r in quality.profile(df, "t", distinct_rsd=0.05).collect()}
    assert rough == {"x": 1, "s": 2}


def test_audit_compares_by_name(spark):
    from tickflow.operators.audit import audit_diff
    old = spark.createDataFrame([(1, "a", "b"), (2, "x", "y")], "k int, p string, q string")
    new = spark.createDataFrame([("b", "a", 1), ("z", "x", 2)], "q string, p string, k int")
    got = audit_diff(old, new, ["k"], "t").collect()
    assert [(r["k"], r["operation"], r["new_data"]) for r in got] == [(2, "UPDATE", '{"k":2,"p":"x","q":"z"}')]
    with pytest.raises(ValueError):
        audit_diff(old, new.drop("q"), ["k"], "t")


def test_quantiles_with_one_value_in_most_rows(spark):
    from statistics import quantiles

    from tickflow.plans.rowindex import exact_quantiles
    data = [("a", 7.5)] * 900 + [("a", float(x)) for x in range(-50, 50)] + [("b", -1e-300), ("b", 1e300), ("b", 0.0), ("b", float("nan")), ("b", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", {"q1": 0.25, "median": 0.5, "top": 1.0, "p97": 0.97}).collect()}
    cuts = quantiles([v for k, v in data if k == "a"], n=100, method="inclusive")
    assert (got["a"]["n"], got["a"]["q1"], got["a"]["median"], got["a"]["top"]) == (1000, cuts[24], cuts[49], 49.0)
    assert got["a"]["p97"] == pytest.approx(cuts[96])
    assert (got["b"]["n"], got["b"]["median"], got["b"]["top"]) == (3, 0.0, 1e300)


def test_episodes_equal_brute_force_over_chunk_seams(spark):
    rng = random.Random(9)
    flags = {"up": [rng.random() < 0.7 for _ in range(60)], "down": [True] * 40 + [False] + [True] * 19}
    data = [(rule, "warning", minute(i), float(rng.randint(0, 9)), b, "Firing" if b and i % 5 == 0 else "Normal") for rule, v in flags.items() for i, b in enumerate(v)]
    series = spark.createDataFrame(data, "rule_id string, severity string, instant timestamp_ntz, value double, breach boolean, state string")
    rules = [alerts.Rule("up", "x", "t", "max", 1, ">", 1, 0, "warning"), alerts.Rule("down", "x", "t", "count", 1, "==", 0, 0, "warning")]
    want = []
    for rule in flags:
        run = []
        for r in [x for x in data if x[0] == rule] + [(rule, "", None, 0, False, "")]:
            if r[4]:
                run.append(r)
            elif run:
                peak = (max if rule == "up" else min)(x[3] for x in run)
                want.append((rule, "warning", run[0][2], run[-1][2], len(run), len(run) - 1, peak, any(x[5] == "Firing" for x in run)))
                run = []
    for chunk in (3, 100):
        assert sorted(map(tuple, alerts.episodes(series, rules, 1, chunk_rows=chunk).collect())) == sorted(want)


def test_series_of_a_last_value_is_carried(spark):
    df = spark.createDataFrame([(minute(0), 5.0), (minute(3), None), (minute(7), 1.0)], "t timestamp_ntz, v double")
    rule = alerts.Rule("c", "x", "t", "last", 5, ">", 2, 0, "w", value="v")
    out = {r["instant"]: (r["value"], r["breach"]) for r in alerts.evaluate_series(df, rule, 1, "4 minutes").collect()}
    assert out == {minute(i): (5.0, True) if i < 7 else (1.0, False) for i in range(8)}


def test_pages_equal_slices_and_open_few_ranges(spark):
    data = [(i * 7919 % 1000 // 3, i) for i in range(1000)]
    book = ops.PagedTable(spark.createDataFrame(data, "v int, i int").repartition(6), ["v", "i"], ranges=6)
    whole = sorted(data)
    for start, n in ((0, 10), (480, 50), (995, 20), (0, 1000), (2000, 5)):
        assert rows(book.page(start, n)) == whole[start:start + n]
    assert book.rows == 1000 and len(book.starts) > 1
    plan = book.page(500, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_range" in plan
    assert rows(ops.PagedTable(spark.createDataFrame([], "v int, i int"), ["v"]).page(0, 5)) == []


def test_profiles_of_days_add_up(spark):
    data = [(minute(1440 * (i % 4) + 1), i % 700, None if i % 10 == 0 else float(i), f"k{i % 3}") for i in range(5000)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, user int, v double, k string")
    stored = quality.daily_profile(df, "t", "ts")
    assert stored.count() == 12
    got = {r["column_name"]: r for r in quality.merge_profiles(stored).collect()}
    assert got["v"]["null_count"] == 500 and got["v"]["max_value"] == 4999.0 and got["v"]["total_rows"] == 5000
    assert got["v"]["mean_value"] == pytest.approx(sum(x[2] for x in data if x[2] is not None) / 4500)
    for name, exact in (("user", 700), ("v", 4500), ("k", 3)):
        assert abs(got[name]["distinct_estimate"] - exact) <= max(1, 0.05 * exact)
    assert got["k"]["min_value"] is None and got["k"]["mean_value"] is None


def test_merged_quantile_sketches_keep_their_rank_error(spark):
    rng = random.Random(10)
    data = [(d, h, rng.lognormvariate(0, 2)) for d in range(5) for h in range(2) for _ in range(1500)] + [(0, 0, None)]
    stored = stats.quantile_sketches(spark.createDataFrame(data, "day int, hour int, v double"), ["day", "hour"], "v")
    for r in stats.merged_quantiles(stored, ["hour"], {"a": 0.05, "b": 0.5, "c": 0.99}).collect():
        mine = [v for _, h, v in data if h == r["hour"] and v is not None]
        for name, p in (("a", 0.05), ("b", 0.5), ("c", 0.99)):
            assert abs(sum(v <= r[name] for v in mine) / len(mine) - p) < 0.02
