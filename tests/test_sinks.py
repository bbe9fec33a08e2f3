import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import minute, rows
from tickflow.schemas import APP_LOGS, BARS, PREDICTIONS, RUNS, conform
from tickflow.sinks import policies, tables
from tickflow.sources import files, ticks

BAR = ("symbol string, window_start timestamp_ntz, window_end timestamp_ntz, open double, high double, low double, "
       "close double, volume double, trade_count int, volatility double")


def bars(spark, items):
    return spark.createDataFrame([("s", minute(m), minute(m + 1), c, c, c, c, 1.0, 1, None) for m, c in items], BAR)


@pytest.fixture
def table(spark, tmp_path):
    return tables.Table(spark, str(tmp_path / "bars"), BARS, ["symbol", "window_start"])


def closes(table):
    return [(r["window_start"], float(r["close"])) for r in table.read().orderBy("window_start").collect()]


def test_insert_absent_counts(spark, table):
    assert table.insert_absent(bars(spark, [(0, 1.0), (1, 2.0)])) == (2, 0)
    assert table.insert_absent(bars(spark, [(1, 9.0), (2, 3.0), (2, 3.0)])) == (1, 2)
    assert closes(table) == [(minute(0), 1.0), (minute(1), 2.0), (minute(2), 3.0)]
    assert dict(table.read().dtypes)["close"] == "decimal(18,8)"


def test_upsert_replay_and_untouched_days(spark, table):
    table.upsert(bars(spark, [(0, 1.0), (1440, 2.0), (2880, 3.0)]))
    untouched = [os.path.join(d, f) for d, _, fs in os.walk(table.path) for f in fs if "2024-01-01" in d or "2024-01-03" in d]
    for _ in range(2):
        table.upsert(bars(spark, [(1440, 5.0), (1441, 6.0)]))
    assert closes(table) == [(minute(0), 1.0), (minute(1440), 5.0), (minute(1441), 6.0), (minute(2880), 3.0)]
    assert all(os.path.exists(p) for p in untouched)


def test_upsert_of_chosen_and_computed_columns(spark):
    target = spark.createDataFrame([(1, 10.0, "a", 0.0), (2, 20.0, "b", 0.0)], "k int, x double, y string, z double")
    batch = spark.createDataFrame([(2, 21.0, "B"), (3, 30.0, "C")], "k int, x double, y string")
    got = policies.upsert(target, batch, ["k"], update=["y"], compute={"z": F.abs(F.col("new.x") - F.col("old.x"))})
    assert rows(got, "k") == [(1, 10.0, "a", 0.0), (2, 20.0, "B", 1.0), (3, 30.0, "C", None)]


def test_too_wide_a_number_fails_the_write(spark):
    with pytest.raises(Exception):
        conform(spark.createDataFrame([(1e12,)], "volatility double"), BARS).collect()


def test_purge_keeps_the_day_of_the_limit(spark, table):
    table.append(bars(spark, [(0, 1.0), (1440, 2.0), (1500, 3.0), (4000, 4.0)]))
    as_of = F.lit("2024-01-03 00:30:00").cast("timestamp")
    tables.purge(table, as_of, "1 DAYS")
    assert [m for m, _ in closes(table)] == [minute(1500), minute(4000)]


def test_load_tables_by_policy(spark, tmp_path, table):
    logs = tables.Table(spark, str(tmp_path / "logs"), APP_LOGS, ["timestamp", "service"], time="timestamp")
    line = spark.createDataFrame([(minute(0), "svc", "INFO", "hello")], "timestamp timestamp_ntz, service string, level string, message string")
    targets = {"bars": (table, "absent"), "logs": (logs, "append")}
    done = tables.load_tables(targets, {"bars": bars(spark, [(0, 1.0)]), "logs": line})
    assert done == {"bars": (1, 0), "logs": (1, 0)}
    done = tables.load_tables(targets, {"bars": bars(spark, [(0, 1.0), (1, 1.0)]), "logs": line})
    assert done["bars"] == (1, 1) and logs.read().count() == 2


def test_run_log_and_failure_mark(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.log_run(spark, path, "p", "src", "bars", 5, 1, "ok", {"batch_id": "7"}, run_id="r1")
    tables.log_run(spark, path, "p", "src", "bars", 0, 0, "ok", {})
    runs = spark.read.schema(RUNS).parquet(path)
    assert runs.count() == 2 and runs.where("run_id = 'r1'").first()["rows_processed"] == 5
    failed = policies.mark_failed(runs, runs.where("run_id = 'r1'"), F.current_timestamp())
    assert sorted(r["quality_status"] for r in failed.collect()) == ["failed", "ok"]


def test_post_lake_and_empty_lake(spark, tmp_path):
    df = spark.createDataFrame([(1, minute(5)), (2, minute(45))], "id int, created_at timestamp_ntz")
    tables.post_lake(df, str(tmp_path / "lake"))
    assert os.path.isdir(tmp_path / "lake/year=2024/month=01/day=01/slot=00_30")
    assert files.raw_posts(spark, str(tmp_path / "lake")).count() == 2
    df.where("false").write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        files.raw_posts(spark, str(tmp_path / "none"))


def test_newest_csv_only(spark, tmp_path):
    for name, text in (("old.csv", "id,text\n1,a\n"), ("new.csv", 'id,text\n2,"b, ""c""\nd"\n')):
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (time.time() + (100 if name == "new.csv" else -100),) * 2)
    got = files.harvested_csv(spark, str(tmp_path), "kw")
    assert rows(got) == [("2", 'b, "c"\nd', "kw")]


def test_topic_json(spark):
    df = spark.createDataFrame([(minute(1), 0.5, "v1")], "window_start timestamp_ntz, predicted_vol double, model_version string")
    assert tables.topic_messages(df).first()[0] == '{"window_start":"2024-01-01T00:01:00","predicted_vol":0.5,"model_version":"v1"}'


def test_parse_and_dead_letters(spark):
    good = '{"T":1704067200123,"s":"X","t":1,"p":"1.5","q":"2","m":true}'
    lines = [good, '{"T":1,"s":"X","t":1,"q":"2"}', "not json", "[1]", None, '{"T":1,"p":"1","q":"1","s":"X"}']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    checked = ticks.checked(df)
    assert rows(ticks.good_ticks(checked)) == [("1704067200123", "X", "1", "1.5", "2", True)]
    assert sorted(r["error"] for r in ticks.dead_letters(checked).collect()) == [
        "malformed JSON"] * 3 + ["missing fields: p", "missing fields: t"]
    typed = ticks.good_ticks(checked).withColumns({c: F.col(c).cast("bigint") for c in ("event_time", "trade_id")})
    again = ticks.parse_payload(typed.select(ticks.payload_json(typed).alias("value"))).first()
    assert (again["trade_id"], again["price"], again["is_buyer_mm"]) == (1, 1.5, True)


def test_payload_numbers_that_do_not_parse(spark):
    rowset = ['{"event_time":1704067200123,"symbol":"X","trade_id":1,"price":"1.5","quantity":"lots"}',
              '{"event_time":1704067200123,"symbol":"X","trade_id":2,"price":"abc","quantity":"1"}', '{"symbol":"X"}', "{"]
    got = ticks.parse_payload(spark.createDataFrame([(v,) for v in rowset], "value string")).collect()
    assert [(r["trade_id"], r["price"], r["quantity"], r["is_buyer_mm"]) for r in got] == [(1, 1.5, None, False)]
    assert got[0]["event_time"].microsecond == 123000


def test_prediction_schema_is_complete():
    assert {"predicted_vol", "model_version", "inference_latency_ms"} <= set(PREDICTIONS.fieldNames())


def test_rows_without_a_whole_key_are_rejected_and_stored_rows_stay(spark, table):
    table.upsert(bars(spark, [(0, 1.0), (1, 2.0)]))
    odd = bars(spark, [(1, 5.0), (2, 3.0)]).withColumn("window_start", F.when(F.col("close") > 4, F.col("window_start")))
    assert table.upsert(odd) == 1
    assert table.insert_absent(odd.unionByName(bars(spark, [(3, 4.0)]))) == (1, 2)
    assert closes(table) == [(minute(0), 1.0), (minute(1), 5.0), (minute(3), 4.0)]


def test_only_a_missing_path_counts_as_empty(spark, table, monkeypatch):
    from pyspark.errors import AnalysisException

    class Other(AnalysisException):
        def getCondition(self):
            return "SOMETHING_ELSE"

    assert table.read().count() == 0
    monkeypatch.setattr(type(spark.read), "parquet", lambda *a, **k: (_ for _ in ()).throw(Other("no")))
    with pytest.raises(Other):
        table.read()


def test_runs_and_posts_do_not_change_on_replay(spark, tmp_path):
    path = str(tmp_path / "runs")
    for written in (5, 0):
        tables.log_run(spark, path, "p", "src", "bars", written, 0, "ok", {}, run_id="r1")
    tables.log_run(spark, path, "p", "src", "bars", 1, 0, "ok", {}, run_id="r2")
    assert sorted((r["run_id"], r["rows_processed"]) for r in tables.read_runs(spark, path).collect()) == [("r1", 5), ("r2", 1)]
    tables.mark_run_failed(spark, path, ["r2"])
    assert sorted((r["run_id"], r["quality_status"]) for r in tables.read_runs(spark, path).collect()) == [("r1", "ok"), ("r2", "failed")]
    posts = spark.createDataFrame([(1, minute(5)), (2, minute(45))], "id int, created_at timestamp_ntz")
    for _ in range(2):
        tables.post_lake(posts, str(tmp_path / "lake"))
    lake = files.raw_posts(spark, str(tmp_path / "lake"))
    assert lake.count() == 2
    one = lake.where("year = 2024 AND month = 1 AND day = 1 AND slot = '00_30'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().toString()
