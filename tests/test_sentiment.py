import math

import pytest

from conftest import minute, rows
from tickflow.functions.scalar import first_present
from tickflow.operators import sentiment as s

POST = "id bigint, created_at timestamp_ntz, text string, likes string, keyword string"


def posts(spark, data):
    return spark.createDataFrame(data, POST)


def test_lexicon_score_reads_whole_texts(spark):
    long = "filler " * 5000 + "good"
    df = posts(spark, [(1, minute(0), "Good, GOOD bad!", "1", "k"), (2, minute(0), None, "1", "k"),
                       (3, minute(0), "nothing here", "1", "k"), (4, minute(0), long, "1", "k")])
    got = {r["id"]: r["compound"] for r in s.score_posts(df, {"good": 2.0, "bad": -1.0}).collect()}
    assert got == {1: round(3 / math.sqrt(9 + 15), 4), 2: 0.0, 3: 0.0, 4: round(2 / math.sqrt(19), 4)}
    table = spark.createDataFrame([("good", 2.0), ("bad", -1.0)], "word string, valence double")
    assert {r["id"]: r["compound"] for r in s.score_posts(df, table).collect()} == got


def test_text_column_is_resolved(spark):
    df = posts(spark, [(1, minute(0), "good", "1", "k")]).withColumnRenamed("text", "tweet_text")
    assert s.score_posts(df, {"good": 1.0}).first()["compound"] == 0.25
    with pytest.raises(ValueError):
        s.score_posts(df.drop("tweet_text"), {"good": 1.0})
    assert first_present(["a", "likes"], s.LIKE_COLUMNS) == "likes" and first_present([], s.LIKE_COLUMNS) is None


def scored(spark, data):
    return spark.createDataFrame(data, "created_at timestamp_ntz, compound double, likes string")


def test_quality_flag_boundary_and_slot_edges(spark):
    df = scored(spark, [(minute(1), 0.1, "1")] * 4 + [(minute(30), 0.1, "1")] * 5)
    got = rows(s.sentiment_slots(df).select("window_start", "post_count", "data_quality"), "window_start")
    assert got == [(minute(0), 4, "low_sample"), (minute(30), 5, "ok")]


def test_weights_and_ratios(spark):
    df = scored(spark, [(minute(1), 0.5, "3"), (minute(1), -0.5, "junk"), (minute(1), 0.05, "0"), (minute(1), 0.0, None)])
    r = s.sentiment_slots(df).first()
    assert r["weighted_compound"] == round((0.5 * 3 - 0.5 + 0.05) / 6, 4)
    assert (r["positive_ratio"], r["negative_ratio"], r["neutral_ratio"]) == (0.25, 0.25, 0.5)      # 0.05 is neutral
    plain = s.sentiment_slots(df.drop("likes")).first()
    assert plain["weighted_compound"] == plain["compound_score"] == round(0.05 / 4, 4)


def test_dedup_keeps_the_first_of_any_number_of_copies(spark):
    df = posts(spark, [(1, minute(5), "b", "1", "k")] * 500 + [(1, minute(2), "a", "2", "k"), (2, minute(1), "c", "3", "k")])
    assert rows(s.dedup_posts(df).select("id", "text"), "id") == [(1, "a"), (2, "c")]
    assert s.dedup_posts(df.drop("id")).count() == 502


def test_concat_fills_missing_columns(spark):
    a = posts(spark, [(1, minute(0), "x", "1", "k")])
    out = s.concat_posts([a, a.drop("likes"), a.select("id")])
    assert out.columns == a.columns and out.where("likes IS NULL").count() == 2


def test_gate(spark):
    ok = scored(spark, [(minute(0), 1.0, "1")])
    assert s.check_scores(ok).count() == 0 and s.require_scores(ok) is ok
    with pytest.raises(ValueError, match="out of"):
        s.require_scores(scored(spark, [(minute(0), 1.5, "1")]))
    with pytest.raises(ValueError, match="null values in compound"):
        s.require_scores(scored(spark, [(minute(0), None, "1")]))


SLOT = ("window_start timestamp_ntz, window_end timestamp_ntz, compound_score double, positive_ratio double, "
        "negative_ratio double, neutral_ratio double, weighted_compound double, post_count bigint, data_quality string")


def test_stale_carry_skips_stale_sources(spark):
    data = [(minute(0), minute(30), 0.1, .1, .1, .8, 0.1, 9, "ok"),
            (minute(30), minute(60), 0.9, .1, .1, .8, 0.9, 9, "stale"),
            (minute(120), minute(150), 0.3, .1, .1, .8, 0.3, 9, "ok")]
    got = rows(s.carry_stale(spark.createDataFrame(data, SLOT), "30 minutes", "1 hour")
               .select("window_start", "compound_score", "data_quality"), "window_start")
    assert got == [(minute(0), 0.1, "ok"), (minute(30), 0.9, "stale"), (minute(60), 0.1, "stale"),
                   (minute(90), 0.1, "stale"), (minute(120), 0.3, "ok")]
