"""Posts and sentiment."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from tickflow.functions.scalar import sentiment_sign
from tickflow.operators import quality, sentiment
from tickflow.schemas import sentiment_rules
from tickflow.session import shared_dir
from tickflow.sinks import tables as sinks
from tickflow.sources import files

from . import tables as t
from .registry import query, rounded

SLOT_COLS = ("window_start, window_end, compound_score, positive_ratio, negative_ratio, neutral_ratio, "
             "weighted_compound, post_count, data_quality")


@query("post_concat", "first_posts", """
    SELECT id, text, likes, NULL AS lang FROM first_posts WHERE lang = 'en' UNION ALL
    SELECT id, text, NULL, lang FROM first_posts WHERE lang <> 'en'""")
def post_concat(spark, sf):
    raw = t.raw_posts(spark, sf).where("keyword NOT LIKE '%-again'")
    return sentiment.concat_posts([raw.where("lang = 'en'").select("id", "text", "likes"),
                                   raw.where("lang <> 'en'").select("lang", "id", "text")])


@query("post_dedup", "posts", "SELECT id, created_at, keyword, likes, length(text) AS chars FROM posts")
def post_dedup(spark, sf):
    return t.posts(spark, sf).select("id", "created_at", "keyword", "likes", F.length("text").cast("bigint").alias("chars"))


@query("post_sentiment", "scored", "SELECT id, created_at, lang, keyword, likes, compound FROM scored")
def post_sentiment(spark, sf):
    return t.scored_posts(spark, sf)


@query("sentiment_slots", "all_slots", f"SELECT {SLOT_COLS} FROM all_slots")
def sentiment_slots(spark, sf):
    return t.all_slots(spark, sf).drop("source_file")


@query("stale_carry", "slots", """
    , grid AS (SELECT unnest(generate_series((SELECT min(window_start) FROM slots),
                                             (SELECT max(window_start) FROM slots), INTERVAL 12 HOUR)) AS g),
    j AS (SELECT g, s.* FROM grid LEFT JOIN slots s ON s.window_start = g)
    SELECT g AS window_start, g + INTERVAL 12 HOUR AS window_end,
           last_value(compound_score IGNORE NULLS) OVER w AS compound_score,
           last_value(positive_ratio IGNORE NULLS) OVER w AS positive_ratio,
           last_value(negative_ratio IGNORE NULLS) OVER w AS negative_ratio,
           last_value(neutral_ratio IGNORE NULLS) OVER w AS neutral_ratio,
           last_value(weighted_compound IGNORE NULLS) OVER w AS weighted_compound,
           last_value(post_count IGNORE NULLS) OVER w AS post_count, coalesce(data_quality, 'stale') AS data_quality
    FROM j WINDOW w AS (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def stale_carry(spark, sf):
    return sentiment.carry_stale(t.slots(spark, sf), t.SLOT, "5 days")


@query("mark_stale", "all_slots", """
    SELECT window_start, post_count, CASE WHEN hour(window_start) = 12 AND day(window_start) % 5 = 0 THEN 'stale'
           ELSE data_quality END AS data_quality FROM all_slots""")
def mark_stale(spark, sf):
    slots = t.all_slots(spark, sf)
    failed = slots.where("hour(window_start) = 12 AND day(window_start) % 5 = 0")
    return sentiment.mark_stale(slots, failed).select("window_start", "post_count", "data_quality")


@query("posts_per_minute_join", "bars scored", """
    SELECT b.symbol, b.window_start, b.close, round(p.c, 10) AS avg_compound, coalesce(p.n, 0) AS post_count
    FROM bars b LEFT JOIN (SELECT time_bucket(INTERVAL '6 hours', created_at) AS w, avg(compound) AS c, count(*) AS n
                           FROM scored GROUP BY 1) p ON p.w = b.window_start""")
def posts_per_minute_join(spark, sf):
    per = sentiment.posts_per_minute(t.scored_posts(spark, sf), t.BAR)
    out = t.bars(spark, sf).select("symbol", "window_start", "close").join(per, "window_start", "left")
    return rounded(out.withColumn("post_count", F.coalesce("post_count", F.lit(0))), "avg_compound", digits=10)


@query("posts_by_minute", "scored", """
    SELECT date_trunc('minute', created_at) AS window_start, round(avg(compound), 10) AS avg_compound,
           count(*) AS post_count FROM scored GROUP BY 1""")
def posts_by_minute(spark, sf):
    return rounded(sentiment.posts_per_minute(t.scored_posts(spark, sf)), "avg_compound", digits=10)


@query("score_gate", "scored", """
    SELECT error, rows FROM (SELECT 'null values in likes' AS error, count(*) AS rows FROM scored
    WHERE likes IS NULL OR likes = '7') WHERE rows > 0""")
def score_gate(spark, sf):
    scored = t.scored_posts(spark, sf).withColumn("likes", F.when(F.col("likes") != "7", F.col("likes")))
    return sentiment.check_scores(scored, ("likes", "compound"))


@query("slot_reject_reasons", "all_slots", """
    SELECT window_start, concat_ws(',', CASE WHEN NOT (compound_score * 3 BETWEEN -1 AND 1) THEN 'compound_range' END,
        CASE WHEN NOT (positive_ratio * 2 BETWEEN 0 AND 1) THEN 'positive_ratio_range' END) AS reasons
    FROM all_slots WHERE NOT (compound_score * 3 BETWEEN -1 AND 1) OR NOT (positive_ratio * 2 BETWEEN 0 AND 1)""")
def slot_reject_reasons(spark, sf):
    odd = t.all_slots(spark, sf).withColumns({"compound_score": F.col("compound_score") * 3,
                                              "positive_ratio": F.col("positive_ratio") * 2})
    _, rejected = quality.split_by_rules(odd, sentiment_rules())
    return rejected.select("window_start", F.array_join("reasons", ",").alias("reasons"))


@query("post_lake", "posts", """
    SELECT strftime(time_bucket(INTERVAL '12 hours', created_at), '%Y/%m/%d/%H_%M') AS folder,
           count(*) AS posts, CAST(sum(length(text)) AS BIGINT) AS chars FROM posts GROUP BY 1""")
def post_lake(spark, sf):
    """Posts written into dated folders, and the folders read back."""
    path = f"{shared_dir(spark)}/posts-{uuid.uuid4().hex}"
    sinks.post_lake(t.posts(spark, sf), path, t.SLOT)
    back = files.raw_posts(spark, path).select(
        "text", F.regexp_extract(F.col("_metadata.file_path"),
                                 r"year=(\d+)/month=(\d+)/day=(\d+)/slot=(\d+_\d+)", 0).alias("p"))
    folder = F.regexp_replace("p", r"(year|month|day|slot)=", "")
    return back.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("posts"),
                                                    F.sum(F.length("text")).alias("chars"))


@query("post_csv", "posts", """
    SELECT CAST(id AS VARCHAR) AS id, keyword AS source, 'harvest' AS keyword, likes FROM posts""")
def post_csv(spark, sf):
    """Posts exported as CSV and read back as a harvest."""
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    sinks.to_csv(t.posts(spark, sf).select("id", F.col("keyword").alias("source"), "likes", "text"), path)
    return files.harvested_csv(spark, path, "harvest", latest_only=False).select("id", "source", "keyword", "likes")


@query("newest_csv", "posts", """
    SELECT CAST(id AS VARCHAR) AS id, keyword AS source, 'harvest' AS keyword FROM posts WHERE lang = 'en'""")
def newest_csv(spark, sf):
    """Harvests of each language in folders of their own, the English one last; the newest counts. Rebalancing gives a folder
    files of bounded size, for each is written and read by one task."""
    path = f"{shared_dir(spark)}/harvests-{uuid.uuid4().hex}"
    posts = t.posts(spark, sf)
    for i, lang in enumerate(["de", "fr", "es", "en"]):
        rows = posts.where(F.col("lang") == lang).select("id", F.col("keyword").alias("source"), "text")
        rows.hint("rebalance").write.options(header="true", escape='"').csv(f"{path}/{i}")
        time.sleep(1.1)                                                                   # file times may be in whole seconds
    return files.harvested_csv(spark, f"{path}/*", "harvest", in_folders=True).select("id", "source", "keyword")


@query("sentiment_bands", "scored", """
    SELECT id, compound, CASE WHEN compound > 0.05 THEN 'positive' WHEN compound < -0.05 THEN 'negative' ELSE 'neutral' END AS band FROM scored""")
def sentiment_bands(spark, sf):
    return t.scored_posts(spark, sf).select("id", "compound", sentiment_sign("compound").alias("band"))
