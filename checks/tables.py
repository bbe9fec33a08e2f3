"""The library's tables, derived from the given test tables (definitions in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tickflow.functions.scalar import slot_start
from tickflow.operators.bars import tick_bars
from tickflow.operators.rolling import rolling_features
from tickflow.operators.sentiment import dedup_posts, score_posts, sentiment_slots
from tickflow.schemas import BARS

BAR = "6 hours"
SLOT = "12 hours"
#: 120 bars a symbol in the test tables, so several chunks and their seams are in play.
CHUNK_ROWS = 32
#: The test prices jump by factors of thousands, too far for the usual volatility column.
BAR_SCHEMA = StructType([StructField(f.name, DoubleType()) if f.name == "volatility" else f for f in BARS])
MIN_SAMPLE = 16

# A small lexicon of words the test documents hold.
LEXICON = {
    "the": 0.5, "of": -0.5, "and": 0.25, "to": -0.25, "a": 0.5, "in": 1.5, "en": -1.5, "it": 2.0,
    "was": -2.0, "as": 1.0, "for": -1.0, "la": 0.75, "de": -0.75, "es": 1.25, "er": -1.25, "ly": 2.5,
    "thon": -2.5, "ble": 3.0, "thnt": -3.0,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def ticks(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("ts").alias("event_time"), F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"))


def bars(spark, sf_dir) -> DataFrame:
    return tick_bars(ticks(spark, sf_dir), BAR)


def features(spark, sf_dir) -> DataFrame:
    return rolling_features(bars(spark, sf_dir), BAR, chunk_rows=CHUNK_ROWS)


def raw_posts(spark, sf_dir) -> DataFrame:
    """Posts with every twentieth one harvested twice, an hour apart."""
    docs = table(spark, sf_dir, "documents")
    ev = events(spark, sf_dir)
    # so that every document finds an event; a number, for Spark cannot broadcast rows under a key that holds a subquery
    n = max(ev.count(), 1)
    posts = (docs.join(ev, ev.event_id == F.pmod(docs.doc_id * 10, n))
             .select(F.col("ts").alias("created_at"), F.col("doc_id").alias("id"), "text", "lang",
                     F.col("source").alias("keyword"), F.get_json_object("props", "$.k").alias("likes")))
    again = (posts.where("id % 20 = 0")
             .withColumn("created_at", F.expr("created_at + INTERVAL 1 HOUR"))
             .withColumn("keyword", F.concat("keyword", F.lit("-again"))))
    return posts.unionByName(again)


def posts(spark, sf_dir) -> DataFrame:
    return dedup_posts(raw_posts(spark, sf_dir))


def scored_posts(spark, sf_dir) -> DataFrame:
    return score_posts(posts(spark, sf_dir), LEXICON)


def all_slots(spark, sf_dir) -> DataFrame:
    return sentiment_slots(scored_posts(spark, sf_dir), SLOT, min_sample=MIN_SAMPLE)


def slot_index(start):
    """Half-days since the epoch; the test days start at midnight."""
    return (F.datediff(start, F.lit("1970-01-01").cast("date")) * 2
            + F.when(F.hour(start) >= 12, 1).otherwise(0))


def slots(spark, sf_dir) -> DataFrame:
    """Sentiment slots with every ninth missing."""
    return all_slots(spark, sf_dir).where(slot_index(F.col("window_start")) % 9 != 0)


def predictions(spark, sf_dir) -> DataFrame:
    """Rolling volatility taken as the prediction of the next five bars."""
    f = features(spark, sf_dir).where("rolling_vol IS NOT NULL")
    return f.select("symbol", "window_start", F.col("rolling_vol").alias("predicted_vol"), "rolling_vol",
                    F.concat(F.lit("v"), (F.hour("window_start") / 6 % 3 + 1).cast("int").cast("string"))
                    .alias("model_version"),
                    (F.col("trade_count") % 66 + 15).cast("int").alias("inference_latency_ms"))


def app_logs(spark, sf_dir) -> DataFrame:
    kind = F.col("event_type")
    return events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("svc"), (F.col("user_id") % 8).cast("string")).alias("service"),
        F.when(kind == "error", "ERROR").when(kind == "purchase", "WARNING").otherwise("INFO").alias("level"),
        F.col("props").alias("message"), F.col("event_id").alias("log_id"))


def runs(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    finished = F.when(F.col("o_orderkey") % 41 != 0,
                      F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 300).cast("decimal(18,6)")))
    status = (F.when(F.col("o_orderstatus") == "O", "ok").when(F.col("o_orderstatus") == "F", "failed")
              .otherwise("promoted"))
    return o.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("pipeline_name"),
        status.alias("quality_status"), F.col("o_totalprice").cast("bigint").alias("rows_processed"),
        (F.col("o_custkey") % 50).alias("rows_rejected"),
        F.col("o_orderdate").alias("started_at"), finished.alias("finished_at"),
        F.to_json(F.struct((F.col("o_orderkey") % 13).alias("checks_passed"),
                           (F.col("o_custkey") % 5).alias("checks_failed"))).alias("params"))


def container_metrics(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("ts").alias("time"),
        F.concat(F.lit("c"), (F.col("user_id") % 12).cast("string")).alias("container_name"),
        F.least(F.col("value"), F.lit(100.0)).alias("usage_percent"),
        F.when(F.col("event_type") == "error", "exited")
        .when(F.col("event_type") == "signup", "restarting").otherwise("running").alias("status"),
        F.col("event_id").alias("metric_id"))


def audit_old(spark, sf_dir) -> DataFrame:
    return (table(spark, sf_dir, "orders").where("o_orderkey % 10 <> 0")
            .select("o_orderkey", "o_orderstatus", "o_totalprice"))


def audit_new(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0")
    return o.select("o_orderkey", "o_orderstatus",
                    F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1)
                    .otherwise(F.col("o_totalprice")).alias("o_totalprice"))


def registry(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("version"), (F.col("p_retailprice") / 650000).alias("mae"))


def lineage(spark, sf_dir) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.lit("region").alias("source_table"), F.col("r_name").alias("source_column"),
                    F.lit("nation").alias("target_table"), F.col("n_name").alias("target_column")))


def sparse_orders(spark, sf_dir) -> DataFrame:
    """Orders with their customers; of the order columns one lacks half its values, one a twentieth."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 2 == 1, F.col("o_totalprice")),
        "o_orderpriority": F.when(F.col("o_orderkey") % 20 != 0, F.col("o_orderpriority"))})
    return c.join(o, c.c_custkey == o.o_custkey, "left").drop("o_custkey")


def slotted(df: DataFrame, time: str, width: str, name: str) -> DataFrame:
    return df.withColumn(name, slot_start(time, width))
