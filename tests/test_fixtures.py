"""The stand-in tables."""

from pyspark.sql import functions as F

from checks import social
from checks import tables as t
from conftest import SF


def test_posts_of_documents_that_are_broadcast(spark, tmp_path):
    """The documents, cut to a few columns, are the small side of the join once the events outgrow them."""
    events = t.events(spark, SF)
    events.unionByName(events.withColumn("event_id", F.col("event_id") + events.count())).write.parquet(str(tmp_path / "events.parquet"))
    t.table(spark, SF, "documents").limit(40).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        found = t.raw_posts(spark, str(tmp_path)).agg(F.min("created_at").alias("a"), F.count("id").alias("n"))
        assert found.first()["n"] == 42
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_harvest_is_many_files(spark, tmp_path, monkeypatch):
    """The newest harvest is a folder; no task writes or reads all of it, and of the older ones nothing is read."""
    monkeypatch.setattr(social, "shared_dir", lambda _: str(tmp_path))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = social.newest_csv(spark, SF)
        assert len(found.inputFiles()) > 1 and all("/3/" in name for name in found.inputFiles())
        assert sorted(r["id"] for r in found.collect()) == sorted(
            str(r["id"]) for r in t.posts(spark, SF).where("lang = 'en'").select("id").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
