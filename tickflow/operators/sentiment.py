"""Posts: union, dedup, lexicon scoring, slot aggregation, stale carry-forward."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import SENTIMENT_CUT, first_present, ratio, slot_start
from ..plans.chunks import running
from .timejoin import time_series

# Names a scraped post may use, in order of preference.
TEXT_COLUMNS = ["full_text", "text", "tweet_text"]
LIKE_COLUMNS = ["favorite_count", "like_count", "likes"]
MIN_SAMPLE = 5
#: Normalisation constant of the published lexicon score sum / sqrt(sum^2 + alpha).
ALPHA = 15.0
WORD_BREAK = r"[^\p{L}]+"


def concat_posts(batches: list[DataFrame]) -> DataFrame:
    """One table from harvest batches with differing columns (missing ones are NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def dedup_posts(posts: DataFrame, key: str = "id", order: tuple[str, ...] = ("created_at", "keyword")) -> DataFrame:
    """First post of each id in ``order``; a table without the key is left alone.

    An aggregate, so copies are dropped before the shuffle: a group of copies of
    any size costs one row per task.
    """
    if key not in posts.columns:
        return posts
    rest = [c for c in posts.columns if c != key]
    return (posts.groupBy(key)
            .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
            .select(*[F.col(key) if c == key else F.col("_row").getField(c).alias(c) for c in posts.columns]))


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def score_posts(posts: DataFrame, lexicon: dict[str, float] | DataFrame, key: str = "id") -> DataFrame:
    """Add ``compound`` in -1..1 from word valences; whole texts are read.

    Words are joined to the lexicon and summed per post. The sum starts before the
    shuffle, in the task that split the text, so what is shuffled is about a row
    per post. ``key`` must be unique; the other columns group along with it, which
    keeps the sum a hash aggregate (carried as aggregates, texts would force a sort
    of all words).
    """
    text = first_present(posts.columns, TEXT_COLUMNS)
    if text is None:
        raise ValueError(f"none of {TEXT_COLUMNS} among {posts.columns}")
    if isinstance(lexicon, DataFrame):
        words = lexicon.select("word", "valence")
    else:
        # a literal list of rows has a size that Spark knows, so its own check decides on a broadcast
        listed = ", ".join(f"({_sql(w)}, {float(v)!r}D)" for w, v in lexicon.items()) or "('', 0.0D)"
        words = posts.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t(word, valence)")
    carried = [c for c in posts.columns if c not in (text, key)]
    tokens = posts.select(key, *carried, F.explode(
        F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_BREAK)).alias("word"))
    total = F.coalesce(F.sum("valence"), F.lit(0.0))
    scored = tokens.join(words, "word", "left").groupBy(key, *carried).agg(total.alias("_sum"))
    return (scored.withColumn("compound", F.round(F.col("_sum") / F.sqrt(F.col("_sum") * F.col("_sum") + ALPHA), 4))
            .select(key, *carried, "compound"))


def check_scores(scored: DataFrame, columns: tuple[str, ...] = ("compound",)) -> DataFrame:
    """Gate before storing: one row per broken rule, none when all is well."""
    tests = [(f"null values in {c}", F.col(c).isNull()) for c in columns]
    tests.append(("compound out of [-1, 1]", ~F.col("compound").between(-1, 1)))
    counts = scored.agg(*[F.count_if(cond).alias(name) for name, cond in tests])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("error"), F.col(f"`{n}`").alias("rows")) for n, _ in tests]))
    return counts.select(pairs.alias("r")).select("r.*").where("rows > 0")


def require_scores(scored: DataFrame, columns: tuple[str, ...] = ("compound",)) -> DataFrame:
    """``scored`` itself if it passes the gate, else an error naming what is wrong."""
    errors = [f"{r['error']} ({r['rows']} rows)" for r in check_scores(scored, columns).collect()]
    if errors:
        raise ValueError("; ".join(errors))
    return scored


def sentiment_slots(scored: DataFrame, slot: str = "30 minutes", min_sample: int = MIN_SAMPLE,
                    source_file: str | None = None) -> DataFrame:
    """Mean, ratios, like-weighted mean, count and quality flag per slot.

    A like count that is missing, no number or below 1 weighs 1.
    """
    likes = first_present(scored.columns, LIKE_COLUMNS)
    weight = (F.greatest(F.coalesce(F.col(likes).try_cast("double"), F.lit(1.0)), F.lit(1.0))
              if likes else F.lit(1.0))
    n = F.count(F.lit(1))
    pos = F.count_if(F.col("compound") > SENTIMENT_CUT)
    neg = F.count_if(F.col("compound") < -SENTIMENT_CUT)
    # scores have four decimals: whole units add up the same in any order
    units = F.round(F.col("compound") * 10_000).cast("bigint")
    span = F.window("created_at", slot)
    rows = (scored.withColumn("_w", span)
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    "compound", units.alias("_units"), weight.alias("_weight")))
    return (rows.groupBy("window_start", "window_end")
            .agg(F.round(F.sum("_units") / (n * 10_000), 4).alias("compound_score"),
                 F.round(pos / n, 4).alias("positive_ratio"), F.round(neg / n, 4).alias("negative_ratio"),
                 F.round((n - pos - neg) / n, 4).alias("neutral_ratio"),
                 F.round(ratio(F.sum(F.col("_units") * F.col("_weight")), F.sum("_weight") * 10_000), 4)
                 .alias("weighted_compound"),
                 n.alias("post_count"),
                 F.when(n < min_sample, "low_sample").otherwise("ok").alias("data_quality"))
            .withColumn("source_file", F.lit(source_file).cast("string")))


def carry_stale(slots: DataFrame, slot: str, block: str) -> DataFrame:
    """Fill missing slots between the first and the last with the latest slot that
    was not stale itself, flagged ``stale``; rows that exist are kept as they are."""
    values = ["compound_score", "positive_ratio", "negative_ratio", "neutral_ratio",
              "weighted_compound", "post_count"]
    grid = time_series(slots, "window_start", slot, block)
    rows = grid.join(slots, "window_start", "left")
    fresh = F.when(F.col("data_quality").isNotNull() & (F.col("data_quality") != "stale"), F.struct(*values))
    filled = running(rows, [], ["window_start"], {"_last": ("last", fresh)}, width=block)
    missing = F.col("data_quality").isNull()
    return (filled.where(~missing | F.col("_last").isNotNull())
            .select("window_start", (F.col("window_start") + F.expr(f"INTERVAL {slot}")).alias("window_end"),
                    *[F.when(missing, F.col("_last").getField(v)).otherwise(F.col(v)).alias(v) for v in values],
                    F.when(missing, "stale").otherwise(F.col("data_quality")).alias("data_quality")))


def mark_stale(slots: DataFrame, failed: DataFrame) -> DataFrame:
    """Flag slots whose run failed: an existing row only changes its quality flag."""
    hit = failed.select("window_start", F.lit(True).alias("_failed")).distinct()
    return (slots.join(hit, "window_start", "left")
            .withColumn("data_quality", F.when(F.col("_failed"), "stale").otherwise(F.col("data_quality")))
            .drop("_failed").select(*slots.columns))


def posts_per_minute(scored: DataFrame, width: str = "1 minute") -> DataFrame:
    return (scored.groupBy(slot_start("created_at", width).alias("window_start"))
            .agg(F.avg("compound").alias("avg_compound"), F.count(F.lit(1)).alias("post_count")))
