"""What filters take from each other: one table of failing ids per filter, semi and anti joins between them.

A filter is the relation of the ids that fail it. What a filter finds after others have run is what a
left-anti join with their relations leaves; what a left-semi join finds there, an earlier filter had taken. A sequence of
filters only matters as the set that came before, so the joins run once per set and filter, and
orders are put together from their counts. All joins meet on the id, in one partitioning.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Words, the marks of filter D, and the filters' limits.
WORD = r"[^\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
LEAST_WORDS, DISTINCT_SHARE, CAPITAL_SHARE = 200, 50, 2
#: Parts that the rows of one text are cut into before their least id is joined back to them.
SALTS = 64


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that one text decides; none is null. ``words`` is computed once for both uses."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    return {"A": n < LEAST_WORDS, "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_SHARE * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITAL_SHARE * F.length(text), "D": text.rlike(MARKS)}


def repeats(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Ids (``row``) of rows whose ``key`` also stands at a smaller ``order``. Rows of one key are cut into
    parts, so that many copies spread; a null order is neither smaller nor greater."""
    salted = rows.select("row", key, order, F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("_salt"))
    cells = salted.groupBy(key, "_salt").agg(F.min(order).alias("_low"))
    least = cells.groupBy(key).agg(F.min("_low").alias("_least"))
    return salted.join(cells.join(least, key).select(key, "_salt", "_least"), [key, "_salt"]).where(
        F.col(order) > F.col("_least")).select("row")


def _masks(n: int, without: Column | None = None) -> Column:
    """Sets of filters as bits; with ``without``, those that lack this one."""
    every = F.sequence(F.lit(0), F.lit((1 << n) - 1))
    return every if without is None else F.filter(every, lambda m: m.bitwiseAND(without) == 0)


def interactions(rows: DataFrame, failing: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """What every filter takes after every set of others, per ``part``.

    ``rows`` has (row, part, good, toxic), ``row`` unique and the last two boolean; ``failing`` maps a filter
    to the ids that fail it, each id once. Returns (part, before, kept), ``kept`` counting the rows that are left
    after the set ``before``, and (part, before, bit, removed, redundant, good_lost, toxic_lost) for each filter
    ``bit`` outside of it; absent rows count 0. The hash joins keep one partition of ids in memory, which the number of
    shuffle partitions bounds.
    """
    n = len(failing)
    ids = None
    for i, relation in enumerate(failing.values()):
        one = relation.select("row", F.lit(1 << i).alias("bit"))
        ids = one if ids is None else ids.unionByName(one)
    earlier = ids.select(F.col("row").alias("_row"), F.col("bit").alias("_bit")).hint("shuffle_hash")

    def taken(df: DataFrame) -> Column:
        return (df["row"] == earlier["_row"]) & (df["before"].bitwiseAND(earlier["_bit"]) != 0)

    # dealt before they are multiplied, so that only whole rows are shuffled
    dealt = rows.select("row", "part", "good", "toxic").repartition("row")
    sets = dealt.select("row", "part", F.explode(_masks(n)).alias("before"))
    kept = sets.join(earlier, taken(sets), "left_anti").groupBy("part", "before").agg(F.count(F.lit(1)).alias("kept"))
    failed = dealt.join(ids.withColumnRenamed("row", "_id").hint("shuffle_hash"), F.col("row") == F.col("_id")).select(
        "row", "part", "good", "toxic", "bit", F.explode(_masks(n, F.col("bit"))).alias("before"))
    keys = ("part", "before", "bit")
    removed = failed.join(earlier, taken(failed), "left_anti").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("removed"), F.lit(0).cast("long").alias("redundant"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost"))
    redundant = failed.join(earlier, taken(failed), "left_semi").groupBy(*keys).agg(
        F.lit(0).cast("long").alias("removed"), F.count(F.lit(1)).alias("redundant"), F.lit(0).cast("long").alias("good_lost"), F.lit(0).cast("long").alias("toxic_lost"))
    both = removed.unionByName(redundant).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("removed", "redundant", "good_lost", "toxic_lost")])
    return kept, both


def by_order(parts: DataFrame, kept: DataFrame, removals: DataFrame, names: str) -> DataFrame:
    """Every order of the filters step by step, zeros included, for each of ``parts`` (distinct ``part``)."""
    n, spark = len(names), parts.sparkSession
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, f in enumerate(order):
            steps.append(("".join(names[i] for i in order), step + 1, before, 1 << f))
            before |= 1 << f
    pairs = F.array(*[F.struct(F.lit(m).alias("before"), F.lit(1 << f).alias("bit")) for f in range(n) for m in range(1 << n) if not m >> f & 1])
    grid = parts.select("part", F.inline(pairs)).withColumn("after", F.col("before").bitwiseOR(F.col("bit")))
    grid = grid.join(removals, ["part", "before", "bit"], "left").join(
        kept.withColumnRenamed("before", "after"), ["part", "after"], "left").fillna(0, ["kept", "removed", "redundant", "good_lost", "toxic_lost"])
    # a set of s filters comes before this one in s! (n - 1 - s)! orders
    ways = F.element_at(F.array(*[F.lit(factorial(s) * factorial(n - 1 - s)) for s in range(n)]), F.bit_count("before") + 1)
    each = Window.partitionBy("part", "bit")
    grid = grid.withColumns({"shapley": F.sum(F.col("removed") * ways).over(each),
                             "unique_fails": F.max(F.when(F.bit_count("before") == n - 1, F.col("removed"))).over(each)})
    # n * n! rows, whatever the data
    plan = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, before int, bit int"))
    return grid.join(plan, ["before", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Filters A to E over ``docs`` in every order, one row per part, order and step.

    A: few words; B: few different words; C: many capitals; D: marks; E: the text stands at a smaller id. A null
    text is empty, a null part the part of the empty string, a row with a null id fails E never and has no
    labels. Repeated rows are documents of their own. An id is good if any of its labels has quality 1, toxic if any has toxic 1.
    Texts are read once and whole; beyond that only ids, parts and hashes move. An empty table gives an
    empty result; extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "filter-audit")
    whole = F.coalesce(F.col(text), F.lit(""))
    facts = scratch.keep(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("hash"), *[c.alias(n) for n, c in text_filters(whole).items()]), "facts")
    failing = {name: scratch.keep(facts.where(name).select("row"), f"fails-{name}") for name in "ABCD"}
    failing["E"] = scratch.keep(repeats(facts, "hash", "id"), "fails-E")
    known = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").cast("string").alias("_key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # rows without an id get a key of their own, so that they don't meet in one task
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("-"), F.col("row"), F.lit("-")))
    rows = scratch.keep(facts.select("row", "part", key.alias("_key")).join(known, "_key", "left").select(
        "row", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")), "rows")
    kept, removals = interactions(rows, failing)
    return by_order(rows.select("part").distinct(), kept, scratch.keep(removals, "removals"), "".join(failing))
