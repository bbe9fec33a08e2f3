"""Mix sources to target weights by pivotal rounding, in built-in expressions only.

Every document of a source is wanted ``target / source_size`` times. The whole part is fixed;
the fractional parts meet in pairs: one document hands words to the other until the probability
of one of them is 0 or 1, with chances that keep every expectation. Blocks of documents round
among themselves and pass one residual on; residuals meet again in blocks of the next level, up
to one per source. So the words of a source miss its target by less than one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Fixed value: `[^\x20\x09-\x0D]+`.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
#: Documents that meet in one block, on average.
BLOCK = 32
SEED = 20240501


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target). Sources by code point, null last, weigh ``weights`` in turn and
    share ``share`` times all words; a target stops at ``most`` times its source's size and the excess
    is shared anew by weight, which ends at one level per weight for all sources not stopped. Window
    functions over one row per source."""
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(turn, F.lit(len(weights))) + 1))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    # ordered by the level at which they stop, sources before the first that does not stop are stopped
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumn("left", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    per = per.withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    per = per.withColumn("level", F.col("left") / F.col("w_left"))
    per = per.withColumn("stops", F.col("cap") / F.col("w") < F.col("level"))
    level = F.first(F.when(~F.col("stops"), F.col("level")), ignorenulls=True).over(
        rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.select("source", "source_size", F.when(F.coalesce("stops", F.lit(False)) | level.isNull(), F.col("cap"))
                      .otherwise(F.least(F.col("cap"), level * F.col("w"))).alias("target"))


def _uniform(*key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _item(i: Column, p: Column, s: Column) -> Column:
    return F.struct(i.alias("i"), p.alias("p"), s.alias("s"))


def _meet(state: Column, x: Column) -> Column:
    """The document carried so far meets the next: words move one way or the other until one
    probability is 0 or 1. That one is done; the other is carried on."""
    c, p, s, q, r = state["carry"], state["carry"]["p"], state["carry"]["s"], x["p"], x["s"]
    give = F.least(p * s, (1 - q) * r)  # words the carried one can hand over
    take = F.least(q * r, (1 - p) * s)
    first = p * s <= (1 - q) * r  # handing over empties the carried one, else it fills the next
    other = q * r <= (1 - p) * s
    gives = x["u"] * (give + take) < take
    done = (F.when(gives & first, _item(c["i"], F.lit(0.0), s)).when(gives, _item(x["i"], F.lit(1.0), r))
            .when(other, _item(x["i"], F.lit(0.0), r)).otherwise(_item(c["i"], F.lit(1.0), s)))
    held = (F.when(gives & first, _item(x["i"], q + give / r, r)).when(gives, _item(c["i"], p - give / s, s))
            .when(other, _item(c["i"], p + take / s, s)).otherwise(_item(x["i"], q - take / r, r)))
    started = F.struct(state["done"].alias("done"), _item(x["i"], q, r).alias("carry"))
    return F.when(c.isNull(), started).otherwise(F.struct(F.concat(state["done"], F.array(done)).alias("done"), held.alias("carry")))


def _round_level(items: DataFrame, level: int, block: int, seed: int) -> DataFrame:
    """One level: (source, i, p, s, open). What a block is left with is open if it lies between 0 and 1."""
    kind = items.select(_item(F.col("i"), F.col("p"), F.col("s")).alias("x")).schema["x"].dataType.simpleString()
    counts = items.groupBy(F.col("source").alias("_source")).agg(F.ceil(F.count("*") / block).alias("_blocks"))
    items = items.join(counts, F.col("source").eqNullSafe(F.col("_source")))
    x = F.struct(_uniform(F.lit(seed), F.lit(2 * level), "i", "source").alias("u"), "i", "p", "s")
    where = F.pmod(F.xxhash64(F.lit(seed), F.lit(2 * level + 1), "i", "source"), F.col("_blocks"))
    blocks = items.groupBy("source", where.alias("_block")).agg(F.array_sort(F.collect_list(x)).alias("xs"))
    start = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("carry"))
    met = blocks.select("source", F.aggregate("xs", start, _meet).alias("m"))
    both = F.concat(F.transform("m.done", lambda d: F.struct(d.alias("d"), F.lit(False).alias("open"))), F.array(F.struct(
        F.col("m.carry").alias("d"), ((F.col("m.carry.p") > 0) & (F.col("m.carry.p") < 1)).alias("open"))))
    return met.select("source", F.explode(both).alias("x")).select("source", "x.d.i", "x.d.p", "x.d.s", "x.open")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        share: float = SHARE, most: float = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, n, source_size, target, copies): one row per different (doc_id, source, size).

    ``n`` counts the rows that agree in all three; they are rounded together, as one item of their
    common size, and get the same copies. Null and empty texts have size 0 and no copies; a null
    source is a source, a null id an id. Every choice comes from a hash of the row's values and
    ``seed``, so reruns agree. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size"))
    sizes = scratch.keep(slim.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    goal = targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ratio = F.when(F.abs(ratio - F.round(ratio)) < 1e-9, F.round(ratio)).otherwise(ratio)  # a full target has no fraction
    wanted = scratch.keep(sizes.join(goal, sizes["source"].eqNullSafe(goal["_source"])).select(
        "doc_id", "source", "size", "n", "source_size", "target", F.floor(ratio).alias("whole"), (ratio - F.floor(ratio)).alias("part")), "wanted")
    scratch.drop(sizes)
    items = wanted.where("part > 0 AND size > 0").select(
        "source", F.struct("doc_id", "size").alias("i"), F.col("part").alias("p"), (F.col("size") * F.col("n")).cast("double").alias("s"))
    rounded, level = None, 0
    while True:
        largest = items.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if largest <= 1:
            break
        step = scratch.keep(_round_level(items, level, block, seed), f"level{level}")
        done = step.where(~F.col("open"))
        rounded = done if rounded is None else rounded.unionByName(done)
        items, level = step.where("open").drop("open"), level + 1
    # the residual of a source is rounded alone
    last = items.select("source", "i", (_uniform(F.lit(seed), F.lit(-1), "i", "source") < F.col("p")).cast("double").alias("p"), "s")
    last = last.withColumn("open", F.lit(False))
    rounded = last if rounded is None else rounded.unionByName(last)
    ups = rounded.where("p = 1").select(F.col("source").alias("_source"), F.col("i.doc_id").alias("_doc_id"), F.col("i.size").alias("_size"))
    same = (F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
    out = wanted.join(ups, same, "left")
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("_size").isNotNull().cast("long")).otherwise(F.lit(0).cast("long"))
    return out.select("doc_id", "source", "size", "n", "source_size", "target", copies.alias("copies"))


def plan_of(docs: DataFrame) -> DataFrame:
    """The result columns of the registered query: a row per row of ``docs``."""
    plan = mix(docs).withColumn("_1", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it was taken, numbered in ``copy``.

    Null and empty texts have no words and are not taken; rows with the same id, source and size are taken together; an empty
    table gives an empty mix. A column of ``docs`` named ``copy`` is replaced, others stay.
    """
    columns = [c for c in docs.columns if c != "copy"]
    plan = mix(docs, **how).where("copies > 0").select(
        F.col("doc_id").alias("_doc_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies")
    sized = docs.select(*columns, words(F.col("text")).alias("_words"))
    same = (F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size")))
    return sized.join(plan.withColumnRenamed("copies", "_copies"), same).select(
        *columns, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("copy"))
