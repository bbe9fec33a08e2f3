"""Preference formatting in built-in expressions: the common start of two conversations is the prompt.

A pair is a chosen and a rejected conversation. The turns they have in common at their start are
rendered once; what follows in either is a completion, with the spans a model is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: An opening is common if one in so many conversations has it, so there are at most that many common ones, whatever the table;
#: what they are chosen for is spread over so many parts.
COMMON, PARTS = 1000, 64
#: How a turn is written: before and after its text. The span trained on ends with the end mark.
HEAD, END = ("<|", "|>\n"), "<|end|>\n"
TRAINED = ("assistant",)


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): one row per conversation, an array of (turn, role, text) in order.

    Null roles and texts are empty, rows without a conversation are left out, rows that repeat count once;
    turns with one number are ordered by role and text. A conversation is one value by nature and is gathered.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return turns.where(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id")).agg(F.array_sort(F.collect_set(one)).alias("turns"))


def _last(turns: Column, role: str) -> Column:
    """Place of the last turn of a role, from 1; 0 if there is none."""
    back = F.array_position(F.transform(F.reverse(turns), lambda t: t["role"]), role)
    return F.when(back > 0, F.size(turns) + 1 - back).otherwise(F.lit(0)).cast("int")


def pairs_by_opening(convs: DataFrame, scratch: Scratch, common: int = COMMON) -> DataFrame:
    """(chosen_id, rejected_id, common) among conversations that agree up to their first user turn.

    Chosen is the one that ends with an answer, has the most characters of answers, and then the least id;
    every other one is rejected against it, so a group of any size gives one pair less than it has members.
    Openings that at least one in ``common`` conversations has are met where the conversations lie: their best ones, at
    most ``common`` rows, go to all tasks. Others have a bounded share and are met by a join.
    """
    place = F.array_position(F.transform("turns", lambda t: t["role"]), "user").cast("int")
    opening = F.transform(F.slice("turns", F.lit(1), place), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    answers = F.aggregate(F.filter("turns", lambda t: t["role"].isin(*TRAINED)), F.lit(0).cast("long"), lambda n, t: n + F.length(t["text"]))
    ends = F.element_at("turns", -1)["role"].isin(*TRAINED).cast("int")
    # one number of fixed width, so that the best is found by hashing: ends, twelve digits of characters, twenty of the id
    places = F.lit("100000000000000000000").cast("decimal(21,0)")
    rank = ((ends * F.lit(10**12) + answers).cast("decimal(13,0)") * places - F.col("conv_id").cast("decimal(20,0)")).cast("decimal(38,0)")
    ranked = scratch.keep(convs.where(place > 0).select("conv_id", F.sha2(F.to_json(opening), 256).alias("opening"), rank.alias("rank")), "ranked")
    best = scratch.keep(ranked.groupBy("opening").agg(F.max_by("conv_id", "rank").alias("chosen_id"), F.count("*").alias("n")).where("n > 1"), "best")
    often = F.col("n") * common >= ranked.count()
    hot, rest = F.broadcast(best.where(often).drop("n")), best.where(~often).drop("n")
    met = (ranked.join(hot, "opening").withColumn("common", F.lit(True))
           .union(ranked.join(hot.select("opening"), "opening", "left_anti").join(rest, "opening").withColumn("common", F.lit(False))))
    pairs = scratch.keep(met.where("conv_id <> chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"), "common"), "pairs")
    scratch.drop(ranked)
    scratch.drop(best)
    return pairs


def cut_answers(convs: DataFrame) -> DataFrame:
    """``convs`` that have an answer, with a column ``cut``: the turns with the last answer cut off in its middle, which is
    what a rejected answer may look like."""
    at = _last(F.col("turns"), TRAINED[0])
    cut = F.transform("turns", lambda t, i: F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"),
        F.when(i + 1 == at, F.substring(t["text"], F.lit(1), F.floor(F.length(t["text"]) / 2).cast("int"))).otherwise(t["text"]).alias("text")))
    return convs.where(at > 0).withColumn("cut", cut)


def with_turns(pairs: DataFrame, convs: DataFrame, parts: int = PARTS) -> DataFrame:
    """``pairs`` with ``chosen_turns`` and ``rejected_turns``. A conversation is rejected once at most; what is chosen for
    a common opening is copied ``parts`` times, and its pairs are dealt among the copies."""
    a, b = convs.toDF("chosen_id", "chosen_turns"), convs.toDF("rejected_id", "rejected_turns")
    both = pairs.join(b, "rejected_id")
    copies = (a.join(F.broadcast(pairs.where("common").select("chosen_id").distinct()), "chosen_id", "left_semi")
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    dealt = both.where("common").withColumn("part", F.pmod(F.xxhash64("rejected_id"), F.lit(parts)).cast("int"))
    return dealt.join(copies, ["chosen_id", "part"]).drop("part").unionByName(both.where("NOT common").join(a, "chosen_id")).drop("common")


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD[0]), t["role"], F.lit(HEAD[1]), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """Spans of trained turns in the rendered text, in code points: start-end, comma-joined."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    head = lambda t: F.length(t["role"]) + sum(map(len, HEAD))
    done = F.aggregate(turns, begin, lambda s, t: F.struct(
        (s["at"] + head(t) + F.length(t["text"]) + len(END)).alias("at"),
        F.when(t["role"].isin(*TRAINED), F.concat(s["spans"], F.array(F.concat_ws(
            "-", s["at"] + head(t), s["at"] + head(t) + F.length(t["text"]) + len(END))))).otherwise(s["spans"]).alias("spans")))
    return F.array_join(done["spans"], ",")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Render pairs: columns ``chosen_turns`` and ``rejected_turns`` become n_prefix, prompt, chosen, rejected,
    chosen_mask, rejected_mask; other columns stay. Turns agree when role and text do. Pairs without any
    difference express no preference and are left out."""
    a, b = F.col("chosen_turns"), F.col("rejected_turns")
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    differs = F.array_position(same, False).cast("int")
    rest = lambda t: F.slice(t, F.col("n_prefix") + 1, F.greatest(F.size(t) - F.col("n_prefix"), F.lit(0)))
    kept = [c for c in pairs.columns if c not in ("chosen_turns", "rejected_turns")]
    return pairs.where(differs > 0).withColumn("n_prefix", differs - 1).select(
        *kept, "n_prefix", _render(F.slice(a, F.lit(1), F.col("n_prefix"))).alias("prompt"), _render(rest(a)).alias("chosen"),
        _render(rest(b)).alias("rejected"), _mask(rest(a)).alias("chosen_mask"), _mask(rest(b)).alias("rejected_mask"))


def format_preferences(turns: DataFrame, common: int = COMMON) -> DataFrame:
    """(chosen_id, rejected_id, kind, n_prefix, prompt, chosen, rejected, chosen_mask, rejected_mask).

    ``kind`` is ``opening`` for two conversations with one opening and ``cut`` for a conversation against itself
    with its last answer cut (``rejected_id`` null). Ids are whole numbers. An empty table gives an empty result.
    """
    scratch = Scratch(turns.sparkSession, "preferences")
    convs = scratch.keep(conversations(turns), "conversations")
    of_two = with_turns(pairs_by_opening(convs, scratch, common), convs).withColumn("kind", F.lit("opening"))
    of_one = cut_answers(convs).select(
        F.col("conv_id").alias("chosen_id"), F.lit(None).cast(turns.schema["conv_id"].dataType).alias("rejected_id"),
        F.col("turns").alias("chosen_turns"), F.col("cut").alias("rejected_turns"), F.lit("cut").alias("kind"))
    return format_pairs(of_one.unionByName(of_two))
