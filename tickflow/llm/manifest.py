"""Merkle manifest of a dataset by windows: per level, lag and lead columns give a node its siblings.

Rows of a group are numbered without one task seeing the group: a range shuffle, counts per
range, and row numbers inside. A window then holds one chunk of a level's numbered nodes. Columns
at fixed offsets before and after a node are masked by its slot in its run and by the run's length;
what is left is its siblings, and the first node of a run hashes the run into the parent. A level
is an eighth of the one below. From the top down, a node's proof is its siblings and the proof of its parent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Nodes that share a parent.
FAN = 8
#: Nodes in one window, a multiple of FAN.
CHUNK = 4096
# The fields of a leaf, in order; every third id by CRC-32 is tampered with.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows of values read alike; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its ``proof``, level by level, lead to."""
    return F.aggregate(proof, leaf, lambda h, s: digest(s["left"], h, s["right"]))


def _numbered(rows: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``pos``, the place within ``gid`` by ``order``, and ``n``, the rows of ``gid``."""
    # ranges come from a sample, so they are written before they are counted and read again
    placed = scratch.keep(rows.repartitionByRange("gid", *order).withColumn("_range", F.spark_partition_id()), "placed")
    counts = placed.groupBy("gid", "_range").agg(F.count(F.lit(1)).alias("_in"))
    group = Window.partitionBy("gid")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("gid", "_range", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_start"), F.sum("_in").over(group).alias("n"))
    local = F.row_number().over(Window.partitionBy("gid", "_range").orderBy(*order)) - 1
    return placed.withColumn("_local", local).join(starts, ["gid", "_range"]).withColumn(
        "pos", F.col("_start") + F.col("_local")).drop("_range", "_local", "_start")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``left`` and ``right``: digests of the run's other nodes before and after a node, put together."""
    chunk = Window.partitionBy("gid", F.floor(F.col("pos") / CHUNK)).orderBy("pos")
    slot = F.col("pos") % FAN
    length = F.least(F.lit(FAN), F.col("n") - F.col("pos") + slot)
    before = [F.when(slot >= k, F.lag("digest", k).over(chunk)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(chunk)) for k in range(1, FAN)]
    return nodes.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)})


def _grow(nodes: DataFrame, scratch: Scratch) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels from ``nodes`` (gid, pos, n, digest, ...) up: per level, the nodes of groups with several
    nodes left, with siblings, and the nodes that are the last of their group."""
    levels, tops = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        tops.append(nodes.where("n = 1"))
        if most <= 1:
            return levels, tops
        level = scratch.keep(_with_siblings(nodes.where("n > 1")), f"level{len(levels)}")
        levels.append(level)
        nodes = level.where(f"pos % {FAN} = 0").select(
            "gid", F.expr(f"pos DIV {FAN}").alias("pos"), F.expr(f"(n + {FAN - 1}) DIV {FAN}").alias("n"),
            digest(F.col("digest"), F.col("right")).alias("digest"))
        most = -(-most // FAN)


def _descend(levels: list[DataFrame], tops: list[DataFrame], above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Proofs of the lowest nodes. ``above`` has (gid, rest, subroot) for each group, ``rest`` the proof of its last node."""
    def ended(k: int) -> DataFrame:
        return tops[k].join(above, "gid").withColumnRenamed("rest", "proof")

    columns = ["gid", "pos", "proof", "subroot"]
    known = ended(len(levels)).select(*(columns if levels else [*columns, *carried]))
    for k in range(len(levels) - 1, -1, -1):
        extra = list(carried) if k == 0 else []
        parents = known.select("gid", F.col("pos").alias("_up"), F.col("proof").alias("_rest"), "subroot")
        own = F.array(F.struct("left", "right"))
        met = levels[k].withColumn("_up", F.expr(f"pos DIV {FAN}")).join(parents, ["gid", "_up"]).withColumn(
            "proof", F.concat(own, F.col("_rest")))
        known = met.select(*columns, *extra).unionByName(ended(k).select(*columns, *extra))
    return known


def prove(rows: DataFrame, leaf: Column, group: str, order: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """(``carry`` columns, leaf, subroot, root, proof) for every row; ``proof`` is an array of (left, right).

    Within ``group`` the leaves ascend by ``order``, null first, then by leaf. While several nodes
    are left, every eight in order, the last ones fewer, become their digest; the last is the group's subroot.
    Subroots by group, null first, then by bytes, give the root alike. Repeated rows are leaves of
    their own; a single row is its own root, with an empty proof; an empty table gives an empty result.
    No task holds a whole group. A proof grows with the logarithm of the rows.
    """
    scratch = Scratch(rows.sparkSession, "manifest")
    carry = carry or {}
    leaves = scratch.keep(rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("gid"), F.col(order).alias("_order"),
        leaf.alias("digest"), F.monotonically_increasing_id().alias("_row"), *[c.alias(n) for n, c in carry.items()]), "leaves")
    # equal leaves may change places; the last key only lets many of them fall into several ranges
    levels, tops = _grow(_numbered(leaves, ["_order", "digest", "_row"], scratch), scratch)
    subroots = tops[0].select("gid", "digest")
    for top in tops[1:]:
        subroots = subroots.unionByName(top.select("gid", "digest"))
    subroots = scratch.keep(subroots, "subroots")
    heads = _numbered(subroots.select(F.lit("").alias("gid"), F.col("gid").alias("_order"), "digest", F.col("gid").alias("_group")), ["_order"], scratch)
    upper, ends = _grow(heads, scratch)
    last = ends[-1].select("digest").first()
    root = F.lit(last[0] if last else None).cast("string")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    start = rows.sparkSession.range(1).select(F.lit("").alias("gid"), nothing.alias("rest"), F.lit("").alias("subroot"))
    above = _descend(upper, ends, start, ["_group", "digest"])
    above = scratch.keep(above.select(F.col("_group").alias("gid"), F.col("proof").alias("rest"), F.col("digest").alias("subroot")), "proofs")
    proofs = _descend(levels, tops, above, [*carry, "digest"])
    return proofs.select(*carry, F.col("digest").alias("leaf"), "subroot", root.alias("root"), "proof")


def verify(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", text: str = "text",
           one_in: int = TAMPERED) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every document.

    The manifest is of the documents as they are. Where ``one_in`` divides the CRC-32 of the id, the text is
    tampered with: its A-Z become small. Its leaf, with the siblings of the original, then leads to another
    root, unless the text has no such letter. A null id is not tampered with; null fields are part of the leaf as
    such, so a null and an empty text differ; empty and very long texts are hashed whole. Only digests are
    shuffled, no text. Extra columns are ignored.
    """
    values = [F.col(c) for c in fields]
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == text else F.col(c) for c in fields]
    hit = F.crc32(F.col(order).cast("string").cast("binary")) % one_in == 0
    found = prove(docs, leaf_of(*values), group, order, {"doc_id": F.col(order), "_changed": F.when(hit, leaf_of(*changed))})
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    found = found.withColumn("folded_root", fold(F.coalesce("_changed", "leaf"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))
