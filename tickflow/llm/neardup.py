"""Near-duplicate groups by a multi-index Hamming join of b-bit MinHash signatures.

A signature has 48 symbols of 16 bits in 12 chunks of 4. Two signatures that differ in at most
23 symbols have a chunk with at most one difference, so with each chunk indexed under its four
ways to leave a symbol out, every such pair meets under a key of three symbols. Sets that are 75 %
alike miss all chunks with a chance of 1e-7. Whatever meets is compared by 4-bit symbols, and what
is near enough by its full sets.

A key's bucket is never paired with itself. First every member meets the bucket's least member;
confirmed links give components. Buckets with members of several components are then compared in
blocks inside tasks by symbols. The members left are grouped by what hangs together, as long as that fits a block, and compared
by full sets; a task gives back one link for two components. So a group of copies of any size costs a few rows per copy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .memories import only, remembers
from .scratch import Scratch
from .shipping import ship
from .slicing import by_bytes

SHINGLE, PERCENT = 5, 75
CHUNKS, CHUNK = 12, 4
SYMBOLS = CHUNKS * CHUNK
#: 4-bit symbols in which candidates may differ: 11.25 are expected at 75 %, six deviations are 17.6.
NEAR = 29
#: Members of a bucket in one block, and their shingles, on average; a task holds two blocks.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
#: Words hashed at once, and words remembered by a worker.
BATCH_WORDS, REMEMBERED = 400_000, 500_000

_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_known_words: dict[bytes, int] = {}
remembers("neardup", _known_words.clear)


def words(text: bytes | None) -> list[bytes]:
    r"""`[^\x20\x09-\x0D]+` after lower-casing A-Z, on UTF-8: the white space of bytes.split."""
    return text.lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    known = _known_words
    if len(known) > REMEMBERED:
        known.clear()
    out = list(map(known.get, tokens))
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                w = tokens[i]
                h = known.get(w)
                if h is None:
                    h = known[w] = xxhash.xxh3_64_intdigest(w)
                out[i] = h
    return np.array(out, dtype=np.uint64)


def shingle_sets(texts: list[bytes | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes; a shorter text is one shingle, no words give none."""
    sets: list[np.ndarray] = []
    tokens = [words(t) for t in texts]
    first = 0
    while first < len(tokens):
        last, total = first, 0
        while last < len(tokens) and (last == first or total + len(tokens[last]) <= BATCH_WORDS):
            total += len(tokens[last])
            last += 1
        hashes = word_hashes([w for t in tokens[first:last] for w in t])
        rolled = np.zeros(max(0, len(hashes) - shingle + 1), dtype=np.uint64)
        for k in range(shingle):
            rolled = rolled * _STEP + hashes[k:k + len(rolled)]
        rolled = mixed(rolled)
        at = 0
        for t in tokens[first:last]:
            n = len(t)
            if n >= shingle:
                sets.append(np.unique(rolled[at:at + n - shingle + 1]))
            elif n:
                whole = np.full(1, n, dtype=np.uint64)
                for k in range(at, at + n):
                    whole = whole * _STEP + hashes[k:k + 1]
                sets.append(mixed(whole))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))
            at += n
        first = last
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit symbols, one row per non-empty set."""
    sets = [s for s in sets if len(s)]
    if not sets:
        return np.zeros((0, SYMBOLS), dtype=np.uint64)
    every = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), SYMBOLS), dtype=np.uint64)
    for k, a in enumerate(_MULTIPLIERS):
        out[:, k] = np.minimum.reduceat(every * a, starts)
    return mixed(out) & np.uint64(0xFFFF)


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """The keys of each signature: every chunk with each of its symbols left out."""
    keys = []
    for c in range(CHUNKS):
        chunk = symbols[:, c * CHUNK:(c + 1) * CHUNK]
        for gone in range(CHUNK):
            key = np.full(len(symbols), c * CHUNK + gone + 1, dtype=np.uint64)
            for j in range(CHUNK):
                if j != gone:
                    key = (key << np.uint64(16)) | chunk[:, j]
            keys.append(mixed(key))
    return np.stack(keys, axis=1)


def sketches(symbols: np.ndarray) -> np.ndarray:
    """The low four bits of all symbols, sixteen to a long."""
    low = symbols & np.uint64(15)
    out = np.zeros((len(symbols), SYMBOLS // 16), dtype=np.uint64)
    for k in range(SYMBOLS):
        out[:, k // 16] |= low[:, k] << np.uint64(4 * (k % 16))
    return out


def _parts(texts: list, size: int = 4 << 20):
    """Consecutive slices of a batch with about ``size`` bytes of text each."""
    first, total = 0, 0
    for i, t in enumerate(texts):
        if i > first and total + len(t or b"") > size:
            yield first, i
            first, total = i, 0
        total += len(t or b"")
    if first < len(texts):
        yield first, len(texts)


def _sign(batches):
    only("neardup")
    for batch in by_bytes(batches, 2, 4 << 20):
        texts = batch.column(2).to_pylist()
        for a, b in _parts(texts):
            sets = shingle_sets(texts[a:b])
            symbols = signatures(sets)
            full = np.array([len(s) > 0 for s in sets])
            nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
            keys = index_keys(symbols).view(np.int64)
            ends = np.concatenate(([0], np.cumsum(np.where(full, keys.shape[1], 0)))).astype(np.int32)
            place = np.cumsum(full) - 1
            marks = sketches(symbols).view(np.int64)
            columns = [pa.array(np.where(full, marks[place, k] if len(marks) else 0, 0)) for k in range(marks.shape[1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(nodes),
                 pa.array([len(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())), *columns],
                names=["doc_id", "text_key", "node", "n_shingles", "keys", *[f"s{k}" for k in range(marks.shape[1])]])


def _pack(batches):
    pack = zstandard.ZstdCompressor(level=1).compress
    only("neardup")
    for batch in by_bytes(batches, 2, 4 << 20):
        bodies = pa.array([pack(t or b"") for t in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bodies], names=["doc_id", "text_key", "body"])


def _confirm(batches):
    """Keep the pairs whose full sets are alike enough."""
    unpack = zstandard.ZstdDecompressor().decompress
    held: tuple = (None, None)
    for batch in batches:
        us, vs, bu, bv = (batch.column(k).to_pylist() for k in range(4))
        keep = []
        for u, x, y in zip(us, bu, bv):
            if held[0] != u:
                held = (u, shingle_sets([unpack(x)])[0])
            other = shingle_sets([unpack(y)])[0]
            both = len(np.intersect1d(held[1], other, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(held[1]) + len(other) - both))
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _groups(batches, n_keys: int):
    """Rows of Arrow batches, grouped by their first columns; the batches are sorted by these."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def _open_pairs(components_: np.ndarray, sides: np.ndarray, across: bool) -> np.ndarray:
    """Which members may still have to be linked: of different components, and of different blocks where two meet."""
    pairs = components_[:, None] != components_[None, :]
    return pairs & (sides[:, None] != sides[None, :]) if across else pairs


def _nominate(batches):
    """Of each pair of blocks, the members near enough to one of another component. Groups of the same members, met
    under several keys, get the same name."""
    out: list[tuple] = []
    for (_, i, j), rows in _groups(batches, 3):
        node, comp, side, n = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(4))
        near = _open_pairs(comp, side, i != j) & (100 * np.minimum(n[:, None], n[None, :]) >= PERCENT * np.maximum(n[:, None], n[None, :]))
        if near.any():
            symbols = [np.array([r[4 + k] for r in rows], dtype=np.int64).view(np.uint64) for k in range(SYMBOLS // 16)]
            for at in range(0, len(rows), 128):  # a strip of the pairs at a time
                differing = np.zeros(near[at:at + 128].shape, dtype=np.uint8)
                for mark in symbols:
                    x = mark[at:at + 128, None] ^ mark[None, :]
                    x |= x >> np.uint64(2)
                    x |= x >> np.uint64(1)
                    differing += np.bitwise_count(x & np.uint64(0x1111111111111111))
                near[at:at + 128] &= differing <= NEAR
            chosen = near.any(axis=1)
            # sides matter where two blocks meet
            members = sorted(zip(node[chosen].tolist(), comp[chosen].tolist(), (side[chosen] == j).tolist() if i != j else [False] * int(chosen.sum())))
            name = xxhash.xxh3_64_intdigest(repr((i != j, members))) - (1 << 63)
            out += [(name, v, c, s, i != j) for v, c, s in members]
        if len(out) >= 20_000:
            yield _nominated(out)
            out = []
    yield _nominated(out)


def _nominated(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["name", "node", "c", "side", "across"])


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of slices of their incidence matrix."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(every, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    common = times[at] > 1
    owner, at = owner[common], number[at[common]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for first in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
        a, b = np.searchsorted(at, (first, first + columns))
        part = np.zeros((len(sets), columns), dtype=np.float32)
        part[owner[a:b], at[a:b] - first] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _compare(batches):
    """Links between members of different components, confirmed on full sets: one for two components of a group."""
    unpack = zstandard.ZstdDecompressor().decompress
    out: list[tuple] = []
    for _, rows in _groups(batches, 2):
        node, comp, side = (np.array([r[k] for r in rows]) for k in range(3))
        sets = shingle_sets([unpack(r[4]) for r in rows])
        n = np.array([len(s) for s in sets], dtype=np.int64)
        both = intersections(sets)
        linked = _open_pairs(comp, side, rows[0][3]) & (100 * both >= PERCENT * (n[:, None] + n[None, :] - both))
        found = {}
        for x, y in zip(*np.nonzero(np.triu(linked))):
            found.setdefault((min(comp[x], comp[y]), max(comp[x], comp[y])), (int(node[x]), int(node[y])))
        out += found.values()
        if len(out) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(2)], names=["u", "v"])
            out = []
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(2)], names=["u", "v"])


def _differing(a: str, b: str) -> Column:
    """4-bit symbols in which two sketches differ."""
    total = None
    for k in range(SYMBOLS // 16):
        x = F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111))
        total = F.bit_count(x) if total is None else total + F.bit_count(x)
    return total


def _near(a: str, b: str) -> Column:
    """What pairs that are alike enough always (sizes) or all but always (sketches) meet."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (_differing(a, b) <= NEAR)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when the intersection of their sets of five-word shingles is at least 75 % of
    the union. ``component_id`` is the least id reachable by links, ``kept`` marks the document that
    bears it. Null and empty texts have empty sets and no links. Repeated rows get equal results, rows
    with a null id are linked but give no component its id (null where no member has one). Extra
    columns are ignored; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "neardup")
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).cast("binary").alias("text"))
    marks = [f"s{k}" for k in range(SYMBOLS // 16)]
    signed = scratch.keep(rows.mapInArrow(_sign, f"doc_id {kind}, text_key bigint, node bigint, n_shingles bigint, keys array<bigint>, "
                                          + ", ".join(f"{m} bigint" for m in marks)), "signed")
    some = signed.where("n_shingles > 0")
    # copies are one node; buckets with one node are of no use
    indexed = some.select("node", F.explode("keys").alias("key"))
    shared = indexed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("key", "least")
    shared = scratch.keep(shared, "shared")
    members = scratch.keep(indexed.join(shared, "key").groupBy("key", "node").agg(F.first("least").alias("least")), "members")
    scratch.drop(shared)
    # of each node in a shared bucket: sizes, sketches, and the packed text of one of its documents
    wanted = some.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key")).alias("d"), *[F.first(c).alias(c) for c in ("n_shingles", *marks)])
    wanted = scratch.keep(wanted.select("node", F.col("d.doc_id").alias("doc_id"), F.col("d.text_key").alias("text_key"), "n_shingles", *marks), "wanted")
    # the keys are of no more use, and they are most of the table
    some_rows = scratch.keep(signed.select("doc_id", "node", "n_shingles"), "rows")
    scratch.drop(signed)
    signed, some = some_rows, some_rows.where("n_shingles > 0")
    packed = rows.mapInArrow(_pack, f"doc_id {kind}, text_key bigint, body binary").alias("p")
    w = wanted.select("node", "doc_id", "text_key").alias("w")
    bodies = scratch.keep(packed.join(w, (F.col("p.text_key") == F.col("w.text_key")) & F.col("p.doc_id").eqNullSafe(F.col("w.doc_id")))
                          .select("node", "body"), "bodies")
    facts = wanted.select("node", "n_shingles", *marks)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        full = (pairs.join(bodies.select(F.col("node").alias("u"), F.col("body").alias("bu")), "u")
                .join(bodies.select(F.col("node").alias("v"), F.col("body").alias("bv")), "v").select("u", "v", "bu", "bv"))
        return scratch.keep(full.mapInArrow(_confirm, "u bigint, v bigint"), name)

    def plausible(pairs: DataFrame) -> DataFrame:
        a, b = facts.withColumnRenamed("node", "u").alias("a"), facts.withColumnRenamed("node", "v").alias("b")
        return pairs.join(a, "u").join(b, "v").where(_near("a", "b")).select("u", "v")

    stars = members.where("node <> least").select(F.col("least").alias("u"), F.col("node").alias("v")).distinct()
    links = confirmed(plausible(stars), "links")
    first = scratch.keep(components(links, scratch), "components")
    scratch.drop(links)
    # what is left: buckets with members of different components
    known = facts.join(first, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    placed = members.select("key", "node").join(known, "node")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES))
    split = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), blocks.alias("blocks")).where("lo < hi")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    open_ = (placed.join(split.select("key", "blocks"), "key").withColumn("side", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
             .select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "node", "c", "side", "n_shingles", *marks))
    met = open_.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    named_ = scratch.keep(met.mapInArrow(_nominate, "name bigint, node bigint, c bigint, side boolean, across boolean").distinct(), "named")
    scratch.drop(members)
    # groups that share members overlap, so their texts would travel once for each: what hangs together and is small is one group
    at_least = named_.groupBy("name").agg(F.min("node").alias("u"))
    hung = scratch.keep(components(named_.join(at_least, "name").select("u", F.col("node").alias("v")), scratch), "hung")
    sized = hung.join(facts.select("node", "n_shingles"), "node").groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    small = hung.join(sized.where((F.col("n") <= BLOCK) & (F.col("total") <= BLOCK_SHINGLES)), "component").select("node", F.col("component").alias("cluster"))
    placed_ = scratch.keep(named_.join(small, "node", "left"), "placed")
    for done in (named_, hung, wanted):
        scratch.drop(done)
    no = F.lit(False)
    groups = (placed_.where("cluster IS NOT NULL").select(no.alias("apart"), F.col("cluster").alias("name"), "node", "c", no.alias("side"), no.alias("across")).distinct()
              .union(placed_.where("cluster IS NULL").select(F.lit(True), "name", "node", "c", "side", "across")))
    nominated = groups.join(bodies, "node").select("apart", "name", "node", "c", "side", "across", "body").repartition("apart", "name").sortWithinPartitions("apart", "name")
    more = scratch.keep(nominated.mapInArrow(_compare, "u bigint, v bigint"), "more")
    scratch.drop(placed_)
    scratch.drop(bodies)
    merged = components(first.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more), scratch)
    # a component is named by the least id of its documents
    nodes = some.groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(merged, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component"))
    named = nodes.join(nodes.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select("node", "component_id")
    linked = some.join(named, "node").select("doc_id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedupe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group; columns as before, whatever their names.

    Rows that repeat an id stay with it, and so do rows without an id if one of them stays; null and empty texts are
    groups of their own; an empty table stays empty.
    """
    found = near_duplicates(docs, doc_id, text).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.alias("docs").join(found, F.col(f"docs.{doc_id}").eqNullSafe(found["_kept"]), "left_semi")
