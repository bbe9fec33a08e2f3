"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of consecutive words of every item. The words of a document are
streamed through it, keeping the length of the longest match that ends at each word; where the
length reaches a window, the window occurs in an item. Words are looked up for a whole batch of
documents at once, and only stretches whose neighbouring words are neighbours in some item are
streamed: no window can cross another pair of words.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memories import only, remembers
from .scratch import Scratch
from .shipping import ship
from .slicing import by_bytes

WINDOW = 10
#: Items go into automata of about this many bytes of text each (some 200 times as much memory); a process holds one of them at a time.
BLOCK_BYTES = 1 << 20
#: Bytes of text that a task matches at once.
SLICE_BYTES = 1 << 20
#: A document is dropped when more than this share of its words is hit; else the hit spans are cut.
MAX_COVERAGE = 0.8
#: On UTF-8: letters and digits of ASCII and all bytes of other characters,
#: which is `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return _WORD.findall(text.lower()) if text else []


class SuffixAutomaton:
    """All runs of words of a block of items, with the windows that end in each state.

    ``window`` gives the state of a match cut to the window length, ``hits`` the items that hold
    that window; items shorter than a window are windows of their own (``short``).
    """

    def __init__(self, items: list[tuple[object, bytes | None]], window: int = WINDOW):
        self.window_size = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if ids:
                sequences.append((item, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        self.least = min((min(len(ids), window) for _, ids in sequences), default=0)
        self._mark(sequences)

    def _extend(self, last: int, w: int) -> int:
        """Add a word after ``last``; a run some item already has gets no new state."""
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = link[p]
        return clone

    def _mark(self, sequences) -> None:
        """Note the windows of every item at the states that stand for them."""
        size = self.window_size
        self.hits: dict[int, set] = {}
        ends: dict[int, list[tuple[int, object]]] = {}
        pairs = set()
        for item, ids in sequences:
            pairs.update(zip(ids, ids[1:]))
            state, matched = 0, 0
            for w in ids:
                state, matched = self.step(state, matched, w)
                if matched >= size:
                    state, matched = self.cut(state)
                    self.hits.setdefault(state, set()).add(item)
            if len(ids) < size:
                ends.setdefault(state, []).append((len(ids), item))
        # short items on the way up the suffix links, nearest first
        self.short: dict[int, list[tuple[int, object]]] = {}
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            own = ends.get(state, []) + (self.short.get(self.link[state], []) if state else [])
            if own:
                self.short[state] = own
        width = len(self.vocabulary) + 1
        self.pairs = np.array(sorted(a * width + b for a, b in pairs), dtype=np.int64)

    def step(self, state: int, matched: int, w: int) -> tuple[int, int]:
        nxt, link, length = self.next, self.link, self.length
        while state and w not in nxt[state]:
            state = link[state]
            matched = length[state]
        target = nxt[state].get(w)
        return (0, 0) if target is None else (target, matched + 1)

    def cut(self, state: int) -> tuple[int, int]:
        """The state of the last ``window_size`` words of a match that long or longer."""
        while self.length[self.link[state]] >= self.window_size:
            state = self.link[state]
        return state, self.window_size

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """(start, end, items) of the windows in a sequence of word numbers, 0 for unknown words."""
        if not self.least or not len(ids):
            return
        known = ids > 0
        if len(self.pairs):
            codes = ids[:-1] * np.int64(len(self.vocabulary) + 1) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            joined = (self.pairs[at] == codes) & known[:-1] & known[1:]
        else:
            joined = np.zeros(max(0, len(ids) - 1), dtype=bool)
        # stretches: maximal sequences of known words with known neighbours
        starts = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        ends = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        for a, b in zip(*(x[ends - starts >= self.least].tolist() for x in (starts, ends))):
            yield from self._stream(ids[a:b].tolist(), a)

    def _stream(self, ids: list[int], offset: int) -> Iterator[tuple[int, int, set]]:
        state = matched = 0
        size = self.window_size
        for at, w in enumerate(ids, offset + 1):
            state, matched = self.step(state, matched, w)
            if matched >= size:
                window, _ = self.cut(state)
                yield at - size, at, self.hits[window]
            for n, item in self.short.get(state, ()):
                if n <= matched:
                    yield at - n, at, {item}


#: What a worker matches with: the automaton of one block.
_built: dict[str, SuffixAutomaton] = {}
remembers("decontam", _built.clear)


class _Block:
    """The items of a block, sent as text; each worker builds its automaton when it first needs it, and lets go of the one before."""

    def __init__(self, rows: DataFrame, window: int):
        items = [(r[0], bytes(r[1]) if r[1] is not None else None) for r in rows.collect()]
        self.sent = rows.sparkSession.sparkContext.broadcast(items)
        self.window, self.name = window, uuid.uuid4().hex

    def automaton(self) -> SuffixAutomaton:
        only("decontam")
        if self.name not in _built:
            _built.clear()
            _built[self.name] = SuffixAutomaton(self.sent.value, self.window)
        return _built[self.name]


def _items(benchmark: DataFrame, item_id: str, text: str, block_bytes: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """(item, text, block) and the number of blocks: different items dealt by a hash to blocks of about ``block_bytes``."""
    items = scratch.keep(benchmark.select(F.col(item_id).alias("item"), F.col(text).cast("binary").alias("text")).distinct(), "items")
    n = max(1, math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / block_bytes))
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def _match(texts: list[bytes | None], automaton: SuffixAutomaton) -> list[tuple[int, np.ndarray, set]]:
    """For each text: its number of words, the words hit, the items with windows in it."""
    tokens = [words(t) for t in texts]
    counts = np.array([len(t) for t in tokens], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(counts + 1)))  # an unknown word after each text
    masks = [None] * len(texts)
    items: list[set] = [set() for _ in texts]
    get = automaton.vocabulary.get
    ids = np.zeros(int(starts[-1]), dtype=np.int64)
    for i, t in enumerate(tokens):
        ids[starts[i]:starts[i] + len(t)] = np.fromiter(map(get, t, repeat(0)), dtype=np.int64, count=len(t))
    for a, b, found in automaton.scan(ids):
        i = int(np.searchsorted(starts, a, side="right")) - 1
        if masks[i] is None:
            masks[i] = np.zeros(len(tokens[i]), dtype=bool)
        masks[i][a - starts[i]:b - starts[i]] = True
        items[i] |= found
    return [(len(t), masks[i] if masks[i] is not None else np.zeros(0, dtype=bool), items[i]) for i, t in enumerate(tokens)]


def _names(items: set) -> list[str]:
    return sorted("" if i is None else str(i) for i in items)


def _hits(rows: DataFrame, items: DataFrame, n: int, window: int, scratch: Scratch) -> DataFrame:
    """(row, places, items) of the rows (row, text) that hold a window of any of ``n`` blocks. A pass over the texts per block
    writes what it hits; these few rows are merged."""
    found = None
    for k in range(n):
        block = _Block(items.where(F.col("block") == k).select("item", "text"), window)

        def scan(batches, block=block):
            for batch in by_bytes(batches, 1, SLICE_BYTES):
                hit = [(i, *x[1:]) for i, x in enumerate(_match(batch.column(1).to_pylist(), block.automaton())) if x[1].any()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([i for i, _, _ in hit], pa.int64())),
                     pa.array([np.flatnonzero(mask) for _, mask, _ in hit], pa.list_(pa.int64())),
                     pa.array([_names(x) for _, _, x in hit], pa.list_(pa.string()))], names=["row", "places", "items"])

        part = scratch.keep(rows.select("row", "text").mapInArrow(scan, "row bigint, places array<bigint>, items array<string>"), "hits")
        block.sent.destroy()
        found = part if found is None else found.unionByName(part)
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("row").agg(merged("places"), merged("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``.

    Null and empty texts have no words and match nothing; an item without words has no window; a null
    item id counts as an item named by the empty string; equal rows give equal results; an empty
    benchmark leaves all documents clean. Extra columns are ignored. One block of items is matched in one pass; with
    more, the texts are written once and passed over for each.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "decontam")
    items, n = _items(benchmark, item_id, text, block_bytes, scratch)
    kind = docs.schema[doc_id].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    if n > 1:
        rows = scratch.keep(slim.withColumn("row", F.monotonically_increasing_id()), "rows")
        joined = rows.join(_hits(rows, items, n, window, scratch), "row", "left")
        # words as the automaton has them: letters and digits of ASCII and all other characters
        n_words = F.size(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"), F.lit(0)))
        size = lambda c: F.coalesce(F.size(F.coalesce(F.col(c), F.array())), F.lit(0)).cast("long")
        return joined.select("doc_id", n_words.cast("long").alias("n_words"), size("places").alias("n_hit"), size("items").alias("n_items"),
                             F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
                             F.col("places").isNotNull().alias("contaminated"))
    block = _Block(items.select("item", "text"), window)

    def scan(batches):
        for batch in by_bytes(batches, 1, SLICE_BYTES):
            found = _match(batch.column(1).to_pylist(), block.automaton())
            digests = [hashlib.sha256(",".join(_names(x)).encode()).hexdigest() for _, _, x in found]
            hit = [int(mask.sum()) for _, mask, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in found], pa.int64()), pa.array(hit, pa.int64()),
                 pa.array([len(x) for _, _, x in found], pa.int64()), pa.array(digests), pa.array([h > 0 for h in hit])],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return slim.mapInArrow(scan, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


def cut_spans(text: bytes, mask: np.ndarray) -> bytes:
    """``text`` without the words hit; each removed stretch becomes a line break."""
    out, at = [], 0
    places = [m.span() for m in _WORD.finditer(text.lower())]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    for a, b in edges.reshape(-1, 2).tolist():
        out += [text[at:places[a][0]], b"\n"]
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def _cleaned(value: bytes, mask: np.ndarray, automaton: SuffixAutomaton) -> bytes:
    """``value`` with hit spans cut until no window is left."""
    while mask.any():
        value = cut_spans(value, mask)
        ((_, mask, _),) = _match([value], automaton)
    return value


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW,
                         max_coverage: float = MAX_COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without benchmark passages, columns as before, whatever their names.

    Documents with more than ``max_coverage`` of their words hit are dropped; from the others the hit
    spans are cut, again until no window is left. ``n_chars``, if there is one, is counted anew. Null and empty texts stay as
    they are, repeated rows stay repeated, an empty table stays empty, an empty benchmark changes nothing.
    """
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "decontam")
    items, n = _items(benchmark, item_id, text, block_bytes, scratch)
    if n > 1:
        return _remove_by_blocks(docs, items, n, text, window, max_coverage, scratch)
    block = _Block(items.select("item", "text"), window)
    at = docs.columns.index(text)
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1

    def clean(batches):
        for batch in by_bytes(batches, at, SLICE_BYTES):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            keep, changed = np.ones(len(texts), dtype=bool), {}
            for i, (words_, mask, _) in enumerate(_match(texts, block.automaton())):
                if mask.sum() > max_coverage * words_:
                    keep[i] = False
                elif mask.any():
                    changed[i] = _cleaned(texts[i], mask, block.automaton())
            if changed:
                for i, t in changed.items():
                    texts[i] = t
                values = [None if t is None else t.decode() for t in texts]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
                if count_at >= 0:
                    sizes = batch.column(count_at).to_pylist()
                    for i in changed:
                        sizes[i] = len(values[i])
                    batch = batch.set_column(count_at, batch.schema.field(count_at), pa.array(sizes, batch.schema.field(count_at).type))
            yield batch.filter(pa.array(keep)) if not keep.all() else batch

    return docs.mapInArrow(clean, docs.schema)


def _remove_by_blocks(docs: DataFrame, items: DataFrame, n: int, text: str, window: int, max_coverage: float, scratch: Scratch) -> DataFrame:
    """The same with more than one block: rounds of a pass per block, each over the texts that the round before has cut."""
    rows = scratch.keep(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    now = rows.select("row", F.col("doc")[text].cast("binary").alias("text"))
    changed, most = None, max_coverage
    while True:
        hits = scratch.keep(_hits(now, items, n, window, scratch).select("row", "places"), "merged")
        if hits.isEmpty():
            break

        def cut(batches, most=most):
            for batch in by_bytes(batches, 1, SLICE_BYTES):
                out = []
                for value, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    mask = np.zeros(len(words(value)), dtype=bool)
                    mask[places] = True
                    out.append(None if mask.sum() > most * len(mask) else cut_spans(value, mask).decode())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "cut"])

        cuts = scratch.keep(now.join(hits, "row").select("row", "text", "places").mapInArrow(cut, "row bigint, cut string"), "cuts")
        changed = cuts if changed is None else scratch.keep(changed.join(cuts, "row", "left_anti").unionByName(cuts), "changed")
        now = cuts.where("cut IS NOT NULL").select("row", F.col("cut").cast("binary").alias("text"))
        most = 1.0  # what is left of a cut document is never dropped
    if changed is None:
        return rows.select("doc.*")
    joined = rows.join(changed.select("row", "cut", F.lit(True).alias("hit")), "row", "left").where("hit IS NULL OR cut IS NOT NULL")
    new = {text: F.coalesce("cut", F.col("doc")[text])}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("cut").isNotNull(), F.length("cut").cast(kind)).otherwise(F.col("doc")["n_chars"])
    return joined.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
