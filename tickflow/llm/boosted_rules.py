"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

The trees are fitted on a bounded sample of labelled documents and flattened into arrays of
nodes, so that a batch of documents walks all trees at once. Features that can only speak
against a text (symbols, repeats) are constrained: more of them never raises the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neardup import word_hashes, mixed
from .shipping import ship

#: Labelled rows the trees are fitted on. The fit alone is bounded.
MAX_LABELLED = 20_000
TREES, DEPTH, RATE, BINS, LEAST, RIDGE = 80, 4, 0.15, 64, 20, 1.0
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
BATCH_BYTES = 4 << 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Feature -> sign of its constraint (-1: more is never better, 0: free).
FEATURES = {"log_words": 0, "mean_word": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "capitals": -1, "digits": 0, "marks": 0,
            "exclaims": -1, "stutter": -1, "variety": 0, "line_words": 0}

_CLASS = {"capitals": [*range(65, 91)], "letters": [*range(65, 91), *range(97, 123), *range(128, 256)], "digits": [*range(48, 58)],
          "marks": [ord(c) for c in ".,;:?"], "exclaims": [ord("!")]}
_TABLES = {name: np.isin(np.arange(256), codes).astype(np.int32) for name, codes in _CLASS.items()}
_ROLL = np.uint64(0xD6E8FEB86659FD93)


def _parts(texts: list[str | None]):
    first = total = 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > first and total + size > BATCH_BYTES:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(texts):
        yield first, len(texts)


def _per_doc(weights: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches that end at ``ends``."""
    sums = np.concatenate(([0], np.cumsum(weights, dtype=np.int64)))
    return sums[ends] - sums[np.concatenate(([0], ends[:-1]))]


def statistics(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(counts, features): exact counts as :data:`COUNTS`, and the columns of :data:`FEATURES`."""
    texts = [t or "" for t in texts]
    raw = [t.encode() for t in texts]
    words = [b.split() for b in raw]  # bytes know just the ASCII white space
    n = np.array([len(w) for w in words], dtype=np.int64)
    chars = np.array([len(t) - sum(map(t.count, SPACES)) for t in texts], dtype=np.int64)
    symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], dtype=np.int64)
    lines = [[s for s in b.split(b"\n") if s.split(None, 1)] for b in raw]
    n_lines = np.array([len(x) for x in lines], dtype=np.int64)
    dup = n_lines - np.array([len(set(x)) for x in lines], dtype=np.int64)

    ends = np.cumsum(n)
    hashes = word_hashes([w for ws in words for w in ws])
    doc = np.repeat(np.arange(len(texts)), n)
    own = mixed(doc.astype(np.uint64) + np.uint64(1)) if len(doc) else np.zeros(0, np.uint64)
    # windows within one document that occur again in it
    m = max(0, len(hashes) - WINDOW + 1)
    rolled = np.zeros(m, dtype=np.uint64)
    for k in range(WINDOW):
        rolled = rolled * _ROLL + hashes[k:k + m]
    inside = np.flatnonzero(doc[:m] == doc[WINDOW - 1:WINDOW - 1 + m]) if m else np.zeros(0, np.int64)
    _, at, times = np.unique(mixed(rolled[inside]) ^ own[inside], return_inverse=True, return_counts=True)
    again = inside[times[at] > 1]
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    repeated = _per_doc(np.cumsum(edges[:-1]) > 0, ends) if len(hashes) else np.zeros(len(texts), np.int64)
    counts = np.stack([n, chars, symbols, dup, repeated], axis=1)

    every = np.frombuffer(b"".join(raw), dtype=np.uint8)
    byte_ends = np.cumsum([len(b) for b in raw])
    share = {name: _per_doc(table[every], byte_ends) for name, table in _TABLES.items()}
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    stutter = _per_doc(same, ends) if len(hashes) else np.zeros(len(texts), np.int64)
    _, first = np.unique(hashes ^ own, return_index=True)
    distinct = np.bincount(doc[first], minlength=len(texts))
    some = np.maximum(1, n)
    features = np.stack([
        np.log1p(n), chars / some, symbols / some, dup / np.maximum(1, n_lines), repeated / some, share["capitals"] / np.maximum(1, share["letters"]),
        share["digits"] / some, share["marks"] / some, share["exclaims"] / some, stutter / some, distinct / some ** 0.5,
        n / np.maximum(1, n_lines)], axis=1)
    return counts, features


class Trees:
    """Trees as arrays of nodes. Leaves point to themselves, so all walks take ``depth`` steps."""

    def __init__(self, base: float, depth: int):
        self.base, self.depth = base, depth
        self.roots: list[int] = []
        self.feature, self.left, self.right = (np.zeros(0, np.int32) for _ in range(3))
        self.threshold, self.value = np.zeros(0), np.zeros(0)

    def add(self, nodes: list[tuple[int, float, int, int, float]]) -> None:
        """Nodes (feature, threshold, left, right, value) of one tree, numbered from 0."""
        at = len(self.feature)
        self.roots.append(at)
        feature, threshold, left, right, value = map(np.array, zip(*nodes))
        self.feature, self.threshold = np.append(self.feature, feature), np.append(self.threshold, threshold)
        self.left, self.right = np.append(self.left, left + at), np.append(self.right, right + at)
        self.value = np.append(self.value, value)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Log odds of good text, for rows of features."""
        if not self.roots or not len(features):
            return np.full(len(features), self.base)
        at = np.tile(np.array(self.roots), (len(features), 1))
        rows = np.arange(len(features))[:, None]
        for _ in range(self.depth):
            at = np.where(features[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def fit_trees(features: np.ndarray, target: np.ndarray, signs: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
              bins: int = BINS, least: int = LEAST, ridge: float = RIDGE) -> Trees:
    """Boost trees on the logistic loss. Splits are searched on ``bins`` quantiles; a split that would break
    a feature's sign is not taken, and the middle of its sides bounds what may stand below either."""
    good = np.clip(target.mean() if len(target) else 1.0, 0.001, 0.999)
    model = Trees(float(np.log(good / (1 - good))), depth)
    if not len(target) or target.min() == target.max():
        return model
    cuts = [np.unique(np.quantile(features[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features.shape[1])]
    binned = np.stack([np.searchsorted(c, features[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    score = np.full(len(target), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = target - p, p * (1 - p)
        nodes: list = []

        def grow(rows, level, low, high):
            g, h = grad[rows].sum(), hess[rows].sum()
            value = float(np.clip(g / (h + ridge), low, high))
            me = len(nodes)
            nodes.append((0, np.inf, me, me, rate * value))
            if level == depth or len(rows) < 2 * least:
                return me
            best = (1e-6, None)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[rows, f]
                gs, hs, ns = (np.cumsum(np.bincount(b, weights=w, minlength=len(c) + 1))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
                lv, rv = np.clip(gs / (hs + ridge), low, high), np.clip((g - gs) / (h - hs + ridge), low, high)
                gain = lv * gs - 0.5 * lv ** 2 * (hs + ridge) + rv * (g - gs) - 0.5 * rv ** 2 * (h - hs + ridge) - (value * g - 0.5 * value ** 2 * (h + ridge))
                gain[(ns < least) | (len(rows) - ns < least) | (signs[f] * (rv - lv) < 0)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, lv[k], rv[k]))
            if best[1] is None:
                return me
            f, k, lv, rv = best[1]
            middle = (lv + rv) / 2
            bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[signs[f]]
            goes_left = binned[rows, f] <= k
            left = grow(rows[goes_left], level + 1, *bounds[0])
            right = grow(rows[~goes_left], level + 1, *bounds[1])
            nodes[me] = (f, float(cuts[f][k]), left, right, 0.0)
            return me

        grow(np.arange(len(target)), 0, -np.inf, np.inf)
        one = Trees(0.0, depth)
        one.add(nodes)
        step = one.score(features)
        if not np.abs(step).max() > 1e-6:
            break
        model.add(nodes)
        score = score + step
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
        max_labelled: int = MAX_LABELLED) -> Trees:
    """Fit on at most ``max_labelled`` labelled documents, chosen by a hash of the id. Labels without id or class
    are left out, of repeated ones the lowest counts, of documents with the same id the least text; without both classes the model is a constant."""
    ship(docs.sparkSession)
    sample = (labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull()).groupBy(doc_id)
              .agg(F.min(F.col(quality).cast("double")).alias("_good")).orderBy(F.xxhash64(doc_id), doc_id).limit(max_labelled))
    # the sample has a stated bound, so it goes to the texts and not the texts to it
    rows = docs.select(doc_id, F.col(text).alias("_text")).join(F.broadcast(sample), doc_id)
    rows = rows.groupBy(doc_id).agg(F.min("_good").alias("_good"), F.min("_text").alias("_text")).select("_good", "_text")

    def measure(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _parts(texts):
                _, features = statistics(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, features.T.copy())], names=["good", *FEATURES])

    found = rows.mapInArrow(measure, "good double, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow()
    if not found.num_rows:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0), [])
    features = np.stack([found.column(f).to_numpy() for f in FEATURES], axis=1)
    target = found.column("good").to_numpy()
    order = np.lexsort((*features.T, target))  # so that the order of arrival does not matter
    return fit_trees(features[order], target[order], list(FEATURES.values()))


def judge(docs: DataFrame, model: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, score, kept) for every row of ``docs``.

    A text fails the base rules with fewer than 20 words or with over 30 % of its words in repeated windows of
    eight; else it is kept if its log odds are not negative. Null and empty texts have no words and fail. Equal
    texts get equal results; ids may be null or repeat; extra columns are ignored; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    trees = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def score(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _parts(texts):
                counts, features = statistics(texts[a:b])
                scores = trees.value.score(features)
                failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *map(pa.array, counts.T.copy()), pa.array(failed), pa.array(~failed & (scores >= 0)), pa.array(scores)],
                    names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, score double")
