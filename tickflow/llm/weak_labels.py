"""Quality classifier from weak labels: expectation-maximisation over heuristic labellers, then a hashed linear scorer.

Two questions are asked of a document: is it well-formed text, and is it free of abuse? For each, labellers
vote good, bad or nothing. The votes of all documents are counted by pattern, EM estimates from these counts
how often each labeller is right in either class, and the posterior of a pattern labels its documents.
On a bounded sample of them, a linear scorer over hashed features is trained, which then judges every
document: on word shapes where the labellers see ratios, on word stems where they see listed words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memories import only, remembers
from .scratch import Scratch
from .shipping import ship
from .slicing import by_bytes

#: Rows of ``labels`` from which listed words are learned, and documents a scorer is trained on. The fit alone is
#: bounded; votes, their counts and scores cover all documents.
MAX_LABELLED, MAX_TRAINING = 40_000, 8_000
#: A stem is listed when at least so many abusive documents have it and hardly another one.
LEAST_ABUSIVE, LISTED_SHARE = 4, 0.9
SHAPE_BITS, STEM_BITS = 16, 22
STEM_CHARS = (4, 6)
#: Words a worker remembers, and text it takes at once: both bound its memory.
REMEMBERED = 250_000
BATCH_BYTES = 2 << 20
SYMBOLS = frozenset("#*$%&|<>")
QUALITY_LABELLERS = ("symbols", "capitals", "stutter", "variety", "exclaims", "separators", "dup_lines", "length", "prose", "rhythm")
ABUSE_LABELLERS = ("short_stems", "long_stems", "density")
_LETTERS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1+")
#: A word as prose has it: letters, small ones after the first, in brackets or quotes or with one mark after it.
_PLAIN = re.compile(r"""["'(\[]?[^\W\d_](?:[^\W\d_A-Z]|['-](?=[^\W\d_]))*["')\]]?[.,;:!?]?""")


class _Kinds(dict):
    """Character -> A, a, 0 or itself, worked out once per character."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return kind


_kinds = _Kinds()


def _bucket(text: str, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(text) & ((1 << bits) - 1)


def _outline_facts(outline: str) -> tuple[int, ...]:
    """What follows from the kinds of a word's characters. Its shape has runs cut to one sign: 'Anti%%%' is 'Aa%'."""
    letters = outline.count("A") + outline.count("a")
    symbols = sum(map(outline.count, SYMBOLS))
    return (symbols, outline.count("A"), letters, outline.endswith("!!"), not letters and symbols > 0,
            _PLAIN.fullmatch(outline) is not None, _bucket(_RUN.sub(r"\1", outline), SHAPE_BITS))


class WordFacts:
    """What is needed of each different word, as rows of an array; forgets all when it holds too many.

    Most of it follows from the outline of a word and the rest from the beginnings of its runs of letters, and there are
    far fewer of both than of words. The first run's stems stand in the row; those of further runs ('you/idiot') in ``more``,
    from ``at`` on. New words are taken together, for texts of much junk are mostly new words.
    """

    FIELDS = ("symbols", "capitals", "letters", "exclaims", "bar", "plain", "shape", "stem0", "stem1", "runs", "at")

    def __init__(self):
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.outlines: dict[str, int] = {}
        self.outline_facts: list[tuple[int, ...]] = []
        self.stems: tuple[dict[str, int], ...] = tuple({} for _ in STEM_CHARS)
        self.rows = np.zeros((4096, len(self.FIELDS)), dtype=np.int32)
        self.more = np.zeros((1024, len(STEM_CHARS)), dtype=np.int32)
        self.n_more = 0

    def _outline_numbers(self, words: list[str]) -> list[int]:
        outlines = "\n".join(words).translate(_kinds).split("\n")
        numbers = list(map(self.outlines.get, outlines))
        for i, n in enumerate(numbers):
            if n is None:
                n = self.outlines.get(outlines[i])
                if n is None:
                    n = self.outlines[outlines[i]] = len(self.outline_facts)
                    self.outline_facts.append(_outline_facts(outlines[i]))
                numbers[i] = n
        return numbers

    def _stem_buckets(self, runs: list[str]) -> np.ndarray:
        """A row per run of small letters, a bucket per stem; 0 where a run is too short for it. A run of two or three
        letters is a stem as a whole."""
        out = np.zeros((len(runs), len(STEM_CHARS)), dtype=np.int32)
        for column, (chars, known) in enumerate(zip(STEM_CHARS, self.stems)):
            starts = [r[:chars] for r in runs]
            buckets = list(map(known.get, starts))
            for i, n in enumerate(buckets):
                if n is None:
                    stem = starts[i]
                    n = known.get(stem)
                    if n is None:
                        whole = column == 0 and 2 <= len(stem) < chars
                        n = known[stem] = _bucket(f"{chars}:{stem}", STEM_BITS) if len(stem) == chars or whole else 0
                    buckets[i] = n
            out[:, column] = buckets
        return out

    def _learn(self, words: list[str]) -> None:
        first, need = len(self.number), len(self.number) + len(words)
        self.number.update(zip(words, range(first, need)))
        if need > len(self.rows):
            grown = np.zeros((need + need // 2, len(self.FIELDS)), dtype=np.int32)
            grown[:first] = self.rows[:first]
            self.rows = grown
        rows = self.rows[first:need]
        rows[:, :7] = np.array(self.outline_facts_of(words), dtype=np.int32)
        runs = [(w,) if w.isalpha() else _LETTERS.findall(w) or ("",) for w in words]
        further = [r for found in runs for r in found[1:]]
        small = "\n".join([*[found[0] for found in runs], *further]).lower().split("\n")
        buckets = self._stem_buckets(small)
        rows[:, 7:9] = buckets[:len(words)]
        rows[:, 9] = [len(found) - 1 for found in runs]
        rows[:, 10] = self.n_more + np.cumsum(rows[:, 9]) - rows[:, 9]
        end = self.n_more + len(further)
        if end > len(self.more):
            grown = np.zeros((end + end // 2, len(STEM_CHARS)), dtype=np.int32)
            grown[:self.n_more] = self.more[:self.n_more]
            self.more = grown
        self.more[self.n_more:end] = buckets[len(words):]
        self.n_more = end

    def outline_facts_of(self, words: list[str]) -> list[tuple[int, ...]]:
        return list(map(self.outline_facts.__getitem__, self._outline_numbers(words)))

    def numbers(self, words: list[str]) -> np.ndarray:
        """Rows of words that are all different."""
        known = self.number
        new = [w for w in words if w not in known]
        if new:
            self._learn(new)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


_facts = WordFacts()
remembers("weak_labels", _facts.clear)


def batches_of(texts: list[str | None]):
    """Consecutive slices of bounded size; a text longer than that is alone."""
    first = total = 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > first and total + size > BATCH_BYTES:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(texts):
        yield first, len(texts)


def _different(codes: np.ndarray) -> np.ndarray:
    """The different values in order, by sorting."""
    codes = np.sort(codes)
    return codes[np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))]


class Tokens:
    """The words of some texts as rows of :class:`WordFacts`; ``doc`` tells whose each word is."""

    def __init__(self, texts: list[str | None]):
        if len(_facts.number) > REMEMBERED:
            _facts.clear()
        self.n_docs = len(texts)
        split = pc.utf8_split_whitespace(pa.array([t or "" for t in texts], pa.string()))
        words = split.flatten()
        full = pc.not_equal(words, "")      # white space at an end leaves an empty word
        words = words.filter(full).dictionary_encode()
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        self.doc = np.repeat(np.arange(self.n_docs), counts)[full.to_numpy(zero_copy_only=False)]
        self.n = np.bincount(self.doc, minlength=self.n_docs)
        # only the different words of the texts are looked up
        self.number = _facts.numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
        self.texts = texts

    def lines(self) -> list[list[str]]:
        return [t.split("\n") if t else [] for t in self.texts]

    def fact(self, field: str) -> np.ndarray:
        """A fact of each word."""
        return _facts.rows[:, WordFacts.FIELDS.index(field)][self.number]

    def per_doc(self, field: str) -> np.ndarray:
        return np.bincount(self.doc, weights=self.fact(field), minlength=self.n_docs)

    def stutter(self) -> np.ndarray:
        same = (self.number[1:] == self.number[:-1]) & (self.doc[1:] == self.doc[:-1])
        return np.bincount(self.doc[1:][same], minlength=self.n_docs)

    def distinct(self) -> np.ndarray:
        codes = _different(self.doc * np.int64(len(_facts.number) + 1) + self.number)
        return np.bincount(codes // (len(_facts.number) + 1), minlength=self.n_docs)

    def all_stems(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, bucket) of every run of letters."""
        runs, at = self.fact("runs"), self.fact("at")
        several = np.flatnonzero(runs)
        # the places of the further runs of each such word, one after the other
        counts = runs[several]
        place = np.repeat(at[several] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return (np.concatenate((self.doc, np.repeat(self.doc[several], counts))),
                np.concatenate((self.fact(f"stem{which}"), _facts.more[place, which])).astype(np.int64))

    def stems(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, bucket) of the different stems of each document."""
        doc, bucket = self.all_stems(which)
        codes = _different((doc << STEM_BITS | bucket)[bucket > 0])
        return codes >> STEM_BITS, codes & ((1 << STEM_BITS) - 1)

    def shapes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, bucket, share of the words) of word shapes; bucket 0 holds words that repeat the one before."""
        codes, counts = np.unique(self.doc << SHAPE_BITS | self.fact("shape"), return_counts=True)
        doc = np.concatenate((codes >> SHAPE_BITS, np.arange(self.n_docs)))
        counts = np.concatenate((counts, self.stutter()))
        bucket = np.concatenate((codes & ((1 << SHAPE_BITS) - 1), np.zeros(self.n_docs, dtype=np.int64)))
        return doc, bucket, counts / np.maximum(1, self.n[doc])


def quality_votes(tokens: Tokens) -> np.ndarray:
    """Votes (1 good, -1 bad, 0 none) of :data:`QUALITY_LABELLERS`, one row per document.

    A labeller that knows one kind of junk has nothing to say about texts without it.
    """
    n, letters = np.maximum(1, tokens.n), np.maximum(1, tokens.per_doc("letters"))
    stutter, prose, distinct = tokens.stutter() / n, tokens.per_doc("plain") / n, tokens.distinct()
    lines = [[s for s in lines if s.strip()] for lines in tokens.lines()]
    dup = np.array([1 - len(set(x)) / len(x) if len(x) > 3 else 0.0 for x in lines])
    bad = lambda sign: np.where(sign, -1, 0)
    votes = np.stack([
        bad(tokens.per_doc("symbols") / n > 0.25), bad(tokens.per_doc("capitals") / letters > 0.3), bad(stutter > 0.1),
        # the words of a text grow more slowly than its length
        bad((tokens.n >= 30) & (distinct < 2.5 * n ** 0.5)), bad(tokens.per_doc("exclaims") / n > 0.1),
        bad(tokens.per_doc("bar") / n > 0.1), bad(dup > 0.5), bad(tokens.n < 5),
        np.where(prose > 0.9, 1, np.where(prose < 0.7, -1, 0)),
        np.where((tokens.n >= 30) & (stutter < 0.02) & (distinct > 4 * n ** 0.5), 1, 0)], axis=1)
    votes[tokens.n == 0] = -1  # nothing to keep
    return votes


def abuse_votes(tokens: Tokens, listed: list[np.ndarray]) -> np.ndarray:
    """Votes of :data:`ABUSE_LABELLERS`; ``listed`` holds sorted buckets of short and long stems."""
    found = []
    for which, stems in enumerate(listed):
        doc, bucket = tokens.stems(which)
        found.append(np.bincount(doc[np.isin(bucket, stems)], minlength=tokens.n_docs))
    hits = [np.where(f >= 2, -1, np.where(f == 0, 1, 0)) for f in found]
    doc, bucket = tokens.all_stems(0)
    rate = np.bincount(doc[np.isin(bucket, listed[0])], minlength=tokens.n_docs) / np.maximum(1, tokens.n)
    return np.stack([*hits, np.where(rate > 0.004, -1, np.where(rate == 0, 1, 0))], axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300):
    """EM over vote patterns. Returns the posterior of good per pattern, the labellers' accuracies (how
    often a vote is right where the text is good, and where it is bad), and the share of good documents.

    In either class a labeller votes bad, nothing or good with chances of its own. EM starts from the
    votes: a text that a labeller finds bad is taken as bad.
    """
    good_votes, bad_votes = (patterns == 1).sum(axis=1), (patterns == -1).sum(axis=1)
    posterior = np.where(bad_votes > 0, 0.1, np.where(good_votes > 0, 0.95, 0.6))
    chances = np.zeros((2, patterns.shape[1], 3))
    good = 0.5
    for _ in range(rounds):
        for c, weights in enumerate((1 - posterior, posterior)):
            total = (weights * counts).sum()
            for v in (-1, 0, 1):
                # votes against the class start with less
                chances[c, :, v + 1] = ((weights * counts) @ (patterns == v) + (0.05 if v == (1, -1)[c] else 0.5)) / (total + 1.05)
        good = float(np.clip((posterior * counts).sum() / max(counts.sum(), 1), 0.01, 0.99))
        logs = [sum(np.log(chances[c, j, patterns[:, j] + 1]) for j in range(patterns.shape[1])) + np.log((1 - good, good)[c]) for c in (0, 1)]
        before, posterior = posterior, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(posterior - before).max(initial=0) < 1e-9:
            break
    right = np.stack([chances[1, :, 2] / (chances[1, :, 0] + chances[1, :, 2]), chances[0, :, 0] / (chances[0, :, 0] + chances[0, :, 2])], axis=1)
    return posterior, right, good


def fit_linear(doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, rounds: int = 300, decay: float = 1e-4,
               least: int = 1, most: float = np.inf, sparse: float = 0.0):
    """Logistic regression on hashed features, classes weighted alike: (buckets, weights, bias).

    Features of fewer than ``least`` documents are left out; no weight is above ``most``; ``sparse``
    draws weights to 0, so that what a few texts share by chance does not add up in a long one.
    """
    buckets, column, seen = np.unique(bucket, return_inverse=True, return_counts=True)
    often = (seen >= least)[column]
    doc, value, column = doc[often], value[often], column[often]
    weight = np.zeros(len(buckets))
    bias = 0.0
    n_good = max(1.0, target.sum())
    n_bad = max(1.0, (1 - target).sum())
    per_row = target * (0.5 / n_good) + (1 - target) * (0.5 / n_bad)
    seen_w, seen_b = np.full(len(buckets), 1e-8), 1e-8
    for _ in range(rounds):
        score = np.bincount(doc, weights=value * weight[column], minlength=len(target)) + bias
        error = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - target) * per_row
        grad = np.bincount(column, weights=value * error[doc], minlength=len(buckets)) + decay * weight / max(1, len(buckets)) ** 0.5
        seen_w += grad ** 2
        seen_b += error.sum() ** 2
        step = 0.5 / np.sqrt(seen_w)
        weight = weight - step * grad
        weight = np.minimum(np.sign(weight) * np.maximum(np.abs(weight) - step * sparse, 0), most)
        bias -= 0.5 * error.sum() / np.sqrt(seen_b)
    kept = weight != 0
    return buckets[kept], weight[kept], bias


class Scorer:
    """Weights of both questions, spread over their hash ranges."""

    def __init__(self, quality, abuse):
        self.parts = (quality, abuse)
        self._dense = None

    def __getstate__(self):
        return {"parts": self.parts, "_dense": None}

    def scores(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        if self._dense is None:
            self._dense = []
            for (buckets, weights, _), bits in zip(self.parts, (SHAPE_BITS, STEM_BITS)):
                dense = np.zeros(1 << bits, dtype=np.float32)
                dense[buckets] = weights
                self._dense.append(dense)
        doc, bucket, share = tokens.shapes()
        quality = np.bincount(doc, weights=share * self._dense[0][bucket], minlength=tokens.n_docs) + self.parts[0][2]
        abuse = np.full(tokens.n_docs, float(self.parts[1][2]))
        for which in range(len(STEM_CHARS)):
            doc, bucket = tokens.stems(which)
            abuse += np.bincount(doc, weights=self._dense[1][bucket], minlength=tokens.n_docs)
        return quality, abuse


def _slices(batches, at: int):
    """(first, last, batch, tokens) over bounded parts of Arrow batches; ``at`` is the text column."""
    only("weak_labels")
    for batch in by_bytes(batches, at, BATCH_BYTES):
        texts = batch.column(at).to_pylist()
        for a, b in batches_of(texts):
            yield a, b, batch, Tokens(texts[a:b])


def _listed_stems(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str, max_labelled: int) -> list[np.ndarray]:
    """Stem buckets that mark abusive documents, from a bounded sample of the labelled rows."""
    sample = (labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull()).select(doc_id, F.col(toxic).cast("int").alias("toxic"))
              .groupBy(doc_id).agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64(doc_id), doc_id).limit(max_labelled))
    # the sample has a stated bound, so it goes to the texts and not the texts to it
    rows = docs.select(F.col(doc_id), F.col(text).alias("text")).join(F.broadcast(sample), doc_id)
    rows = rows.groupBy(doc_id).agg(F.min("toxic").alias("toxic"), F.min("text").alias("text")).select("toxic", "text")  # an id counts once

    def stems(batches):
        for a, b, batch, tokens in _slices(batches, 1):
            toxic_ = np.array(batch.column(0).slice(a, b - a).to_pylist(), dtype=np.int64)
            for which in range(len(STEM_CHARS)):
                doc, bucket = tokens.stems(which)
                buckets, at = np.unique(bucket, return_inverse=True)
                bad = np.bincount(at, weights=toxic_[doc], minlength=len(buckets)).astype(np.int64)
                all_ = np.bincount(at, minlength=len(buckets))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(buckets), which)), pa.array(buckets), pa.array(bad),
                                                  pa.array(all_)], names=["which", "bucket", "bad", "n"])

    counted = rows.mapInArrow(stems, "which bigint, bucket bigint, bad bigint, n bigint").groupBy("which", "bucket").agg(
        F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    kept = counted.where((F.col("bad") >= LEAST_ABUSIVE) & (F.col("bad") >= LISTED_SHARE * F.col("n")))
    found = kept.select("which", "bucket").collect()  # no more than the sample has
    return [np.array(sorted(r["bucket"] for r in found if r["which"] == k), dtype=np.int64) for k in range(len(STEM_CHARS))]


def _sample(voted: DataFrame, question: str, posterior: dict[str, float], each: int) -> DataFrame:
    """Ids and posteriors of a bounded sample with both classes, chosen by hash; repeated rows count once."""
    spark = voted.sparkSession
    table = spark.createDataFrame([(p, float(v)) for p, v in posterior.items()] or [("", 0.5)], "pattern string, good double")
    scored = voted.select("row", F.col(question).alias("pattern")).join(table, "pattern").groupBy("row").agg(F.min("good").alias("good"))
    return scored.where("good >= 0.9").orderBy(F.xxhash64("row")).limit(each).union(
        scored.where("good <= 0.1").orderBy(F.xxhash64("row")).limit(each))


def _features(rows: DataFrame, question: str) -> tuple[np.ndarray, ...]:
    def make(batches):
        for a, b, batch, tokens in _slices(batches, 2):
            if question == "quality":
                doc, bucket, value = tokens.shapes()
            else:
                parts = [tokens.stems(k) for k in range(len(STEM_CHARS))]
                doc, bucket = (np.concatenate([p[k] for p in parts]) for k in range(2))
                value = np.ones(len(doc))
            order = np.argsort(doc, kind="stable")
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=b - a)))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                 pa.ListArray.from_arrays(ends, pa.array(bucket[order].astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(value[order].astype(np.float32)))], names=["row", "good", "buckets", "shares"])

    found = rows.select("row", "good", "text").mapInArrow(make, "row bigint, good double, buckets array<int>, shares array<float>").toArrow()
    if not found.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    found = found.sort_by("row")  # so that the order of arrival does not matter
    lists = found.column("buckets").combine_chunks()
    doc = np.repeat(np.arange(found.num_rows), np.diff(lists.offsets.to_numpy()))
    return (doc, lists.values.to_numpy().astype(np.int64), found.column("shares").combine_chunks().values.to_numpy().astype(float),
            found.column("good").to_numpy())


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
        max_labelled: int = MAX_LABELLED, max_training: int = MAX_TRAINING) -> tuple[Scorer, dict]:
    """Label and train. Also returns the labellers' estimated accuracies and the shares of good documents."""
    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "weak-labels")
    listed = _listed_stems(docs, labels, doc_id, text, toxic, max_labelled)
    key = [F.xxhash64(F.col(doc_id), F.col(text)).alias("row"), F.col(text).alias("text")]

    def vote(batches):
        for a, b, batch, tokens in _slices(batches, 1):
            names = [["".join("-0+"[v + 1] for v in row) for row in votes] for votes in (quality_votes(tokens), abuse_votes(tokens, listed))]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, names)], names=["row", "quality", "abuse"])

    voted = scratch.keep(docs.select(*key).mapInArrow(vote, "row bigint, quality string, abuse string"), "votes")
    parts, report = {}, {}
    for question, labellers in (("quality", QUALITY_LABELLERS), ("abuse", ABUSE_LABELLERS)):
        # at most three votes per labeller: the number of patterns does not depend on the table
        found = voted.groupBy(question).count().collect()
        patterns = np.array([["-0+".index(v) - 1 for v in r[0]] for r in found], dtype=np.int64).reshape(-1, len(labellers))
        posterior, right, good = estimate(patterns, np.array([r[1] for r in found], dtype=float))
        report[question] = {"good": good, "right": dict(zip(labellers, right.tolist()))}
        sample = _sample(voted, question, dict(zip([r[0] for r in found], posterior)), max_training // 2)
        rows = docs.select(*key).join(F.broadcast(sample), "row").groupBy("row").agg(F.min("good").alias("good"), F.min("text").alias("text"))
        doc, bucket, value, target = _features(rows, question)
        # a stem can only be a sign of abuse; a text without such stems is free of it
        limits = {} if question == "quality" else {"least": LEAST_ABUSIVE, "most": 0.0, "sparse": 5e-4}
        if len(target) and target.min() < 0.5 < target.max():
            parts[question] = fit_linear(doc, bucket, value, (target > 0.5).astype(float), **limits)
        else:  # no document of one class: everything is taken as the other
            parts[question] = (np.zeros(0, np.int64), np.zeros(0), 1.0 if not len(target) or target.max() > 0.5 else -1.0)
    scratch.drop(voted)
    return Scorer(parts["quality"], parts["abuse"]), report


def judge(docs: DataFrame, scorer: Scorer, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) with ``quality_score``, ``abuse_score`` (log odds of good text and of
    text free of abuse) and ``accepted``: both are positive and the text has a word."""
    ship(docs.sparkSession)
    keep = [c for c in (keep or docs.columns) if c not in ("quality_score", "abuse_score", "accepted")]
    model = docs.sparkSession.sparkContext.broadcast(scorer)
    chosen = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def score(batches):
        for a, b, batch, tokens in _slices(batches, len(keep)):
            quality, abuse = model.value.scores(tokens)
            accepted = (quality > 0) & (abuse > 0) & (tokens.n > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in range(len(keep))] + [pa.array(quality), pa.array(abuse), pa.array(accepted)],
                names=[f"_{i}" for i in range(len(keep))] + ["quality_score", "abuse_score", "accepted"])

    out = chosen.mapInArrow(score, f"{schema}, quality_score double, abuse_score double, accepted boolean")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "quality_score", "abuse_score", "accepted")


def classify(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, **how) -> DataFrame:
    """Fit on ``docs`` and judge them; see :func:`fit` and :func:`judge`.

    Null and empty texts are rejected. Labels with a null id or a null class are left out, repeated ones count once,
    as abusive if one of them says so; without labels no stem is listed and no document is found abusive. Equal texts get equal
    scores. An empty table gives an empty result; columns of ``docs`` named like an output column are replaced.
    """
    scorer, _ = fit(docs, labels, **how)
    return judge(docs, scorer, keep=keep)


def accepted_documents(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``docs`` without the rejected ones; columns as before, whatever their names.

    Null and empty texts are rejected, repeated rows are kept or rejected together, an empty table stays empty.
    """
    # columns named like a result of the classifier step aside
    aside = {c: f"_kept_{i}" for i, c in enumerate(docs.columns) if c in ("accepted", "quality_score", "abuse_score")}
    judged = classify(docs.withColumnsRenamed(aside), labels, **how)
    return judged.where("accepted").select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
