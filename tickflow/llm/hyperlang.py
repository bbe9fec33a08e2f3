"""Language identification with hyperdimensional profiles.

Every letter is a random vector of signs. A vector rotated by its place in an n-gram and bound to the
others by multiplication stands for the n-gram; the sum of a text's n-gram vectors is its profile.
A language's prototype is the sum of the unit profiles of its texts. A text gets the language whose prototype has
the greatest cosine with its profile.

Signs are bits, so binding is XOR, and the bits of a letter are hashes of its code point: no table of letters
is kept or sent, and letters never seen before have vectors too.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .slicing import by_bytes

#: Signs of a vector, a multiple of 64, and letters of an n-gram.
DIMENSIONS, GRAM = 2048, 3
#: Unit profiles are summed as whole numbers of this scale, so that the order of rows doesn't matter.
SCALE = 1 << 20
#: Languages a model may have; a prototype of each goes to every task. More distinct values are an error.
MAX_LANGUAGES = 10_000
UNKNOWN = "und"
#: What is counted in one piece: texts, different n-grams of them, and bytes of text that are cut at once.
PIECE_TEXTS, PIECE_GRAMS, SLICE_BYTES = 64, 32_768, 1 << 21

_LETTER, _KEPT = regex.compile(r"\p{L}"), regex.compile(r"[\p{L}\p{M}]")
#: The eight signs of a byte of bits.
_SIGNS = 1 - 2 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)


class _Spaced(dict):
    """Code point -> itself for letters and marks, else a space; looked up once each."""

    def __missing__(self, point: int) -> int:
        kept = self[point] = point if _KEPT.match(chr(point)) else 32
        return kept


_SPACED = _Spaced()


def letters_of(text: str | None) -> str:
    """Small letters, words apart by one space and one at both ends; empty if there is no letter."""
    if not text or not _LETTER.search(text):
        return ""
    return f" {' '.join(unicodedata.normalize('NFC', text).lower().translate(_SPACED).split())} "


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64 bits in which every bit depends on all of ``x``."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def letter_bits(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A row of 0 and 1 per code point; 1 is the sign -1."""
    places = np.arange(dimensions // 64, dtype=np.uint64)
    words = _mixed(_mixed(points.astype(np.uint64))[:, None] + places)
    return np.unpackbits(words.astype("<u8").view(np.uint8), axis=1)


def _bound(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Per n-gram (a row of code points) the letters' bits, each rotated by its distance from the end, bound by XOR, in bytes."""
    points, where = np.unique(grams, return_inverse=True)
    bits, where = letter_bits(points, dimensions), where.reshape(grams.shape)
    last = grams.shape[1] - 1
    bound = np.packbits(bits, axis=1)[where[:, last]]
    for place in range(last):
        bound ^= np.packbits(np.roll(bits, last - place, axis=1), axis=1)[where[:, place]]
    return bound


def gram_bits(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bits per n-gram; 1 is the sign -1."""
    return np.unpackbits(_bound(grams, dimensions), axis=1)


def gram_signs(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The same as signs, in single precision, a byte of bits at a time."""
    return np.take(_SIGNS, _bound(grams, dimensions), axis=0).reshape(len(grams), dimensions)


def _ranked(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different code points and the place of each among them, by a table instead of a sort."""
    seen = np.zeros(int(points.max()) + 1, bool)
    seen[points] = True
    alphabet = np.flatnonzero(seen)
    places = np.zeros(len(seen), np.int64)
    places[alphabet] = np.arange(len(alphabet))
    return alphabet, places[points]


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram as one number, how often) for texts of at least GRAM characters, by text, and the alphabet
    that the numbers are written in, a digit per letter."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    alphabet, points = _ranked(points)
    base = len(alphabet)
    grams = np.zeros(len(points) - GRAM + 1, np.int64)
    for place in range(GRAM):
        grams = grams * base + points[place:len(points) - GRAM + 1 + place]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    inside = owner[:len(grams)] == owner[GRAM - 1:]
    owner, grams = owner[:len(grams)][inside], grams[inside]
    span = base ** GRAM
    if span * len(texts) < 1 << 62:
        keys, counts = np.unique(owner * span + grams, return_counts=True)
        return keys // span, keys % span, counts, alphabet
    order = np.lexsort((grams, owner))
    owner, grams = owner[order], grams[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])])
    return owner[first], grams[first], np.diff(np.r_[first, len(grams)]), alphabet


def profiles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """A profile per text made by :func:`letters_of`: its n-gram vectors summed; zeros for an empty text.

    Single precision is exact for up to 2**24 n-grams in a piece; pieces of a long text are added up as doubles.
    """
    out = np.zeros((len(texts), dimensions))
    full = [i for i, t in enumerate(texts) if t]
    if not full:
        return out
    owner, grams, counts, alphabet = _counted([texts[i] for i in full])
    at = 0
    while at < len(owner):
        # as many texts and n-grams as a piece takes; a text of more goes on in the next piece
        end = min(at + PIECE_GRAMS, int(np.searchsorted(owner, owner[at] + PIECE_TEXTS)))
        codes, where = np.unique(grams[at:end], return_inverse=True)
        letters = []
        for _ in range(GRAM):
            letters.append(alphabet[codes % len(alphabet)])
            codes = codes // len(alphabet)
        rows = owner[at:end] - owner[at]
        table = np.zeros((rows[-1] + 1, len(codes)), np.float32)
        table[rows, where] = counts[at:end]
        sums = table @ gram_signs(np.stack(letters[::-1], axis=1), dimensions)
        for k, one in enumerate(sums):
            out[full[owner[at] + k]] += one
        at = end
    return out


def _units(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


class Prototypes:
    """A unit vector per language. The mean of all is taken off first, so that what languages share doesn't count."""

    def __init__(self, names: list[str], sums: np.ndarray):
        self.names = names
        units = _units(np.asarray(sums, float).reshape(len(names), -1)) if names else np.zeros((0, DIMENSIONS))
        self.centre = units.mean(axis=0) if len(names) > 1 else np.zeros(units.shape[1])
        self.vectors = _units(units - self.centre)

    def best(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language with the greatest cosine and that cosine, taken to 0 to 1; the first name of equal ones."""
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        units = _units(profiles(texts, self.vectors.shape[1]))
        cosines = np.clip(_units(units - self.centre) @ self.vectors.T, -1, 1)
        choice = cosines.argmax(axis=1)
        scores = np.round((1 + cosines[np.arange(len(texts)), choice]) / 2, 12)
        return [self.names[k] if t else UNKNOWN for k, t in zip(choice, texts)], [s if t else 0.0 for s, t in zip(scores.tolist(), texts)]


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> Prototypes:
    """Prototypes of the languages of ``rows``. Every text with a letter and a language counts, the same whatever
    its length. A task sends one sum per language it saw; these are added up by language and dimension."""
    def sums(batches):
        held: dict[str, np.ndarray] = {}
        for batch in by_bytes(batches, 1, SLICE_BYTES):
            names, texts = np.array(batch.column(0).to_pylist(), object), [letters_of(t) for t in batch.column(1).to_pylist()]
            units = np.rint(_units(profiles(texts)) * SCALE).astype(np.int64)
            for name in set(names[[bool(t) for t in texts]]):
                held[name] = held.get(name, 0) + units[names == name].sum(axis=0)
            # a task with many languages passes its sums on as it goes
            if len(held) > 64:
                yield _sums_batch(held)
                held = {}
        if held:
            yield _sums_batch(held)

    ship(rows.sparkSession)
    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    partial = known.mapInArrow(sums, "lang string, sums array<bigint>")
    total = partial.select("lang", F.posexplode("sums").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    whole = total.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("sums"))
    found = whole.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different values of {lang}: not a column of languages")
    return Prototypes([r["lang"] for r in found], np.array([r["sums"] for r in found]))


def _sums_batch(held: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.int64()))],
                                      names=["lang", "sums"])


def identify(docs: DataFrame, model: Prototypes, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with (lang_pred, score) for every row; only the text is looked at.

    A text that is null or has no letter gets ``und`` and 0. The score is the cosine taken from -1..1 to 0..1.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def judge(batches):
        one = shared.value
        for batch in by_bytes(batches, len(keep), SLICE_BYTES):
            names, scores = one.best([letters_of(t) for t in batch.column(len(keep)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names[:len(keep)], "lang_pred", "score"])

    rows = docs.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(judge, f"{kinds}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Every fourth document by CRC-32 of its id; a row without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``, learned from the rows not held out.

    Rows without a language teach nothing; where nothing was learned, every row gets ``und``. Ids may be null or
    repeat, texts are read whole, extra columns are ignored, and an empty table gives an empty result.
    """
    apart = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return identify(apart.select("doc_id", "held_out", "text"), learn(apart.where(~F.col("held_out"))), keep=("doc_id", "held_out"))
