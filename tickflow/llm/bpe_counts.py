"""Token counts by heap-and-linked-list byte-pair merging; no token is ever named.

A word starts as its bytes, the last one marked as word end. All adjacent pairs that can be
merged wait in a heap by rank; the lowest is merged, its neighbours get new pairs, and pairs
that merging has broken are skipped when they come up. What remains is the number of starting
symbols less the number of merges.
"""

from __future__ import annotations

import json
import unicodedata
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship

LIMIT = 2048
#: Words whose counts a worker remembers.
REMEMBERED = 1_000_000


def _printable() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a printable character: itself, or the next one from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PairMerger:
    """Counts tokens as a ``tokenizers`` file of kind BPE does; ``spec`` is its content.

    Fit for byte-level vocabularies with a word-end mark, whose words come from a pattern: bytes
    0-255 are symbols, 256 more are the same bytes at a word's end.
    """

    def __init__(self, spec: str):
        file = json.loads(spec)
        model, chars = file["model"], _printable()
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only plain BPE files can be counted")
        end = model.get("end_of_word_suffix") or ""
        number = {c: b for b, c in chars.items()}
        number |= {c + end: 256 + b for b, c in chars.items()} if end else {}
        self.end = 256 if end else 0
        #: left * 2**32 + right -> rank * 2**32 + symbol
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = number.setdefault(left + right, len(number) if end else max(256, len(number)))
            self.merges.setdefault(number[left] << 32 | number[right], rank << 32 | made)
        steps = file["normalizer"]["normalizers"] if file["normalizer"]["type"] == "Sequence" else [file["normalizer"]]
        kinds = [s["type"] for s in steps]
        pattern = next(p["pattern"]["Regex"] for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if kinds != ["NFC", "Replace", "Lowercase"] or steps[1]["pattern"] != {"Regex": r"\s+"}:
            raise ValueError(f"unknown normalisation {kinds}")
        self.pattern = pattern
        self.special = [t["content"] for t in file["added_tokens"] if t["special"]]
        self._known: dict[str, int] = {}
        self._compile()

    def _compile(self) -> None:
        self._words = regex.compile(self.pattern).findall
        self._cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_words", "_cut", "_known")}

    def __setstate__(self, state):
        self.__dict__.update(state, _known={})
        self._compile()

    def count_word(self, word: str) -> int:
        """Symbols of one word less its merges."""
        symbols = list(word.encode())
        symbols[-1] += self.end
        merges, n = self.merges, len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # rank, place of the left symbol; the merge is looked up again when its turn comes
        heap = [(m >> 32) << 32 | i for i in range(n - 1) if (m := merges.get(symbols[i] << 32 | symbols[i + 1])) is not None]
        heapify(heap)
        left = n
        while heap:
            entry = heappop(heap)
            i = entry & 0xFFFFFFFF
            j = following[i]
            if symbols[i] < 0 or j >= n:
                continue
            merge = merges.get(symbols[i] << 32 | symbols[j])
            if merge is None or merge >> 32 != entry >> 32:
                continue  # one of the two has changed since
            symbols[i], symbols[j] = merge & 0xFFFFFFFF, -1
            left -= 1
            k = following[i] = following[j]
            if k < n:
                before[k] = i
                m = merges.get(symbols[i] << 32 | symbols[k])
                if m is not None:
                    heappush(heap, (m >> 32) << 32 | i)
            h = before[i]
            if h >= 0:
                m = merges.get(symbols[h] << 32 | symbols[i])
                if m is not None:
                    heappush(heap, (m >> 32) << 32 | h)
        return left

    def _count_plain(self, text: str) -> int:
        # small letters one by one, so a final sigma is like any other
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        known, words = self._known, self._words(text)
        counts = list(map(known.get, words))
        if None in counts:
            if len(known) > REMEMBERED:
                known.clear()
            for i, c in enumerate(counts):
                if c is None:
                    w = words[i]
                    c = known.get(w)
                    if c is None:
                        c = known[w] = self.count_word(w)
                    counts[i] = c
        return sum(counts)

    def count(self, text: str | None) -> int:
        """Tokens of a text, without begin and end; special strings in it count as one token each."""
        if not text:
            return 0
        if self._cut is None or "<" not in text:
            return self._count_plain(text)
        pieces = self._cut.split(text)
        return len(pieces) - 1 + sum(map(self._count_plain, pieces))


def count_tokens(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``vocabulary`` is the path of a tokenizer file on the driver; its content goes to the executors as a
    broadcast, as large as the file. Null and empty texts have no tokens; ids may be null or repeat; extra
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as file:
        merger = spark.sparkContext.broadcast(PairMerger(file.read()))
    kind = docs.schema[doc_id].dataType.simpleString()

    def count(batches):
        one = merger.value
        for batch in batches:
            counts = pa.array([one.count(t) for t in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
