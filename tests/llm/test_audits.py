"""Language profiles, manifests and filter audits against brute force and on odd rows."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from itertools import permutations

import numpy as np
import pytest
import regex

from conftest import SF
from tickflow.llm import filter_audit, hyperlang, manifest
from tickflow.llm.slicing import by_bytes

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = DOCS + ", row string, part string, gid string, pos string, n string, hash string, score string, held_out string, leaf string, _order string"


def clashing(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 10) for r in rows], CLASH)


# -- 11 -----------------------------------------------------------------------------------------

def plain_profile(text, dimensions):
    """Vectors of signs rotated, multiplied and added one n-gram at a time."""
    text, total = hyperlang.letters_of(text), np.zeros(dimensions)
    for i in range(len(text) - 2):
        vectors = [1.0 - 2.0 * hyperlang.letter_bits(np.array([ord(c)]), dimensions)[0] for c in text[i:i + 3]]
        total += np.roll(vectors[0], 2) * np.roll(vectors[1], 1) * vectors[2]
    return total


def test_profiles_equal_brute_force(monkeypatch):
    rng = random.Random(11)
    texts = ["".join(rng.choice("abcé ßÄ.,1\n語x") for _ in range(rng.randint(0, 80))) for _ in range(60)] + ["", "a", "12", "é" * 300]
    want = np.array([plain_profile(t, 256) for t in texts])
    for size in (7, 16_384):
        monkeypatch.setattr(hyperlang, "PIECE_GRAMS", size)
        assert np.array_equal(hyperlang.profiles([hyperlang.letters_of(t) for t in texts], 256), want)


def test_letter_vectors_are_nearly_orthogonal_and_order_counts():
    bits = 1.0 - 2.0 * hyperlang.letter_bits(np.arange(97, 123)).astype(float)
    cosines = bits @ bits.T / hyperlang.DIMENSIONS
    assert np.abs(cosines - np.eye(26)).max() < 0.12
    grams = 1.0 - 2.0 * hyperlang.gram_bits(np.array([[97, 98, 99], [99, 98, 97]])).astype(float)
    assert abs(grams[0] @ grams[1]) / hyperlang.DIMENSIONS < 0.12


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/documents.parquet")
    found = hyperlang.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in found if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.98 and all(0 <= r.score <= 1 for r in found)


def test_held_out_rows_teach_nothing_and_prediction_sees_only_the_text(spark):
    rows = [(i, "der die das und nicht" if i % 2 else "the and of with not", "de" if i % 2 else "en", "s", 0) for i in range(40)]
    rows += [(i, "der die das und nicht", "xx", "s", 0) for i in range(40, 400) if zlib.crc32(str(i).encode()) % 4 == 2]
    found = hyperlang.languages(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.lang_pred for r in found} == {"de", "en"}
    same = {}
    for r, (_, text, *_rest) in zip(sorted(found, key=lambda r: r.doc_id), rows):
        same.setdefault(text, set()).add((r.lang_pred, r.score))
    assert all(len(v) == 1 for v in same.values())


def test_languages_of_odd_rows(spark):
    long = "wort und noch ein wort " * 40_000
    rows = [(None, None, None, None, None), (None, "und das wort", "de", None, 0), (1, None, "de", "a", 0), (2, "", "de", "a", 0), (3, " 12 \n% ", "de", "a", 0),
            (4, long, "de", "a", 0), (4, long, "de", "a", 0), (7, "the word and another", "en", "a", 0), (8, "語", None, "a", 0)]
    docs = clashing(spark, rows)
    found = hyperlang.languages(docs).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(tuple(r))
    assert by_id[1] == [(1, by_id[1][0][1], "und", 0.0)] and by_id[2][0][2] == by_id[3][0][2] == "und"
    assert by_id[4][0] == by_id[4][1] and by_id[4][0][2] == "de" and by_id[8][0][2] in ("de", "en")
    assert all(not r.held_out for r in found if r.doc_id is None)
    empty = hyperlang.languages(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "held_out", "lang_pred", "score"]
    untaught = hyperlang.languages(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang IS NULL"))
    assert {(r.lang_pred, r.score) for r in untaught.collect()} <= {("und", 0.0)}


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(hyperlang, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(i, "some text", f"l{i}", "a", 0) for i in range(9)], DOCS)
    with pytest.raises(ValueError, match="not a column of languages"):
        hyperlang.learn(docs)


def test_parts_by_bytes():
    import pyarrow as pa
    texts = ["x" * n for n in (0, 5, 5, 50, 1, 1, 9, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], names=["i", "t"])
    parts = list(by_bytes([batch, batch.slice(0, 0)], 1, 10))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(9))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 10 for p in parts)


# -- 12 -----------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grow(nodes):
    """Root of a list of digests and, per node, (left, right) siblings level by level."""
    proofs, holders = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [list(range(a, min(a + 8, len(nodes)))) for a in range(0, len(nodes), 8)]
        for run in runs:
            for j in run:
                for i in holders[j]:
                    proofs[i].append(("".join(nodes[k] for k in run if k < j), "".join(nodes[k] for k in run if k > j)))
        nodes, holders = [sha(*[nodes[k] for k in run]) for run in runs], [[i for k in run for i in holders[k]] for run in runs]
    return (nodes or [None])[0], proofs


def plain_manifest(rows):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for name in names:
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[name] = (members, *grow([leaf(r, r[1]) for r in members]))
    root, above = grow([trees[n][1] for n in names])
    out = []
    for name, upper in zip(names, above):
        members, subroot, proofs = trees[name]
        for r, proof in zip(members, proofs):
            proof = proof + upper
            h = leaf(r, r[1])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                h = leaf(r, r[1].translate(small))
            for a, b in proof:
                h = sha(a, h, b)
            out.append((r[0], leaf(r, r[1]), subroot, root, sha(*[a + b for a, b in proof]), h, h == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [8, 4096])
def test_manifest_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(manifest, "CHUNK", chunk)
    rng = random.Random(12)
    rows = [(i, f"Text {i} É" if i % 2 else f"text {i}", rng.choice(["en", "en", "en", "de", None, "é", "z" * 5]), rng.choice(["a", None]), i) for i in range(700)]
    rows += [(1000, "Alone", "once", "a", 5)]
    found = sorted(map(tuple, manifest.verify(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert found == plain_manifest(rows)
    assert {r[6] for r in found} == {True, False}


@pytest.mark.parametrize("rows", [
    [], [(1, "One", "en", "a", 3)], [(None, None, None, None, None)],
    [(None, None, None, None, None)] * 20 + [(3, "ABC" * 50_000, "en", "a", 1), (3, "ABC" * 50_000, "en", "a", 1), (3, "", "en", "a", 1), (3, None, "en", "a", 1), (5, "x", "", "", 0)],
    [(i, "X", f"l{i}", "a", 1) for i in range(70)],                 # a language each: the tree above is the higher one
], ids=["empty", "one", "null", "repeats", "languages"])
def test_manifest_of_odd_rows(spark, rows):
    found = sorted(map(tuple, manifest.verify(clashing(spark, rows)).collect()), key=str)
    assert found == plain_manifest(rows)


# -- 13 -----------------------------------------------------------------------------------------

def plain_audit(rows, labels):
    fails, parts = [], {}
    for i, (doc_id, text, _, source, _n) in enumerate(rows):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        one = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
               "D": bool(re.search(r"[#$%&*|]", text)),
               "E": doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)}
        fails.append({k for k, v in one.items() if v})
        parts.setdefault(source or "", []).append(i)
    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    out = []
    for part, members in parts.items():
        shapley, found = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order):
                gone = [i for i in left if f in fails[i]]
                left = [i for i in left if f not in fails[i]]
                shapley[f] += len(gone)
                found.append((part, "".join(order), step + 1, len(left), len(gone), sum(f in fails[i] for i in members) - len(gone),
                              sum(fails[i] == {f} for i in members), sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


def audit_rows():
    rng, words = random.Random(13), ["word", "Word", "other", "more", "WORDS", "x|y", "a"]
    pool = [" ".join(rng.choice(words) if rng.random() < 0.6 else f"w{rng.random():.6f}" for _ in range(rng.choice([5, 199, 200, 300]))) for _ in range(12)]
    return [(i if i % 17 else None, rng.choice([*pool, None, "", f"unique {i}"]), "en", rng.choice(["s1", "s1", "s2", None, ""]), 0) for i in range(150)]


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(i, i % 2, (i // 3) % 2) for i in range(0, 150, 2)] + [(4, 0, 0), (4, 1, None), (None, 1, 1), (6, None, 1)]
    found = filter_audit.audit(clashing(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert sorted(map(tuple, found)) == plain_audit(rows, labels)


def test_audit_of_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = [(None, None, None, None, None)] * 3 + [(1, "", "en", "a", 0), (2, None, "en", "a", 0), (2, None, "en", "a", 0), (3, "Very " * 60_000, "en", "b", 0), (3, "Very " * 60_000, "en", "b", 0)]
    docs = clashing(spark, rows)
    found = sorted(map(tuple, filter_audit.audit(docs, none).collect()))
    assert found == plain_audit(rows, [])
    # Shapley values of all filters add up to the documents removed, in each of the orders
    lost = sum(r[4] for r in found if r[1] == "ABCDE")
    assert sum(r[9] for r in found if r[1] == "ABCDE") == math.factorial(5) * lost
    assert filter_audit.audit(docs.limit(0), none).count() == 0


def test_audit_multiplies_rows_after_the_shuffle(spark):
    """Sets of filters are laid out in the partition that the ids were dealt to."""
    rows = spark.range(1000).selectExpr("id AS row", "'p' AS part", "true AS good", "false AS toxic")
    fails = {f: spark.range(k, 1000, k + 2).selectExpr("id AS row") for k, f in enumerate("ABCDE")}
    kept, removals = filter_audit.interactions(rows, fails)
    for df in (kept, removals):
        plan = df._jdf.queryExecution().executedPlan().toString()
        above = [line for line in plan.splitlines() if "Generate explode" in line or "Exchange" in line]
        for i, line in enumerate(above):
            if "Generate" in line:
                assert "HashPartitioning".lower() in above[i + 1].lower() and "REPARTITION_BY_COL" in above[i + 1]
                assert "row" not in above[i - 1].split("hashpartitioning(")[-1].split(",")[0]


def test_letters_by_table_equal_the_pattern():
    odd = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for text in (odd, odd[::-1], " á b  c--d1eİ ", "́", "12"):
        flat = unicodedata.normalize("NFC", text).lower()
        want = f" {regex.sub(r'[^\p{L}\p{M}]+', ' ', flat).strip()} " if regex.search(r"\p{L}", text) else ""
        assert hyperlang.letters_of(text) == want


def test_profiles_take_few_sorts_and_no_table_of_bits(monkeypatch):
    """The signs of n-grams come from bytes of bits; an array of a bit each, turned into numbers, took most of the time."""
    def refuse(*_):
        raise AssertionError("bits were spread out")
    texts = [hyperlang.letters_of(t) for t in ("ab cd", "é中 \U0001d4d0x", "")]
    want = hyperlang.profiles(texts, 256)
    monkeypatch.setattr(hyperlang, "gram_bits", refuse)
    assert np.array_equal(hyperlang.profiles(texts, 256), want) and want[:2].any(axis=1).all() and not want[2].any()
