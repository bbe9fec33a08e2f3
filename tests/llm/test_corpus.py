"""Operators on documents against brute force and by what they promise."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from conftest import SF
from tickflow.llm import boosted_rules, bpe_counts, components, decontam, mixing, neardup, secret_scan, weak_labels
from tickflow.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")


# -- 1 ------------------------------------------------------------------------------------------

def base_counts(text):
    words, windows, marked, seen, dup = WORD.findall(text), {}, set(), set(), 0
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            for i in places:
                marked.update(range(i, i + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked)]


def test_base_counts_equal_brute_force():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "b ", "a b ", "\n", " \n", "é%", "|", "\t", "\x0b", " ", "xx "]) for _ in range(rng.randint(0, 150))) for _ in range(400)]
    texts += ["", "a", "x " * 7, "x " * 8, "x " * 9, "a b c d e f g h i " * 3]
    counts, _ = boosted_rules.statistics(texts)
    assert counts.tolist() == [base_counts(t) for t in texts]


def test_trees_obey_their_signs_and_learn():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 2))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.3) | (rng.random(4000) < 0.05)).astype(float)
    free, bound = boosted_rules.fit_trees(x, y, [0, 0]), boosted_rules.fit_trees(x, y, [-1, 0])
    held = rng.random((2000, 2))
    want = (held[:, 0] < 0.5) & (held[:, 1] > 0.3)
    for model in (free, bound):
        assert ((model.score(held) > 0) == want).mean() > 0.95
    grid = np.stack([np.linspace(0, 1, 200), np.full(200, 0.7)], axis=1)
    assert (np.diff(bound.score(grid)) <= 1e-12).all()
    assert boosted_rules.fit_trees(x, np.ones(len(x)), [0, 0]).score(held).min() > 0  # one class: a constant


# -- 3 ------------------------------------------------------------------------------------------

def test_em_finds_good_labellers():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.8
    right = [0.95, 0.9, 0.6]
    votes = np.stack([np.where(rng.random(len(truth)) < 0.2, 0, np.where(rng.random(len(truth)) < p, 1, -1) * np.where(truth, 1, -1)) for p in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, found, good = weak_labels.estimate(patterns, counts)
    assert np.abs(found.mean(axis=1) - right).max() < 0.05 and abs(good - 0.8) < 0.05


def test_stems_of_every_run_of_letters_and_of_short_words():
    texts = ["you/idiot you IDIOT! abc12def x total-idiot", "", None, " \n", "é" * 100 + " Ab", "a b a b"]
    tokens = weak_labels.Tokens(texts)
    assert tokens.n.tolist() == [6, 0, 0, 0, 2, 4] and tokens.distinct().tolist() == [6, 0, 0, 0, 2, 2]
    for which, runs in ((0, [["you", "idio", "you", "idio", "abc", "def", "tota", "idio"], ["éééé", "ab"]]), (1, [[], ["éééééé"]])):
        doc, bucket = tokens.all_stems(which)
        for d, found in zip((0, 4), runs):
            chars = weak_labels.STEM_CHARS[which]
            assert sorted(bucket[(doc == d) & (bucket > 0)]) == sorted(weak_labels._bucket(f"{chars}:{r}", weak_labels.STEM_BITS) for r in found)
    # the whole outline makes the shape: equal beginnings of words longer than 64 characters don't hide their ends
    shapes = weak_labels.Tokens(["a" * 70, "a" * 70 + "%"]).fact("shape")
    assert shapes[0] != shapes[1]


def test_word_facts_don_t_depend_on_what_was_seen_before():
    texts = ["Some words, and/or more WORDS; some-thing else!!", "other words | and/or %% %%"]
    weak_labels._facts.clear()
    fresh = [weak_labels.Tokens([t]).per_doc(f)[0] for t in texts for f in weak_labels.WordFacts.FIELDS[:-1]]
    weak_labels.Tokens([f"w{i}/x{i}" for i in range(9000)])
    assert [weak_labels.Tokens([t]).per_doc(f)[0] for t in texts for f in weak_labels.WordFacts.FIELDS[:-1]] == fresh


def test_classifier_on_held_out_labels(spark):
    """Fitted on even labels, judged on odd ones."""
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = weak_labels.classify(docs, labels.where("doc_id % 2 = 0"), keep=["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.accepted for r in scored if r.quality == 1 and r.toxic == 0]
    junk = [r.accepted for r in scored if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(junk) < 0.05


# -- 4 ------------------------------------------------------------------------------------------

def test_repeated_rows_keep_to_the_training_bounds(spark, monkeypatch):
    """A row, or a labelled id, with many copies is one row of training and pushes no other out of the sample."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic")
    labelled = docs.join(labels.where("quality = 0"), "doc_id").select("doc_id", "text").orderBy("doc_id").limit(1)
    again = spark.range(400).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'' AS text").unionByName(labelled.crossJoin(spark.range(400)).drop("id"))
    seen = []
    features = weak_labels._features

    def recorded(rows, question):
        found = features(rows, question)
        seen.append(found[3])
        return found

    monkeypatch.setattr(weak_labels, "_features", recorded)
    weak_labels.fit(docs.unionByName(again), labels, max_training=40)
    assert len(seen) == 2
    assert all(len(target) <= 40 for target in seen) and len(seen[0]) > 20  # of both classes
    trained = []
    monkeypatch.setattr(boosted_rules, "fit_trees", lambda features, target, signs: trained.append(len(target)))
    boosted_rules.fit(docs.unionByName(again), labels)
    assert trained == [docs.join(labels.where("quality IS NOT NULL"), "doc_id").select("doc_id").distinct().count()]


def brute_contamination(texts, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (hits := windows.get(tuple(w[i:i + n]))):
                    hit.update(range(i, i + n))
                    found |= hits
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_automaton_equals_brute_force(spark, block_bytes):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice("a b c É dd".split()) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 5, 9, 10, 11, 14, 30]) if i else 7)) for i in range(12) if i != 1]
    items = [(i, t) for i, t in items if len(t.split()) != 1] + [(77, items[-1][1])]  # one text twice
    texts = [text(rng.randint(0, 60)) for _ in range(150)] + ["A, " + items[5][1].upper().replace("é", "É") + "!", ""]
    docs = documents(spark, texts)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:] for r in decontam.contamination(docs, bench, block_bytes=block_bytes).collect()}
    assert [got[i] for i in range(len(texts))] == brute_contamination(texts, items)


def test_spans_are_cut_and_covered_documents_dropped(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    before, after = "Some words that stay here, some more of them.", "And the end of it stays as well, as it should."
    docs = documents(spark, [f"{before} ALPHA {item[6:]}! {after}", item, "clean text", None])
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    out = decontam.remove_contamination(docs, bench)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got) == [0, 2, 3] and got[2].text == "clean text" and got[3].text is None
    assert got[0].text == f"{before} \n! {after}" and got[0].n_chars == len(got[0].text)
    assert decontam.contamination(out, bench).where("contaminated").count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_cut_documents_equal_brute_force(spark, block_bytes):
    """Spans of items of any block are cut at once, then those that cutting made, until none is left."""
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("a b c É dd".split()) for _ in range(n))
    items = [(i, text(rng.choice([4, 5, 9, 10, 11, 14, 30]))) for i in range(8)]
    texts = [text(rng.randint(0, 60)) for _ in range(120)] + [items[0][1], f"x {items[1][1]} y z", "", None]
    rows = [(i, t, "mine", "mine", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string, cut string, n_chars bigint")
    out = decontam.remove_contamination(docs, spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=block_bytes)
    assert out.columns == docs.columns
    automaton = decontam.SuffixAutomaton([(i, t.encode()) for i, t in items])
    want = {}
    for i, t in enumerate(texts):
        ((n, mask, _),) = decontam._match([t.encode() if t else None], automaton)
        if mask.sum() <= 0.8 * n:
            want[i] = decontam._cleaned(t.encode(), mask, automaton).decode() if mask.any() else t
    got = out.collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) < len(texts)
    assert all(r.n_chars == len(r.text or "") and r.row == r.cut == "mine" for r in got)
    assert all(not brute_contamination([r.text], items)[0][4] for r in got)


# -- 5 ------------------------------------------------------------------------------------------

def brute_components(texts, percent=75):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    low = list(range(len(texts)))
    find = lambda x: x if low[x] == x else find(low[x])
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                low[y] = x
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


@pytest.mark.parametrize("block", [1024, 8])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    """Also where buckets are compared in many blocks. A family of near copies of one text (most not alike to each other), chains, copies, short texts."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    texts = []
    for _ in range(400):
        w = list(base)
        for _ in range(rng.randint(0, 12)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 10 ** 6)}"
        texts.append(" ".join(w))
    chain = [f"c{i}" for i in range(60)]
    texts += [" ".join(chain[i * 2:i * 2 + 40]) for i in range(10)]
    texts += ["one two", "One TWO", "one two three", "", None, " \t", "É a b c d", "é a b c d", *texts[:5]]
    rng.shuffle(texts)
    got = neardup.near_duplicates(documents(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute_components(texts)
    kept = neardup.dedupe(documents(spark, texts))
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [i for i, _, _, k in brute_components(texts) if k]


def test_every_pair_within_the_signature_distance_meets():
    """23 differing symbols of 48, wherever they are, leave a common key."""
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (500, neardup.SYMBOLS), dtype=np.uint64)
    b = a.copy()
    for row in b:
        row[rng.choice(neardup.SYMBOLS, 23, replace=False)] ^= np.uint64(1)
    assert all(set(x) & set(y) for x, y in zip(neardup.index_keys(a).tolist(), neardup.index_keys(b).tolist()))


def test_intersections_by_products():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 90)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = neardup.intersections(sets, columns=16)
    assert all(got[i, j] == want[i][j] for i in range(40) for j in range(40) if i != j)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(7000, 7000)] + [(5000 + 2 * i, 5001 + 2 * i) for i in range(50)]
    names = {n: rng.randint(-10 ** 9, 10 ** 9) for e in edges for n in e}
    rows = [(names[a], names[b]) for a, b in edges]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(rows, "u bigint, v bigint"), Scratch(spark, "t")).collect()}
    want = {}
    for group in (range(201), range(1000, 1300), *((5000 + 2 * i, 5001 + 2 * i) for i in range(50))):
        least = min(names[n] for n in group)
        want |= {names[n]: least for n in group}
    assert got == want


# -- 6 ------------------------------------------------------------------------------------------

def test_mix_meets_targets_and_reruns_agree(spark):
    rng = random.Random(9)
    rows = [(i, " ".join("w" * rng.choice([1, 3, 40])), "en", rng.choice(["a", "b", "B", None, "hot", "hot", "hot"]), 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mixing.plan_of(docs).collect()
    size = {i: len(t.split()) for i, t, *_ in rows}
    per = {}
    for r in got:
        assert r.size == size[r.doc_id] and r.taken in (0, r.size, 2 * r.size)
        per.setdefault(r.source, []).append(r)
    # targets by resharing the excess again and again
    order = sorted((s for s in per if s is not None)) + [None]
    caps = {s: 2.0 * sum(r.size for r in per[s]) for s in order}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(size.values()), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > caps[s]}
        target |= {s: caps[s] if s in over else share[s] for s in open_}
        left -= sum(caps[s] for s in over)
        open_ = open_ - over if over else set()
    for s, group in per.items():
        assert {r.source_size for r in group} == {int(caps[s] / 2)}
        assert abs(group[0].target - target[s]) < 1e-6 * max(1, target[s])
        assert abs(sum(r.taken for r in group) - target[s]) <= max(r.size for r in group)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.plan_of(docs.repartition(7)).collect()), key=str)
    mixed = mixing.mix_documents(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed} == {r.doc_id: r.copies for r in got if r.copies}


# -- 7 ------------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(10)
    parts = ["token", "Secret", "API_KEY", "apikey", "passwd", "=", ":", " ", '"', "'", "abc", "é", "😀", "AKIA", "A1" * 8, "0f" * 12, "a" * 23, "z", "-", ".", "\n", "ſecret", "toKen"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(600)] + ["secret=token = abcdefg", "token==abcdef", ""]
    got = {r.doc_id: r for r in secret_scan.spans_of(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, got[i].spans, want)
        assert set(want.split(",")) - {""} <= set(got[i].spans.split(","))


def test_ownership_separates_examples_from_live_ones(spark):
    example, live, opaque = "0123456789abcdef" * 2, "fedcba9876543210" * 2, "Zk3Jq9Xw2Lm8Np5Rt7Vb1Yc4Hd6"
    rows = [(i, f"see {example} there", "en", f"owner{i}", 0) for i in range(8)]
    rows += [(8 + i, f"my {live} here {opaque}", "en", "owner1", 0) for i in range(4)]
    rows += [(20 + i, f"{'Ab1' * 10} is everywhere", "en", f"owner{i}", 0) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: [(s.kind, s.verdict) for s in r.secrets] for r in secret_scan.find_secrets(docs).collect()}
    assert got[0] == [("hex", "example")] and got[8] == [("hex", "live"), ("opaque", "live")] and got[20] == []
    text = {r.doc_id: r.text for r in secret_scan.redact_documents(docs).collect()}
    assert text[0] == "see <hex:example> there" and text[8] == "my <hex:live> here <opaque:live>"


def test_names_are_no_secrets(spark):
    """Paths, slugs, UUIDs, order codes and identifiers of code stay; generated strings are found."""
    rng = random.Random(12)
    names = ["/docs/2021/05/getting-started-with-Spark-3", "550E8400-e29b-41d4-A716-446655440000", "ORDER-2024-XK99-0042-ZZ81-7", "getUserByIdAndName2FromTheTable",
             "a-long-slug-of-Many-words-and-1-number", "src/main/java/org/Example/Parser2Test", "A" * 30 + "b1", "MAX_LEN_OF_THE_Buffer_0123456789"]
    made = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(rng.randint(24, 60))) for _ in range(400)]
    docs = documents(spark, [f"see {t} there" for t in names + made])
    found = {r.doc_id: r.spans for r in secret_scan.spans_of(docs).collect()}
    assert not [names[i] for i in range(len(names)) if "opaque" in found[i]]
    assert sum("opaque" in found[i] for i in range(len(names), len(found))) >= 0.97 * len(made)


def test_many_spans_in_a_text(spark):
    """A text of 100 000 spans, more than are handled in one run, and columns named like what the operator makes."""
    n = 100_000
    many = "".join(f"é token={k:06d}\n" for k in range(n))
    rows = [(0, many, "mine", 1), (1, "é token=123456 password=token=abcdefgh", "mine", 2), (2, None, "mine", 3), (3, "", "mine", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, secrets string, _spans int").selectExpr("*", "'en' lang", "'s' source", "0L n_chars")
    out = secret_scan.redact_documents(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].text == "é <assign:live>\n" * n and got[0].n_chars == len(got[0].text)
    assert got[1].text == "é <assign:live> <assign:live>" and got[2].text is None and got[3].text == ""
    assert all(r.secrets == "mine" and r._spans == k + 1 for k, r in got.items())
    spans = {r.doc_id: r.spans for r in secret_scan.spans_of(docs).collect()}
    assert spans[0] == ",".join(f"assign:{15 * k + 2}:{15 * k + 14}" for k in range(n))


# -- 10 -----------------------------------------------------------------------------------------

def test_counts_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, ours = Tokenizer.from_file(path), bpe_counts.PairMerger(open(path, encoding="utf-8").read())
    rng = random.Random(11)
    parts = [*"abcAÉéßΣσς'’ \t\n0123²½Ⅷ<|>\x85", "́", "​", "İ", "K", "한국", "中", "😀", "_-.,!?#", "<|startoftext|>", "<|endoftext|>", "'ll", "'S", " the ", "ﬁ", "x" * 300]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert ours.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


# -- pipeline -----------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, before = Scratch(spark, "stages"), docs
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.keep(stage(spark, before, SF), name)
        if name != "mix":
            assert after.columns == docs.columns
        if name == "near_dedup":
            assert neardup.near_duplicates(after).where("not kept").count() == 0
        if name == "decontamination":
            assert decontam.contamination(after, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count() == 0
        if name == "secret_scan":
            assert secret_scan.spans_of(after).where("spans <> ''").count() == 0
        if name in ("decontamination", "secret_scan"):
            assert after.count() >= 0.95 * before.count()
        before = after
    words = "size(regexp_extract_all(text, '[^ ]+', 0))"
    assert before.count() > 0 and before.where(f"{words} = 0").count() == 0
