"""Main text, ZIP directories, WARC records and preference pairs."""

import io
import random
import time
import zipfile

import pytest

import tickflow.llm.queries as llm
from checks.compare import difference
from tickflow.llm import preferences, wrapper, zip_archives
from tickflow.llm.scratch import Scratch


def page(main, menu="A B", extra=""):
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li>{menu}</li></ul></nav>"
            f"<div id=c><div class='cookie-notice'>We use cookies</div>{main}<div class=legend>Printed on recycled pixels</div></div>"
            f"<div class='promo'>buy {extra}</div><form><p>mail?</p></form><footer>&copy; me</footer></body></html>")


def test_text_of_one_page():
    source = page("<article><header><h1>Head &amp; tail</h1></header><p><b>One<br><p>Two  \n two&nbsp;x &am <i>in</i>line<ul><li>a<li>b</ul>"
                  "<section class=comments><p>nice!</section></article>")
    blocks = [t for _, _, t in wrapper.aligned_blocks(wrapper.Page(source), wrapper.Page(source))]
    assert blocks == ["Head & tail", "One", "Two two x &am inline", "a", "b", "Printed on recycled pixels"]


def test_template_and_container_of_a_host(spark):
    """A line that stands on all pages of a host is template though no element says so; a single page keeps all it has."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, want = [], {}
    for i in range(12):
        parts = [" ".join(word() for _ in range(20)) for _ in range(rng.randint(1, 5))]
        main = f"<h2>{parts[0][:10]}</h2>" + "".join(f"<p>{p}</p>" for p in parts)
        rows.append((i, f"https://host.example/{i}", page(main, menu=word(), extra=word())))
        want[i] = "\n".join([parts[0][:10].strip(), *parts])
    rows.append((50, "https://alone.example/", page("<p>only one</p>")))
    want[50] = "only one\nPrinted on recycled pixels"
    rows += [(60 + i, "https://copies.example/", page("<p>the same</p>")) for i in range(8)]
    want |= {60 + i: "the same\nPrinted on recycled pixels" for i in range(8)}
    got = wrapper.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == want
    assert all(r.n_chars == len(r.text) for r in got.collect())


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def extracted(spark, rows):
    return {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}


def test_all_slots_of_a_host_are_text(spark):
    """Pages of another layout than most of their host keep their text, and so does the part of an article outside its body."""
    rng = random.Random(2)
    rows, want = [], {}
    for i in range(40):
        kind = ("<article class='post'>", "</article>") if i % 20 < 17 else ("<article class='featured post'>", "</article>") if i % 20 < 19 else (
            "<div class='entry'>", "</div>")
        head, lead, body = words(rng, 3), words(rng, 15), words(rng, 85)
        rows.append((i, f"https://mixed.example/{i}", page(f"{kind[0]}<p>{body}</p>{kind[1]}")))
        want[i] = body
        rows.append((100 + i, f"https://split.example/{i}", page(
            f"<article><header><h1>{head}</h1></header><section class=lead><p>{lead}</p></section><section class=body><p>{body}</p></section></article>")))
        want[100 + i] = "\n".join([head, lead, body])
    assert extracted(spark, rows) == want


def test_words_are_hints(spark):
    """A word of class or id drops no element that holds most of the text, on whichever pages of a host it stands."""
    rng = random.Random(4)
    rows, want = [], {}
    kinds = {"body": "<body class='has-sidebar'>{}</body>", "html": "<html class='with-menu'><body>{}</body></html>",
             "div": "<body><div id='content' class='with-nav'>{}</div></body>", "article": "<article id='comment-on-social-policy'>{}</article>",
             "main": "<main class='no-sidebar related'>{}</main>", "banner": "<body class='banner'>{}</body>",
             "inline": "<body><font class='promo'>{}</font></body>",
             "mixed": "<body><div class=entry>{}</div></body>"}
    for k, (name, form) in enumerate(kinds.items()):
        for i in range(20):
            text = [words(rng, rng.randint(8, 30)) for _ in range(3)]
            main = "".join(f"<p>{t}</p>" for t in text)
            advert = "" if name == "inline" else f"<div class=ad>{words(rng, 6)}</div><div class='sidebar'><p>{words(rng, 9)}</p></div>"
            if name == "mixed" and i < 3:
                form_ = kinds["div"]
            elif name == "mixed" and i == 19:  # one advert longer than its page is still an advert
                form_, main, text, advert = form, "<p>short</p>", ["short"], f"<div class=ad>{words(rng, 12)}</div>"
            else:
                form_ = form
            rows.append((100 * k + i, f"https://{name}.example/{i}", form_.format(main + advert)))
            want[100 * k + i] = "\n".join(text)
    assert extracted(spark, rows) == want


@pytest.mark.parametrize("first", [None, "", "  ", "plain", "<p>gone", "<section><p>moved"])
def test_template_the_axis_page_lacks(spark, first):
    """Whatever the page of the least id holds, a line on 60 % of the pages of a host is template; one on 40 % is not."""
    rng = random.Random(3)
    rows, want = [(0, "https://host.example/0", first)], {0: (first or "").strip().split(">")[-1]}
    for i in range(1, 21):
        body = [words(rng, 8) for _ in range(rng.randint(1, 4))]
        often, seldom = "<div>Closed on Mondays</div>" * (i % 5 > 1), "<section>Now with maps</section>" * (i % 5 < 2)
        rows.append((i, f"https://host.example/{i}", f"<body><div>{words(rng, 1)}</div>{often}{seldom}" + "".join(f"<p>{b}</p>" for b in body)))
        want[i] = "\n".join([rows[-1][2][11:17], *["Now with maps"] * (i % 5 < 2), *body])
    assert extracted(spark, rows) == want


@pytest.mark.parametrize("tag, rest", [
    ("<i title=don't>", "rest"), ("<i title=don't>", "it's"), ('<i title="don\'t>', "rest"), ("<i title='a<b>c' id=x>", "rest"), ('<i a"b>', "rest"),
    ("<i '>", "it's"), ("<i title = don't class=y>", "it's"), ("<i title=\"x>y\"data-a='>'>", "rest"), ("<i title=>", "rest"), ("<i = =x>", "rest"),
    ("<i\ntitle=5'>", "6' tall")])
def test_stray_quotes_drop_no_text(tag, rest):
    assert [t for _, t in wrapper.Page(f"<p>a</p><p>b {tag}{rest}</i></p><p>c</p>").blocks] == ["a", f"b {rest}", "c"]


def test_tree_match_is_largest():
    """Against all order-preserving matches of two small forests."""
    rng = random.Random(5)

    def tree(depth):
        return "".join(f"<{t}>{tree(depth - 1) if depth else ''}</{t}>" for t in rng.choices(["div", "section", "ul"], k=rng.randint(0, 3)))

    def best(a, b, x, y):
        def rows(i, j):
            if i == len(x) or j == len(y):
                return 0
            skip = max(rows(i + 1, j), rows(i, j + 1))
            if a.label[x[i]] != b.label[y[j]]:
                return skip
            return max(skip, 1 + best(a, b, a.children[x[i]], b.children[y[j]]) + rows(i + 1, j + 1))
        return rows(0, 0)

    for _ in range(60):
        a, b = wrapper.Page(tree(2)), wrapper.Page(tree(2))
        found = wrapper.tree_match(a, b)
        assert len(found) == 1 + best(a, b, a.children[0], b.children[0])
        assert all(a.label[x] == b.label[y] for y, x in found.items()) and len(set(found.values())) == len(found)


def test_common_subsequence_is_longest(monkeypatch):
    rng = random.Random(6)

    def length(x, y):
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                best[i + 1][j + 1] = best[i][j] + 1 if x[i] == y[j] else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    for bits in (1 << 20, 8):
        monkeypatch.setattr(wrapper, "TABLE_BITS", bits)
        for _ in range(200):
            x, y = (rng.choices("abcd", k=rng.randint(0, 20)) for _ in range(2))
            found = wrapper.common_subsequence(x, y)
            assert all(x[i] == y[j] for i, j in found) and len(found) == length(x, y)
            assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:]))


def test_long_lists_match_in_order(monkeypatch):
    """Lists cut at common subsequences give an order-preserving match of equal labels, the largest where little differs."""
    rng = random.Random(7)
    item = lambda: rng.choice(["<div><p></p></div>", "<div></div>", "<div><ul><li></ul></div>", "<p></p>"])
    for _ in range(30):
        items = [item() for _ in range(rng.randint(0, 30))]
        changed = [x for x in items if rng.random() > 0.1]
        a, b = wrapper.Page("".join(items)), wrapper.Page("".join(changed))
        exact = wrapper.tree_match(a, b)
        monkeypatch.setattr(wrapper, "EXACT", 0)
        cut = wrapper.tree_match(a, b)
        monkeypatch.undo()
        assert len(exact) == len(b.label) == len(cut)  # one is a part of the other
        assert all(a.label[x] == b.label[y] for y, x in cut.items()) and len(set(cut.values())) == len(cut)
        tops = [cut[y] for y in b.children[0] if y in cut]
        assert tops == sorted(tops)


def test_match_is_the_same_at_every_size(monkeypatch):
    """By pairs or by rows, and however few rows are held, the match is the largest one, and of several the same."""
    rng = random.Random(9)

    def tree(depth):
        return "".join(f"<{t}>{tree(depth - 1) if depth else ''}</{t}>" for t in rng.choices(["div", "section", "ul"], k=rng.randint(0, 4)))

    for _ in range(150):
        a, b = wrapper.Page(tree(rng.randint(0, 3))), wrapper.Page(tree(rng.randint(0, 3)))
        by_pairs = wrapper.tree_match(a, b)
        monkeypatch.setattr(wrapper, "EXACT", 0)
        by_rows = wrapper.tree_match(a, b)
        monkeypatch.setattr(wrapper, "TABLE_BYTES", 40, raising=False)
        monkeypatch.setattr(wrapper, "KNOWN_BYTES", 1, raising=False)
        assert by_pairs == by_rows == wrapper.tree_match(a, b)
        monkeypatch.undo()


def test_long_lists_match_as_well_as_short_ones():
    """Equal small subtrees that cross a large, nearly equal one do not take its place, however many children there are."""
    for n in (3, 300):
        large = "<div>" + "<p></p>" * n + "{}</div>"
        small = "<div><ul></ul></div>"
        a, b = wrapper.Page(large.format("<ul></ul>") + small), wrapper.Page(small + large.format("<dl></dl>"))
        assert len(wrapper.tree_match(a, b)) == n + 2


def test_wide_pages_take_time_by_their_size():
    rng = random.Random(8)
    same = "<div><p>x</div>" * 20_000
    mixed = ["".join(rng.choice(["<div><p>x</div>", "<div><ul><li>y</ul></div>", "<div class=c>z</div>", "<section><p>t</section>"]) for _ in range(20_000))
             for _ in range(2)]
    for a, b in ((same, same + "<p>end"), mixed):
        a, b = wrapper.Page(a), wrapper.Page(b)
        began = time.perf_counter()
        assert len(wrapper.tree_match(a, b)) > 20_000
        assert time.perf_counter() - began < 5


def test_deep_and_broken_pages_keep_their_text():
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert [t for _, t in wrapper.Page(deep).blocks] == ["x"]
    assert len(wrapper.tree_match(wrapper.Page(deep), wrapper.Page(deep))) == 3001
    other = deep.replace("x", "<p>x</p>")
    assert len(wrapper.tree_match(wrapper.Page(deep), wrapper.Page(other))) == 3001
    assert [t for _, t in wrapper.Page("a < b <p>c<p class='x").blocks] == ["a < b", "c"]
    assert [t for _, t in wrapper.Page("<p>a<script>never closed <p>b").blocks] == ["a"]


@pytest.mark.parametrize("wide", [False, True])
def test_directories_of_zip_files(wide):
    file = io.BytesIO(b"junk before")
    file.seek(0, 2)
    with zipfile.ZipFile(file, "a") as out:
        for name, data in (("a", b"first"), ("dir/b", b"second"), ("c", b"")):
            with out.open(name, "w", force_zip64=wide) as member:
                member.write(data)
        out.comment = b"PK\x05\x06 looks like an end record"
    found = zip_archives.members(file, len(file.getvalue()))
    assert {n: zip_archives.read_range(file, s, k) for n, (m, s, k) in found.items()} == {"a": b"first", "dir/b": b"second", "c": b""}
    with pytest.raises(ValueError):
        zip_archives.members(io.BytesIO(b"no zip"), 6)


def test_zip64_end_record(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)  # the library then writes ZIP64 records
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as out:
        for k in range(5):
            out.writestr(f"m{k}", f"data {k}")
    assert b"PK\x06\x06" in file.getvalue()
    found = zip_archives.members(file, len(file.getvalue()))
    assert [zip_archives.read_range(file, *found[f"m{k}"][1:]) for k in range(5)] == [f"data {k}".encode() for k in range(5)]


def test_archives_round_trip(spark):
    rows = [(i, f"http://x/{i}\r\nX: y", t) for i, t in enumerate(["same", "same", "", "é\r\n\r\nWARC/1.1", None, "same", "x" * 300_000])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    scratch = Scratch(spark, "zip-test")
    packages = zip_archives.write_archives(pages, scratch.path("packages"), scratch, package_bytes=200)
    assert packages.agg({"n_records": "sum"}).first()[0] == len(rows)
    got = {r.page_id: r for r in zip_archives.read_archives(packages, payloads=True).collect()}
    assert sorted(got) == list(range(len(rows)))
    for i, _, t in rows:
        kind, first = (("revisit", 5) if i in (0, 1) else ("revisit", 4) if i == 2 else ("response", None))
        assert (got[i].record_type, got[i].refers_to, got[i].payload_bytes) == (kind, first, len((t or "").encode()))
        assert bytes(got[i].payload) == (b"" if kind == "revisit" else (t or "").encode())
    assert {r.record_type for r in zip_archives.read_archives(zip_archives.write_archives(pages, scratch.path("p"), scratch, min_payload=10)).collect()} == {"response"}


def test_pairs_by_opening(spark, tmp_path):
    import duckdb
    talk = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "short"), (2, 0, "system", "s"), (2, 1, "user", "q"), (2, 2, "assistant", "a longer one"),
            (3, 0, "system", "s"), (3, 1, "user", "q"), (3, 2, "assistant", "a longer one"), (3, 3, "user", "and?"), (4, 0, "user", "q"), (4, 1, "assistant", ""),
            (5, 0, "user", "q"), (6, 0, "assistant", "no question"), (7, 0, "user", "q"), (7, 1, "assistant", None)]
    turns = spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string")
    got = preferences.format_preferences(turns)
    pairs = {(r.chosen_id, r.rejected_id): r for r in got.where("kind = 'opening'").collect()}
    assert set(pairs) == {(2, 1), (2, 3), (4, 5)}  # 4 and 7 are equal: no preference
    one = pairs[2, 1]
    assert one.prompt == "<|system|>\ns<|end|>\n<|user|>\nq<|end|>\n" and one.chosen == "<|assistant|>\na longer one<|end|>\n"
    a, b = map(int, one.chosen_mask.split("-"))
    assert one.chosen[a:b] == "a longer one<|end|>\n"
    assert (pairs[2, 3].chosen, pairs[2, 3].chosen_mask, pairs[2, 3].rejected_mask) == ("", "", "")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", talk)
    assert difference(got, con, llm.ORACLES["op8_preference_pairs"]) is None


def test_common_and_rare_openings_give_the_same_pairs(spark, tmp_path):
    """Half of the conversations share one opening, others a few, in both ways to meet; ids at the ends of their type."""
    import duckdb
    rng = random.Random(3)
    talk = []
    for c in range(300):
        first = "hi" if c % 2 else f"question {c % 40}"
        talk += [(c, 0, "user", first), (c, 1, "assistant", "x" * rng.randint(0, 9))]
        if rng.random() < 0.3:
            talk.append((c, 2, "user", "more"))
    talk += [(i, 0, "user", "ends") for i in (2**63 - 1, -2**63)]
    turns = spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string")
    key = lambda df: sorted(map(repr, df.collect()))
    mixed, broadcast, joined = (preferences.format_preferences(turns, common=n) for n in (3, 10**6, 0))
    assert key(mixed) == key(broadcast) == key(joined)
    scratch = Scratch(spark, "pairs")
    pairs = preferences.pairs_by_opening(preferences.conversations(turns), scratch, 3)
    assert {r["common"]: r["count"] for r in pairs.groupBy("common").count().collect()} == {True: 149, False: 131}
    assert pairs.where(f"chosen_id = {-2**63} AND rejected_id = {2**63 - 1}").count() == 1
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [t for t in talk if 0 <= t[0] < 1000])
    assert difference(preferences.format_preferences(turns.where("conv_id BETWEEN 0 AND 999"), common=3), con, llm.ORACLES["op8_preference_pairs"]) is None
