"""The registered queries of the subpackage against their SQL, and edge cases common to all operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import tickflow.llm.queries as llm
from checks.compare import connect, difference
from conftest import SF
from tickflow.llm import (boosted_rules, bpe_counts, decontam, mixing, neardup, preferences, secret_scan, weak_labels, wrapper,
                          zip_archives)

WITH_SQL = sorted(llm.ORACLES)


def test_all_are_registered():
    found = {name.split("_")[0] for name in llm.QUERIES}
    assert found == {f"op{n}" for n in range(1, 14)}
    assert set(llm.QUERIES) <= set(entry.queries()) and set(llm.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_its_sql(spark, name):
    assert difference(llm.QUERIES[name](spark, SF), connect(SF), llm.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.ORACLES)))
def test_a_row_per_row(spark, name):
    table = "pages" if name.startswith("op2_") else "documents"
    assert llm.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, score string, target string, kept string, n_words string"
LABELS = "doc_id bigint, quality int, toxic int"


def odd_documents(spark, rows=None):
    """Nulls everywhere, empty and very long texts, repeated rows and clashing columns."""
    extra = (None, "x", "", "y", "z")
    long = " ".join(f"wort{i % 4000}" for i in range(60_000))
    rows = rows if rows is not None else [
        (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \t\n ", "en", "a", 4), (4, "one two", "en", "b", 7),
        (5, long, "en", "b", len(long)), (5, long, "en", "b", len(long)), (6, "one two", None, "b", 7), (None, "one two", "en", "c", 7),
        (7, "É ß 😀 — \x0b x", "fr", "c", 10)]
    return spark.createDataFrame([(*r, *extra) for r in rows], DOCS)


def labels(spark, rows=((1, 0, 0), (4, 1, 0), (4, 1, 0), (None, 1, 1), (5, None, None), (99, 1, 1))):
    return spark.createDataFrame(list(rows), LABELS)


def operators(spark):
    import public_tokenizers
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    bench = spark.createDataFrame([(1, "one two"), (2, None), (None, ""), (3, "one two")], "item_id bigint, text string")
    return {
        "rules": lambda d: boosted_rules.judge(d, boosted_rules.fit(d, labels(spark))),
        "weak": lambda d: weak_labels.classify(d, labels(spark)),
        "contamination": lambda d: decontam.contamination(d, bench),
        "neardup": neardup.near_duplicates,
        "mix": mixing.plan_of,
        "secrets": secret_scan.spans_of,
        "bpe": lambda d: bpe_counts.count_tokens(d, vocabulary),
    }


@pytest.mark.parametrize("name", ["rules", "weak", "contamination", "neardup", "mix", "secrets", "bpe"])
def test_odd_rows_and_empty_tables(spark, name):
    run = operators(spark)[name]
    docs = odd_documents(spark)
    got = run(docs)
    found = got.collect()
    assert len(found) == docs.count()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in docs.collect())
    # repeated rows agree
    twice = [r for r in found if r.doc_id == 5]
    assert twice[0] == twice[1]
    none = run(odd_documents(spark, []))
    assert none.count() == 0 and none.columns == got.columns


@pytest.mark.parametrize("stage", ["accept", "dedupe", "clean", "redact", "mix"])
def test_stages_on_odd_rows(spark, stage):
    """Columns and their values survive each stage, whatever their names; nulls, repeats and empty tables have defined results."""
    bench = spark.createDataFrame([(1, "one two"), (2, None)], "item_id bigint, text string")
    run = {"accept": lambda d: weak_labels.accepted_documents(d, labels(spark)), "dedupe": neardup.dedupe,
           "clean": lambda d: decontam.remove_contamination(d, bench), "redact": secret_scan.redact_documents, "mix": mixing.mix_documents}[stage]
    clash = ("accepted", "quality_score", "abuse_score", "secrets", "component_id", "row", "places", "copies", "_kept")

    def widened(d):
        for c in clash:
            d = d.withColumn(c, F.lit(f"mine {c}"))
        return d

    docs = widened(odd_documents(spark))
    out = run(docs)
    assert out.columns == docs.columns + ["copy"] * (stage == "mix")
    got = out.collect()
    assert all(r[c] == f"mine {c}" for r in got for c in clash)
    before = {str(tuple(r)[:4]) for r in docs.collect()}
    assert {str(tuple(r)[:4]) for r in got} <= before
    ids = sorted(str(r.doc_id) for r in got)
    if stage == "dedupe":  # 4, 6 and a row without an id are alike; rows without an id stay as one of them does
        assert ids == ["1", "2", "3", "4", "5", "5", "7", "None", "None"]
    elif stage == "clean":  # three texts are the item itself
        assert ids == ["1", "2", "3", "5", "5", "7", "None"]
    elif stage == "redact":
        assert ids == sorted(str(r.doc_id) for r in docs.collect())
    else:
        assert all(r.text and r.text.strip() for r in got)
    none = run(widened(odd_documents(spark, [])))
    assert none.count() == 0 and none.columns == out.columns


def test_odd_pages_and_conversations(spark):
    schema = "page_id bigint, url string, html string, text string, host string, blocks string"
    rows = [(None, None, None), (1, "", ""), (2, "http://H.example/x", "<p>a<p>b"), (2, "http://H.example/x", "<p>a<p>b"), (3, None, "plain"), (4, "bad url", "<")]
    pages = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    got = wrapper.extract(pages)
    assert sorted((str(r.page_id), r.text) for r in got.collect()) == sorted(
        [("None", ""), ("1", ""), ("2", "a\nb"), ("2", "a\nb"), ("3", "plain"), ("4", "<")])
    assert wrapper.extract(pages.limit(0)).count() == 0
    back = zip_archives.round_trip(spark, pages)
    assert back.count() == len(rows) and zip_archives.round_trip(spark, pages.limit(0)).count() == 0
    talk = "conv_id bigint, turn bigint, role string, text string, prompt string"
    turns = spark.createDataFrame([(None, 0, "user", "x", ""), (1, None, None, None, ""), (1, 0, "user", "hi", ""), (1, 0, "user", "hi", ""),
                                   (1, 1, "assistant", "answer", ""), (2, 0, "user", "", "")], talk)
    (pair,) = preferences.format_preferences(turns).collect()
    assert (pair.chosen_id, pair.rejected_id, pair.n_prefix, pair.kind) == (1, None, 2, "cut")
    assert preferences.format_preferences(turns.limit(0)).count() == 0
