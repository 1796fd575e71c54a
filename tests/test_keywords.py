import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textmill.functions import keywords as K
from textmill.operators import corpus as C
from textmill.runtime import materialize


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("r")).first().r


def test_substring_and_whole_word_differ(spark):
    assert one(spark, "Lada", K.contains_keyword("t", "la")) is True
    assert one(spark, "Lada", K.has_keyword("t", "la")) is False
    assert one(spark, "colony pcrs", K.contains_keyword("t", "colony PCR")) is True
    assert one(spark, "colony pcrs", K.has_keyword("t", "colony PCR")) is False


@pytest.mark.parametrize("text,keyword,found", [
    ("éa", "é", False), ("é a", "é", True), ("E. coli grew", "e. coli", True), ("xE. coli", "e. coli", False),
    ("a (b) c", "(b)", False), ("x(b)y", "(b)", True), ("my_la", "la", False), ("la", "LA", True),
    (chr(0x212A) + "it", "kit", True), ("Hau" + chr(0x17F), "haus", True), (r"a\Eb", r"a\Eb", True),
])
def test_word_boundaries(spark, text, keyword, found):
    assert one(spark, text, K.has_keyword("t", keyword)) is found
    assert one(spark, text, F.col("t").rlike(K.keyword_pattern(keyword))) is found


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab é_-.", min_size=1, max_size=8), min_size=1, max_size=20), st.text("ab.é", min_size=1, max_size=3))
def test_pattern_equals_a_plain_word_boundary_regex(spark, texts, keyword):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", K.has_keyword("t", keyword).alias("h"),
                    F.expr("t").rlike(K.keyword_pattern(keyword)).alias("p")).collect()
    plain = re.compile(r"\b" + re.escape(keyword) + r"\b", re.IGNORECASE)
    for row in got:
        assert row.h == row.p == bool(plain.search(row.t))


def test_pattern_column_equals_pattern(spark):
    words = ["e. coli", "(b)", "la", r"a\Eb", "é"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(K.pattern_column("w")).collect()] == [K.keyword_pattern(w) for w in words]


def test_labels_follow_map_order_and_repeat(spark):
    kwmap = {"b": "B", "a": "A", "c": "B"}
    df = spark.createDataFrame([(1, 0, "a b"), (1, 1, "c b"), (1, 2, "none")], "doc_id long, sent_idx int, norm string")
    rows = C.first_label(C.assign_labels(df, kwmap)).orderBy("sent_idx").collect()
    assert [r.labels for r in rows] == [["B", "A"], ["B", "B"], ["Other"]]
    assert [r.label for r in rows] == ["B", "B", "Other"]


def test_empty_label_list_is_other(spark):
    df = spark.createDataFrame([([],), (["X"],)], "labels array<string>")
    assert [r.label for r in C.first_label(df).collect()] == ["Other", "X"]


def test_hiding_keeps_spaces(spark):
    assert one(spark, "kw kw kw", K.hide_keywords("t", ["kw"])) == "  "
    assert one(spark, "kw kwx KW", K.count_keywords("t", ["kw"])) == 2


def test_own_keywords_only(spark):
    kwmap = {"a b": "L", "c": "L", "d": "M"}
    df = spark.createDataFrame([("L", "x a b c d"), ("M", "x a b c d"), ("Other", "d")], "label string, norm string")
    assert [r.norm for r in C.hide_own_keywords(df, kwmap).collect()] == ["x   d", "x a b c ", "d"]
    assert C.count_removed(df, kwmap).first().removed == 3


def test_label_names_in_three_casings(spark):
    text = "colony pcr Colony pcr COLONY PCR"
    assert one(spark, text, K.hide_label_names("t", ["Colony PCR"])) == " Colony pcr "


def by_limit(monkeypatch, work):
    """What `work` gives with the map compiled into the projection, and with the map joined."""
    literal = work()
    monkeypatch.setattr(C.keyword_pairs, "__defaults__", (0,))
    return literal, work()


@pytest.mark.parametrize("column", ["norm", "raw"])
def test_join_form_equals_literal_form(spark, monkeypatch, column):
    kwmap = {"b": "B", "a b": "AB", "B c": "B", "x-y": "Never", "c": "C", "a": "B", "gpl-3.0": "L", "e. coli": "E", "of gene": "G",
             "gene": "G", "--": "P", "(b)": "P", "ac": "P", "é": "B", "kit": "K", "ΟΔΟΣ": "S", "3.0": "L", ",": "P"}
    texts = ["a b c", "c", "z", "b b a b", "a c b", "x-y gpl-3.0", "GPL-3.0, of gene.", "E. COLI e.coli", "a--b a-- b", "a(b)c (b)",
             "", None, "É éa", chr(0x212A) + "it", "οδος οδοσ", "a,b a, b", "a--b a-- b"]
    rows = [(1 if i % 3 else None, i // 2, t, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, norm string, raw string")
    label = lambda: C.first_label(C.assign_labels(df, kwmap, column))
    every = lambda x: sorted(x.collect(), key=str)
    first = materialize(label())
    work = lambda: (every(label()), every(C.match_keywords(df, kwmap, column)),
                    every(C.hide_own_keywords(first, kwmap, column)), C.count_removed(first, kwmap, column).first())
    literal, joined = by_limit(monkeypatch, work)
    assert joined == literal and len(literal[1]) > 20


def test_hiding_may_join_words(spark, monkeypatch):
    kwmap = {"(b)": "P", "ac": "P", "x--y": "Q", "foo": "Q", "x": "R"}
    # Hiding "(b)" makes "ac"; hiding "foo" makes "x--y", which comes too late.
    df = spark.createDataFrame([("P", "a(b)c"), ("Q", "x-foo-y x--y"), ("R", "x x"), (None, "x")], "label string, norm string")
    literal, joined = by_limit(monkeypatch, lambda: sorted(C.hide_own_keywords(df, kwmap).collect(), key=str))
    assert joined == literal and ("P", "") in [tuple(r) for r in literal]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab é_-.", max_size=12), min_size=1, max_size=20),
       st.lists(st.text("abB.é-_ ", min_size=1, max_size=6), min_size=1, max_size=12, unique=True))
def test_any_map_size_gives_the_same_rows(spark, texts, keywords):
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id long, sent_idx int, norm string")
    kwmap = {k: k[0] for k in keywords}
    padded = {**kwmap, **{f"never{i}": "N" for i in range(501)}}
    for work in (lambda m: C.match_keywords(df, m), lambda m: C.mentions_any(df, m, "norm")):
        assert sorted(work(kwmap).collect()) == sorted(work(padded).collect())


def test_substring_search_equals_literal_form(spark, monkeypatch):
    texts = ["Lada Colony PCR", "colony pcrs", "x", "", None, "ab", "日本語 text", "aaaaaa", "ÉCOLE", "Lada Colony PCR"]
    df = spark.createDataFrame([(None if i % 2 else 1, t) for i, t in enumerate(texts)], "k int, sentence string")
    kwmap = {"la": 1, "colony PCR": 1, "本": 1, "aaaaa": 1, "école": 1, "B": 1, "nowhere at all": 1}
    literal, joined = by_limit(monkeypatch, lambda: sorted(C.mentions_any(df, kwmap).collect(), key=str))
    assert joined == literal and len(literal) == 7


def test_normalized_keywords_reach_more(spark):
    kwmap = {"next-generation sequencing": "NGS", "order dna fragments": "Order"}
    df = spark.createDataFrame([(1, 0, "nextgeneration sequencing run")], "doc_id long, sent_idx int, norm string")
    assert C.assign_labels(df, kwmap).first().labels == ["Other"]
    assert C.assign_labels(df, kwmap, normalized_keywords=True).first().labels == ["NGS"]
