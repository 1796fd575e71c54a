import math

import pytest
from pyspark.sql import functions as F

from textmill.operators import features as V

ROWS = [(1, 0, ["a", "b", "a"]), (1, 1, ["b", "c"]), (1, 2, ["zz"]), (1, 3, [])]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "doc_id long, sent_idx int, tokens array<string>")


def test_vocabulary_ties_in_term_order(spark, rows):
    got = V.build_vocabulary(rows, max_features=3).orderBy("idx").collect()
    assert [(r.term, r.idx, r.tf, r.df) for r in got] == [("a", 0, 2, 1), ("b", 1, 2, 2), ("c", 2, 1, 1)]


def test_unlimited_vocabulary_is_dense(spark, rows):
    got = V.build_vocabulary(rows, max_features=None).collect()
    assert sorted(r.idx for r in got) == [0, 1, 2, 3] and {r.term for r in got} == {"a", "b", "c", "zz"}


def test_idf_has_both_ones(spark, rows):
    vocab = V.fit_idf(rows, V.build_vocabulary(rows))
    got = {r.term: r.idf for r in vocab.collect()}
    assert got["b"] == pytest.approx(math.log(5 / 3) + 1) and got["a"] == pytest.approx(math.log(5 / 2) + 1)
    again = V.fit_idf(rows, V.build_vocabulary(rows).drop("df"))
    assert {r.term: r.idf for r in again.collect()} == pytest.approx(got)


def test_long_and_vector_forms_agree_and_norms_are_one(spark, rows):
    vocab = V.fit_idf(rows, V.build_vocabulary(rows, max_features=3))
    long = V.l2_normalize(V.tfidf(rows, vocab))
    vectors = V.to_long(V.transform(V.tfidf_model(vocab), rows))
    a = {(r.sent_idx, r.idx): r.weight for r in long.collect()}
    b = {(r.sent_idx, r.idx): r.weight for r in vectors.collect()}
    assert a == pytest.approx(b) and len(a) == 4
    norms = long.groupBy("sent_idx").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert [r.s for r in norms] == pytest.approx([1.0, 1.0])
    assert V.transform(V.tfidf_model(vocab), rows).count() == 4


def test_relative_frequency_counts_unknown_terms(spark, rows):
    vocab = V.fit_idf(rows, V.build_vocabulary(rows, max_features=1))
    got = V.tfidf(rows, vocab).first()
    assert got.weight == pytest.approx(2 / 3 * (math.log(5 / 2) + 1))


@pytest.mark.parametrize("hot", [1, 2, 100])
def test_lookup_with_hot_and_cold_terms(spark, rows, hot):
    vocab = V.build_vocabulary(rows)
    got = V.vocab_lookup(rows.select(F.explode("tokens").alias("term")), vocab, hot_rows=hot)
    assert sorted(r.term for r in got.collect()) == ["a", "a", "b", "b", "c", "zz"]


def test_feature_plan_has_no_shuffle(spark, rows):
    vocab = V.fit_idf(rows, V.build_vocabulary(rows))
    plan = V.transform(V.tfidf_model(vocab), rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
