"""Queries that train run at the length their operators state."""

import __spark_entry__  # noqa: F401
from catalog import queries
from textmill.operators import topics as T
from textmill.plans import benchmark

ROWS = [(i, 0, "A" if i % 2 else "B", f"{'apple pear' if i % 2 else 'car bus'} {'plum' * (i % 3)}") for i in range(30)]


def labelled_rows(spark):
    return spark.createDataFrame(ROWS, "doc_id long, sent_idx int, label string, norm string")


def test_library_benchmark_is_trained_at_full_length(spark, monkeypatch):
    lengths = []
    monkeypatch.setattr(queries, "labelled", lambda *_: labelled_rows(spark))
    trained = benchmark.M.train_multinomial
    monkeypatch.setattr(benchmark.M, "train_multinomial", lambda *a, max_iter, **k: lengths.append(max_iter) or trained(*a, max_iter=2, **k))
    assert {r.label for r in queries.library_benchmark(spark, "").collect()} >= {"A", "B", "accuracy"}
    assert lengths == [1000]


def test_top_words_are_those_of_a_whole_training(spark, monkeypatch):
    updates = []
    monkeypatch.setattr(queries, "normalized", lambda *_: labelled_rows(spark))
    update = T.update_topics
    monkeypatch.setattr(T, "update_topics", lambda *a, **k: updates.append(k.get("steps", 100)) or update(*a, **k))
    rows = queries.topic_top_words(spark, "").collect()
    assert updates == [100] * 10
    assert {r.topic for r in rows} == set(range(10)) and {r.term for r in rows} >= {"apple", "pear", "car", "bus"}
