import pytest
from pyspark.sql import functions as F

from textmill.operators import corpus as C
from textmill.operators.annotate import annotation_prompts, parse_replies
from textmill.operators.ranking import rank_within, top_per_group
from textmill.plans.annotator import annotator_report
from textmill.plans.build import collect_corpus, preprocess_corpus
from textmill.runtime import small_table


def test_missing_text_is_dropped(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "doc_id long, text string")
    assert [r.doc_id for r in C.drop_missing_text(df).collect()] == [3]


def test_sentences_empty_after_normalising_are_dropped(spark):
    df = spark.createDataFrame([(1, 0, "The 42 of -- 7."), (1, 1, "Cells grew")], "doc_id long, sent_idx int, sentence string")
    assert [r.norm for r in preprocess_corpus(df).collect()] == ["cells grew"]
    assert [r.norm for r in C.drop_empty_norm(C.normalize_text(df)).collect()] == ["cells grew"]


def test_normalising_happens_once_per_row(spark):
    df = spark.createDataFrame([(1, 0, "x")], "doc_id long, sent_idx int, sentence string")
    plan = preprocess_corpus(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_lemmas(spark):
    rows = [(1, 0, ["cells", "boxes", "women", "gas", "cells"]), (1, 1, ["data"])]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, tokens array<string>")
    lexicon = spark.createDataFrame([("cell",), ("cells",), ("box",), ("woman",), ("gas",)], "term string")
    got = C.lemmatize(df, lexicon).orderBy("sent_idx").collect()
    assert [r.norm for r in got] == ["cell box woman gas cell", "data"]


def test_labels_of_a_document_are_distinct_and_in_map_order(spark):
    hits = spark.createDataFrame([("k2", 1, "d"), ("k1", 9, "d"), ("k3", 1, "d"), ("k3", 2, "e")],
                                 "keyword string, rank long, doc_id string")
    got = C.labels_per_document(hits, {"k1": "A", "k2": "B", "k3": "A"}).orderBy("doc_id").collect()
    assert [(r.doc_id, r.labels) for r in got] == [("d", ["A", "B"]), ("e", ["A"])]


def test_collect_corpus(spark):
    hits = spark.createDataFrame([("k", r, f"d{r}") for r in range(1, 6)], "keyword string, rank long, doc_id string")
    docs = spark.createDataFrame([("d1", "one b"), ("d1", "one"), ("d2", None), ("d3", "three"), ("d5", "five")],
                                 "doc_id string, text string")
    got = collect_corpus(hits, docs, {"k": "K"}, cap=4, order=["text"]).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.labels) for r in got] == [("d1", "one", ["K"]), ("d3", "three", ["K"])]


def test_documents_without_hits_get_an_empty_list(spark):
    docs = spark.createDataFrame([("d",)], "doc_id string")
    labels = spark.createDataFrame([], "doc_id string, labels array<string>")
    assert C.attach_doc_labels(docs, labels).first().labels == []


def test_rank_and_top_of_a_hot_group(spark):
    df = spark.range(5000).select(F.lit("hot").alias("g"), "id").union(
        spark.range(3).select(F.lit("cold").alias("g"), "id"))
    ranked = rank_within(df, ["g"], F.floor(F.col("id") / 64), [F.col("id")], "r")
    assert ranked.filter("r <> id + 1").count() == 0 and ranked.count() == 5003
    top = top_per_group(df, ["g"], [F.col("id").desc()], 4).collect()
    assert sorted((r.g, r.id) for r in top) == [("cold", 0), ("cold", 1), ("cold", 2), *[("hot", i) for i in range(4996, 5000)]]


def test_rare_classes_dropped_or_merged(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",), ("Other",)], "label string")
    assert sorted(r.label for r in C.rare_classes(df).collect()) == ["B", "Other"]
    assert sorted(r.label for r in C.drop_rare_classes(df).collect()) == ["A", "A"]
    assert sorted(r.label for r in C.merge_rare_into_other(df).collect()) == ["A", "A", "Other", "Other"]


def test_strict_alignment_fails_on_a_missing_partner(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "idx int, s string")
    b = spark.createDataFrame([(1, "A"), (2, "B")], "idx int, l string")
    assert sorted(map(tuple, C.align_by_index(a, b, ["idx"]).collect())) == [(1, "x", "A"), (2, "y", "B")]
    with pytest.raises(Exception, match="same keys"):
        C.align_by_index(a, b.filter("idx = 1"), ["idx"]).collect()
    assert C.align_by_index(a, b.filter("idx = 1"), ["idx"], strict=False).count() == 1


def test_small_table_beyond_its_bound_is_written(spark):
    small, large = small_table(spark.range(5), 5), small_table(spark.range(6), 5)
    assert small.count() == 5 and large.count() == 6
    plan = [t._jdf.queryExecution().optimizedPlan().toString() for t in (small, large)]
    assert "LocalRelation" in plan[0] and "parquet" in plan[1]


def test_batches_and_prompts(spark):
    rows = [(1, i, f"s{i}") for i in (0, 3, 4, 9, 10)]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, sentence string")
    got = C.batch_rows(df, 2).orderBy("batch").collect()
    assert [r["items"] for r in got] == [["s0", "s3"], ["s4", "s9"], ["s10"]]
    prompts = annotation_prompts(df, {"kw": "L"}, 2).orderBy("batch").collect()
    assert "- kw = L\n" in prompts[0].prompt and prompts[1].prompt.endswith("3. s4\n4. s9\n")


def test_an_extra_reply_line_does_not_shift_later_rows(spark):
    labelled = spark.createDataFrame([(1, i, x) for i, x in enumerate("ABCD")], "doc_id long, sent_idx int, label string")
    replies = spark.createDataFrame([(1, 0, "A\nB\nextra"), (1, 1, "C, X\n\n D")], "doc_id long, batch long, reply string")
    assert parse_replies(replies, ["doc_id", "batch"], size=2).count() == 4
    report = annotator_report(labelled, replies, size=2)
    assert report.filter("label = 'accuracy'").first().f1 == 1.0
    partly = annotator_report(labelled, replies.filter("batch = 0"), size=2)
    assert partly.filter("label = 'accuracy'").first().f1 == 0.5


def test_lemmas_inside_rows_equal_the_joined_form(spark, monkeypatch):
    rows = [(1, 0, ["cells", "cell", "boxes"]), (1, 1, []), (None, 2, ["cells", "women", "cells"]), (None, 2, ["gas"]), (2, 0, None), (3, 1, ["woman", "box", "cell"])]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, tokens array<string>").repartition(2).cache()
    lexicon = spark.createDataFrame([("cell",), ("box",), ("woman",)], "term string")
    inside = C.lemmatize(df, lexicon)
    assert "Exchange" not in inside._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
    got = sorted(map(str, inside.select("doc_id", "sent_idx", "tokens", "norm").collect()))
    assert sum("'cell', 'woman', 'cell'" in r for r in got) == 1 and len(got) == 6
    monkeypatch.setattr(C, "LEMMA_ROWS", 0)
    keyed = df.where("doc_id IS NOT NULL")
    joined = C.lemmatize(keyed, lexicon).select("doc_id", "sent_idx", "tokens", "norm").collect()
    assert sorted(map(str, joined)) == [r for r in got if "doc_id=None" not in r]
