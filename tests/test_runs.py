import pytest

from textmill.operators import annotate, corpus as C, features as V, models as M
from textmill.plans.benchmark import benchmark_library, benchmark_ovr
from textmill.plans.build import preprocess_counted
from textmill.plans.runs import load_run, save_run


def rows(spark):
    words = {"A": "apple pear plum", "B": "car bus tram", "Other": "red blue pink"}
    data = [(i, 0, label, f"kw{label.lower()} {words[label]} {i % 3 * 'x'}") for i, label in enumerate(["A", "B", "Other"] * 20)]
    return spark.createDataFrame(data, "doc_id long, sent_idx int, label string, norm string")


def test_a_run_is_loaded_by_its_manifest_only(spark, tmp_path, monkeypatch):
    df, path = rows(spark), str(tmp_path / "run")
    run = benchmark_ovr(df, {"kwa": "A", "kwb": "B"}, epochs=5)
    with pytest.raises(ValueError, match="no complete run"):
        load_run(spark, path)
    save = M.OvrModel.save
    monkeypatch.setattr(M.OvrModel, "save", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        save_run(run, path, {"kwa": "A", "kwb": "B"})
    with pytest.raises(ValueError, match="no complete run"):
        load_run(spark, path)
    monkeypatch.setattr(M.OvrModel, "save", save)
    save_run(run, path, {"kwa": "A", "kwb": "B"}, {"seed": "42"})
    again = load_run(spark, path)
    assert again.labels == ["A", "B"] and again.settings == {"seed": "42"} and again.majority is None
    assert [tuple(r) for r in again.kwmap.orderBy("pos").collect()] == [(0, "kwa", "A"), (1, "kwb", "B")]
    ready = V.transform(run.features, df.selectExpr("*", "split(norm, ' ') AS terms")).drop("terms")
    key = lambda r: (r.doc_id, r.prediction, r.score)
    assert sorted(map(key, M.predict_ovr(again.model, ready).collect())) == sorted(map(key, M.predict_ovr(run.model, ready).collect()))
    library = benchmark_library(df, max_iter=5)
    save_run(library, path, {"kwa": "A"})
    again = load_run(spark, path)
    assert again.majority == library.majority and again.labels is None
    assert M.predict(again.model, library.train).collect() == M.predict(library.model, library.train).collect()


def test_counts_are_observed_while_rows_are_written(spark):
    docs = spark.createDataFrame([(1, "One cell. Two cells. The. "), (2, ""), (3, None), (4, "Three.")], "doc_id long, text string")
    stored, counts = preprocess_counted(docs)
    assert {r.stage: r.n for r in counts.collect()} == {"documents": 4, "with_text": 2, "sentences": 4, "kept": 3}
    assert stored.count() == 3


def test_all_terms_are_numbered_like_the_most_frequent(spark):
    df = spark.createDataFrame([(["b", "a", "c", "c"],), (["abc", "abd", "b", "é"],), (["c"],)], "tokens array<string>")
    top = V.build_vocabulary(df, max_features=100).select("term", "idx").collect()
    every = V.build_vocabulary(df, max_features=None)
    assert dict(every.dtypes)["idx"] == "bigint"
    assert sorted(map(tuple, every.select("term", "idx").collect())) == sorted(map(tuple, top))


def test_rows_without_partner_are_counted(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, a string")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (1, "z")], "k long, b string")
    assert {r.side: r.n for r in C.unpaired_rows(left, right, ["k"]).collect()} == {"left": 2, "right": 1}
    assert C.align_by_index(left, right, ["k"], strict=False).count() == 2


def test_prompts_refuse_a_map_that_no_prompt_can_list(spark):
    df = spark.createDataFrame([(1, 0, "a")], "doc_id long, sent_idx int, sentence string")
    with pytest.raises(ValueError, match="keywords"):
        annotate.annotation_prompts(df, {f"k{i}": "L" for i in range(annotate.MAX_KEYWORDS + 1)})
