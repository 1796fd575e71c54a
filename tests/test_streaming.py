from textmill.functions import text as X
from textmill.operators import features as V
from textmill.operators import models as M
from textmill.streaming.score import make_scorer, score_lines, score_prompts, score_stream


def trained(spark):
    rows = [(i, 0, label, words.split()) for i, (label, words) in enumerate(
        [("Colony PCR", "band gel size"), ("DNA Extraction", "lysis buffer wash"), ("Colony PCR", "gel band")] * 4)]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, label string, terms array<string>")
    features, _ = V.tfidf_fit(df, "terms", 50)
    model = M.train_ovr_gd(V.transform(features, df), len(features.stages[0].vocabulary), epochs=20)
    return features, model


def test_stream_equals_batch(spark, tmp_path):
    scorer = make_scorer(*trained(spark), ["Colony PCR", "DNA Extraction"])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("gel band here; lysis with COLONY PCR buffer\n\n ; \n")
    (tmp_path / "in" / "b.txt").write_text("wash the buffer\n")
    batch = score_prompts(spark.read.text(str(tmp_path / "in")), scorer).select("value", "prediction").collect()
    run = score_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), scorer)
    run.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).select("value", "prediction")
    assert sorted(out.collect()) == sorted(batch)
    assert {r.value: r.prediction for r in batch} == {
        "gel band here": "Colony PCR", "lysis with COLONY PCR buffer": "DNA Extraction", "wash the buffer": "DNA Extraction"}
    # New files only: a second run appends what arrived since.
    (tmp_path / "in" / "c.txt").write_text("gel\n")
    score_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), scorer).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(batch) + 1


def test_scoring_skips_the_normaliser_unless_asked(spark):
    features, model = trained(spark)
    lines = spark.createDataFrame([("ge-l ba-nd",), ("  ",)], "value string")
    raw = score_lines(lines, make_scorer(features, model, [])).collect()
    clean = score_lines(lines, make_scorer(features, model, [], normalize=True)).collect()
    assert len(raw) == len(clean) == 1
    assert clean[0].score > raw[0].score


def test_library_model_scores_lines(spark):
    features, _ = trained(spark)
    df = spark.createDataFrame([("A", ["gel"]), ("B", ["wash"])] * 3, "label string, terms array<string>")
    model = M.train_multinomial(V.transform(features, df.coalesce(1)), max_iter=8)
    lines = spark.createDataFrame([("the gel",), ("wash",)], "value string")
    got = score_lines(lines, make_scorer(features, model, [], terms=X.terms_word2)).collect()
    assert [r.prediction for r in got] == ["A", "B"]
