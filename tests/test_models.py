import math

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from textmill.functions import text as X
from textmill.operators import features as V
from textmill.operators import models as M
from textmill.operators.split import stratified_split
from textmill.operators.split import test_shares as shares_of
from textmill.plans.benchmark import benchmark_library, benchmark_ovr
from textmill.plans.topics import topic_report


def labelled(spark, sizes):
    rows = [(i, n, label) for label, size in sizes.items() for n, i in enumerate(range(size))]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, label string")
    return df.withColumn("doc_id", F.xxhash64("label", "doc_id"))


@pytest.mark.parametrize("sizes", [{"A": 5}, {"A": 50, "B": 3, "C": 2}, {"A": 700, "B": 11, "C": 7, "D": 7, "E": 2}])
def test_split_is_complete_and_proportional(spark, sizes):
    df = labelled(spark, sizes)
    got = stratified_split(df)
    assert got.count() == sum(sizes.values())
    tests = {r.label: r.n for r in got.filter("split = 'test'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sum(tests.values()) == math.ceil(0.2 * sum(sizes.values()))
    for label, n in sizes.items():
        assert abs(tests.get(label, 0) - 0.2 * n) <= 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stratified_split(df.repartition(7)).collect()))
    assert stratified_split(df, seed=1).exceptAll(got).count() > 0


def test_split_refuses_single_rows(spark):
    with pytest.raises(ValueError, match="two rows"):
        stratified_split(labelled(spark, {"A": 5, "B": 1}))


def test_shares_by_largest_remainder(spark):
    counts = spark.createDataFrame([("A", 7), ("B", 2), ("C", 2)], "label string, n long")
    assert {r.label: r.n_test for r in shares_of(counts).collect()} == {"A": 2, "B": 1, "C": 0}


def features(spark, n=60):
    rng = np.random.default_rng(0)
    words = {"A": "apple pear plum", "B": "car bus tram", "C": "red blue pink"}
    rows = [(i, 0, label, list(rng.choice(words[label].split() + ["and", "or"], 4)))
            for i, label in enumerate(list("ABC") * (n // 3))]
    rows.append((999, 0, "A", []))
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, label string, terms array<string>")
    model, vocab = V.tfidf_fit(df, "terms", 100)
    return V.transform(model, df), len(model.stages[0].vocabulary)


def brute_force(df, size, epochs, lr=0.1):
    rows = df.collect()
    labels = sorted({r.label for r in rows})
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([[float(r.label == k) for k in labels] for r in rows])
    w, b = np.zeros((size, len(labels))), np.zeros(len(labels))
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w, b = w + lr * x.T @ (y - p), b + lr * (y - p).sum(axis=0)
    loss = -np.mean(y * np.log(p + 1e-15) + (1 - y) * np.log(1 - p + 1e-15), axis=0)
    return w.T, b, loss, 1 / (1 + np.exp(-(x @ w + b)))


@pytest.mark.parametrize("cells", [2_000_000, 1])
def test_gradient_ascent_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(M, "BLOCK_CELLS", cells)
    monkeypatch.setattr(M, "TASK_ROWS", 10)
    df, size = features(spark)
    df = df.repartition(5, "doc_id").cache()
    model = M.train_ovr_gd(df, size, epochs=7)
    w, b, loss, _ = brute_force(df, size, 7)
    assert np.allclose(model.weights, w) and np.allclose(model.bias, b)
    assert [e for _, e, _ in model.losses] == [7, 7, 7]
    assert np.allclose([v for _, _, v in model.losses], loss)


def test_loss_is_kept_every_hundred_epochs(spark):
    df, size = features(spark, 9)
    df = df.coalesce(1)
    model = M.train_ovr_gd(df, size, epochs=101, scale="mean")
    assert sorted({e for _, e, _ in model.losses}) == [100, 101]


def test_scores_agree_in_both_forms_and_bias_alone_scores_empty_rows(spark, monkeypatch):
    df, size = features(spark)
    df = df.cache()
    model = M.train_ovr_gd(df, size, epochs=5)
    _, _, _, p = brute_force(df, size, 5)
    want = {r.doc_id: (model.labels[int(np.argmax(q))], q.max()) for r, q in zip(df.collect(), p)}
    narrow = M.predict_ovr(model, df)
    assert "Exchange" not in narrow._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
    monkeypatch.setattr(M, "LITERAL_WEIGHTS", 0)
    monkeypatch.setattr(M, "SENT_CELLS", 2 * size)
    # Three blocks of one label, in two passes.
    blocks = M.predict_ovr(model, df)
    assert blocks.columns == narrow.columns
    assert "Exchange" not in blocks._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
    for rows in (narrow.collect(), blocks.collect()):
        assert len(rows) == 61
        for r in rows:
            assert (r.prediction, r.score) == (want[r.doc_id][0], pytest.approx(want[r.doc_id][1]))


def test_scoring_takes_null_and_repeated_keys(spark, monkeypatch):
    df, size = features(spark, 12)
    df = df.withColumn("doc_id", F.when(F.col("doc_id") % 4 > 0, F.col("doc_id") % 3)).coalesce(1).cache()
    model = M.train_ovr_gd(df, size, epochs=3)
    tables = model.weight_table(spark), model.bias_table(spark)
    # In long form a key stands for one row.
    one = df.dropDuplicates(["doc_id"]).cache()
    every = lambda: (sorted(map(str, M.predict_ovr(model, df).select("doc_id", "label", "prediction", F.round("score", 9)).collect())),
                     sorted(map(str, M.score_join(V.to_long(one, key=["doc_id"]), *tables, one, ["doc_id"]).select(
                         "doc_id", "label", F.round("score", 9)).collect())))
    literal = every()
    monkeypatch.setattr(M, "LITERAL_WEIGHTS", 0)
    assert every() == literal
    assert len(literal[0]) == 13 and len(literal[1]) == 3 * one.count()


def test_resumed_training_equals_an_unbroken_run(spark, tmp_path, monkeypatch):
    df, size = features(spark)
    df = df.repartition(3, "doc_id").cache()
    whole = M.train_ovr_gd(df, size, epochs=25)
    path = str(tmp_path / "state")
    step, calls = M._gradient, []

    def dies(*args):
        calls.append(1)
        if len(calls) > 17:
            raise KeyboardInterrupt
        return step(*args)
    monkeypatch.setattr(M, "_gradient", dies)
    with pytest.raises(KeyboardInterrupt):
        M.train_ovr_gd(df, size, epochs=25, state_path=path, state_every=5)
    monkeypatch.setattr(M, "_gradient", step)
    seen = []
    monkeypatch.setattr(M, "_gradient", lambda *a: (seen.append(1), step(*a))[1])
    again = M.train_ovr_gd(df, size, epochs=25, state_path=path, state_every=5)
    assert len(seen) == 10  # epochs 16 to 25
    assert np.array_equal(again.weights, whole.weights) and np.array_equal(again.bias, whole.bias) and again.losses == whole.losses
    with pytest.raises(ValueError, match="another run"):
        M.train_ovr_gd(df, size, epochs=25, lr=0.2, state_path=path)


def test_gradient_certificate(spark):
    df, size = features(spark)
    df = df.coalesce(1).cache()
    rough, fine = M.train_multinomial(df, max_iter=2), M.train_multinomial(df, max_iter=500)
    worst = lambda m: max(r.gradient for r in M.optimality(m, df, penalty=1 / df.count()).collect())
    assert worst(fine) < 1e-4 < worst(rough)
    single = M.train_ovr(df, max_iter=3)
    assert {r.label for r in M.optimality(single, df).collect()} == {"A", "B", "C"}


def test_saved_models_predict_the_same(spark, tmp_path):
    df, size = features(spark)
    df = df.coalesce(1).cache()
    model = M.train_ovr_gd(df, size, epochs=3)
    model.save(spark, str(tmp_path / "ovr"))
    again = M.OvrModel.load(spark, str(tmp_path / "ovr"))
    assert M.predict_ovr(again, df).collect() == M.predict_ovr(model, df).collect()
    lr = M.train_multinomial(df, max_iter=5)
    M.save_model(lr, str(tmp_path / "lr"))
    assert M.predict(M.load_model(str(tmp_path / "lr")), df).collect() == M.predict(lr, df).collect()


def test_library_models_beat_the_majority(spark):
    df = features(spark)[0].coalesce(1).cache()
    floor = df.filter(F.col("label") == M.train_majority(df)).count() / df.count()
    for model in (M.train_multinomial(df, max_iter=15), M.train_ovr(df, max_iter=5)):
        right = M.predict(model, df).filter("label = prediction").count() / df.count()
        assert right > max(floor, 0.9)


def test_two_class_models_score_after_an_observed_query(spark):
    df = features(spark)[0].coalesce(1).cache()
    spark.range(3).observe(Observation(), F.count("*").alias("n")).count()
    for model in (M.train_multinomial(df, max_iter=2), M.train_ovr(df, max_iter=2)):
        assert M.predict(model, df).filter("prediction is not null").count() == df.count()


def test_majority_ties_in_label_order(spark):
    df = spark.createDataFrame([("B",), ("A",), ("A",), ("B",)], "label string")
    assert M.train_majority(df) == "A"


def test_benchmarks_run_end_to_end(spark):
    words = {"A": "apple pear plum", "B": "car bus tram", "Other": "red blue pink", "Rare": "one"}
    rows = [(i, 0, label, f"kw{label.lower()} {words[label]} {i % 3 * 'x'}")
            for i, label in enumerate(["A", "B", "Other"] * 20 + ["Rare"])]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, label string, norm string")
    run = benchmark_ovr(df, {"kwa": "A", "kwb": "B"}, epochs=20)
    assert [r.label for r in run.metrics().orderBy("label").collect()] == ["A", "B"]
    assert {"kwa", "kwb"}.isdisjoint(run.features.stages[0].vocabulary)
    assert run.predictions.filter("label <> prediction").count() == 0
    lib = benchmark_library(df, max_iter=8)
    report = {(r.model, r.label): r.f1 for r in lib.report().collect()}
    assert report["Logistic Regression", "accuracy"] > report["Majority", "accuracy"]
    assert {r.label for r in lib.report_excluding_other().filter("support > 0").collect()} >= {"A", "B"}


def test_topics(spark):
    df = spark.createDataFrame([("apple pear plum",), ("car bus tram",)] * 10, "norm string")
    model, words = topic_report(df, k=2, n=3)
    rows = words.orderBy("topic", "rank").collect()
    assert len(rows) == 6 and {r["rank"] for r in rows} == {1, 2, 3}
    assert all(a.weight >= b.weight for a, b in zip(rows, rows[1:]) if a.topic == b.topic)
    assert {r.term for r in rows} <= set("apple pear plum car bus tram".split())


def test_topic_table_fits_no_worse_than_the_library(spark):
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizerModel

    from textmill.operators import topics as T
    rng = np.random.default_rng(4)
    groups = [[f"{g}{i}" for i in range(30)] for g in "abc"]
    rows = [(list(rng.choice(groups[i % 3], 12)) + list(rng.choice(groups[(i + 1) % 3], i % 4)),) for i in range(150)] + [([],)]
    df = spark.createDataFrame(rows, "terms array<string>").repartition(3).cache()
    vocab = V.build_vocabulary(df, "terms", None).cache()
    cells = T.term_cells(df, vocab)
    table = T.train_topic_table(cells, vocab, 3, max_iter=15)
    again = T.train_topic_table(cells.repartition(5), vocab, 3, max_iter=15)
    mine = np.array([r.weights for r in table.orderBy("idx").collect()])
    assert np.allclose(mine, np.array([r.weights for r in again.orderBy("idx").collect()]))
    assert mine.shape == (90, 3) and np.isclose(mine.sum(), sum(len(t) for t, in rows) + 90)
    mix = {r.row: r.mixture for r in T.topic_mixtures(cells, table, 3).collect()}
    assert len(mix) == 150
    beta = mine / mine.sum(axis=0)
    fit = sum(c.n * math.log(np.dot(mix[c.row], beta[c.idx])) for c in cells.collect())

    words = [r.term for r in vocab.orderBy("idx").collect()]
    counts = CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="counts").transform(df.filter("size(terms) > 0"))
    lda = LDA(k=3, maxIter=15, seed=42, optimizer="online", subsamplingRate=1.0, docConcentration=[1 / 3], topicConcentration=1 / 3,
              featuresCol="counts").fit(counts)
    other = lda.topicsMatrix().toArray()
    other = other / other.sum(axis=0)
    library = sum(n * math.log(r.topicDistribution.toArray() @ other[i]) for r in lda.transform(counts).collect()
                  for i, n in zip(r.counts.indices, r.counts.values))
    assert fit >= library
    top = T.top_topic_words(table, vocab, 3, 5).collect()
    assert len(top) == 15 and all(len({r.term[0] for r in top if r.topic == t}) == 1 for t in range(3))


def test_digamma():
    from textmill.operators.topics import digamma
    assert np.allclose(digamma(np.array([1.0, 0.1, 25.0])), [-0.5772156649, -10.4237549404, 3.1987425009])


def test_exp_digamma():
    from textmill.operators.topics import digamma, exp_digamma
    x = np.array([1e-3, 0.1, 0.25, 1.0, 3.7, 25.0, 1e6])
    assert np.allclose(exp_digamma(x), np.exp(digamma(x)), rtol=1e-12, atol=0)


def test_weights_are_sent_once_per_block_and_term(spark, monkeypatch):
    from textmill.operators import topics as T
    monkeypatch.setattr(T, "BLOCK_CELLS", 300)
    rows = [([f"w{i % 7}", f"w{i % 3}", f"w{i % 3}", f"x{i}", "out"],) for i in range(400)] + [([],), (None,), (["out"],), (["out", "w0"],)]
    df = spark.createDataFrame(rows, "terms array<string>").repartition(2).cache()
    vocab = V.build_vocabulary(df, "terms", None).filter("term <> 'out'").cache()
    cells, packed = T.term_cells(df, vocab), T.term_blocks(df, vocab)
    # One row of weights per block and term, where there was one per cell.
    assert packed.blocks.count() >= 4 and packed.links.count() < cells.count() - 500
    assert packed.blocks.selectExpr("max(size(n)) n").first().n <= 300
    start = T.start_topics(vocab, 3, 1).cache()
    # Row by row, as the operator states it.
    e = {r.idx: r.weights for r in start.collect()}
    totals, by_row, want = np.sum(list(e.values()), axis=0), {}, {}
    for c in cells.collect():
        by_row.setdefault(c.row, []).append((c.idx, c.n))
    for cs in by_row.values():
        idx, n = [i for i, _ in sorted(cs)], np.array([float(x) for _, x in sorted(cs)])
        logs = np.exp(T.digamma(np.array([e[i] for i in idx])) - T.digamma(totals))
        mix = np.full(3, 0.3 + n.sum() / 3)
        for _ in range(100):
            part = logs * np.exp(T.digamma(mix) - T.digamma(mix.sum()))
            part *= (n / (part.sum(axis=1) + 1e-100))[:, None]
            new = 0.3 + part.sum(axis=0)
            moved, mix = np.abs(new - mix).mean(), new
            if moved < 1e-3:
                break
        for i, p in zip(idx, part):
            want[i] = want.get(i, 0.2) + p
    for given in (cells, packed):
        got = {r.idx: r.weights for r in T.update_topics(given, start, 3, 0.3, 0.2).collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)
        assert T.topic_mixtures(given, start, 3).count() == 401


def test_topic_model_keeps_its_vocabulary_in_a_table(spark, tmp_path):
    from textmill.operators.topics import start_near_one, topic_totals
    df = spark.createDataFrame([(1, ["apple", "pear", "plum"]), (2, ["car", "bus", "tram"]), (3, []), (4, None)] * 6, "id int, terms array<string>")
    model = M.train_topics(df, 2, terms="terms")
    # Each step keeps a part of the total and takes the rest from the rows: 36 occurrences and priors of 1/2 for 12 weights.
    total = topic_totals(start_near_one(model.stages[-1].vocab, 2, 42), 2).sum()
    for t in range(1, 11):
        total += (1024 + t) ** -0.51 * (36 + 6 - total)
    assert model.stages[-1].topics.count() == 6 and np.isclose(topic_totals(model.stages[-1].topics, 2).sum(), total)
    mixed = model.transform(df)
    assert mixed.columns == ["id", "terms", "topicDistribution"] and mixed.count() == 24
    for r in mixed.collect():
        assert np.isclose(r.topicDistribution.toArray().sum(), 1.0 if r.id < 3 else 0.0)
    M.save_model(model, str(tmp_path / "m"))
    again = M.load_model(str(tmp_path / "m"))
    assert sorted(M.top_words(again, 2).collect()) == sorted(M.top_words(model, 2).collect())
    rows = {r.id: r.topicDistribution.toArray() for r in mixed.collect()}
    assert all(np.allclose(r.topicDistribution.toArray(), rows[r.id]) for r in again.transform(df).collect())
    bounded = M.train_topics(df, 2, terms="terms", vocab=V.build_vocabulary(df, "terms", 4))
    assert bounded.stages[-1].topics.count() == 4
    more = V.build_vocabulary(df, "terms", None).select("term", "idx").unionByName(spark.sql("SELECT 'none' term, 6L idx"))
    assert M.train_topics(df, 2, terms="terms", vocab=more).stages[-1].topics.count() == 7
    draws = np.array([r.weights for r in start_near_one(spark.range(2000).selectExpr("id idx", "string(id) term"), 5, 1).collect()])
    assert abs(draws.mean() - 1) < 0.01 and abs(draws.std() - 0.1) < 0.01
