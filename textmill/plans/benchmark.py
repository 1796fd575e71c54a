"""Train-and-evaluate runs. Each writes its labelled rows once and trains from that table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as X
from textmill.operators import corpus as C
from textmill.operators import evaluate as E
from textmill.operators import models as M
from textmill.operators.corpus import KEY, KeywordMap
from textmill.operators.features import build_vocabulary, fit_idf, tfidf_fit, tfidf_model, transform
from textmill.operators.split import stratified_split
from textmill.runtime import materialize, small_table


@dataclass
class OvrRun:
    features: PipelineModel
    vocab: DataFrame
    model: M.OvrModel
    predictions: DataFrame
    labels: list[str]

    def metrics(self) -> DataFrame:
        """Per-label metrics over the labels seen in training, zero rows included."""
        names = F.explode(F.array(*[F.lit(x) for x in self.labels])).alias("label")
        every = self.predictions.sparkSession.range(1).select(names)
        found = E.per_label_metrics(self.predictions)
        zero = {c: 0.0 for c in ("precision", "recall", "f1")}
        return every.join(found, "label", "left").fillna({**zero, "support": 0})


@dataclass
class LibraryRun:
    features: PipelineModel
    model: PipelineModel
    majority: str
    predictions: dict[str, DataFrame]
    train: DataFrame

    def report(self) -> DataFrame:
        return E.compare_models(self.predictions)

    def report_excluding_other(self) -> DataFrame:
        return E.compare_models({k: C.exclude_label(v) for k, v in self.predictions.items()})


def ovr_rows(labelled: DataFrame, kwmap: KeywordMap, remove_keywords: bool = True, min_count: int = 2) -> DataFrame:
    """Rows of the hand-written benchmark: rare classes and `Other` dropped, keywords hidden."""
    kept = C.exclude_label(C.drop_rare_classes(labelled, min_count))
    if remove_keywords:
        kept = C.hide_own_keywords(kept, kwmap)
    return kept.withColumn("terms", X.terms_whitespace("norm"))


def benchmark_ovr(
    labelled: DataFrame, kwmap: KeywordMap, remove_keywords: bool = True, max_features: int = 1000,
    lr: float = 0.1, epochs: int = 1000, test_size: float = 0.2, seed: int = 42, scale: str = "sum",
    state_path: str | None = None,
) -> OvrRun:
    """Split, vectorise, train one-vs-rest by gradient ascent, and predict the test rows. With
    `state_path` the training is stored there as it goes and resumed by the same call.

    `labelled` is read more than once: pass a stored table, not a long plan.
    """
    rows = ovr_rows(labelled, kwmap, remove_keywords).select(*KEY, "label", "terms")
    rows = materialize(stratified_split(rows, test_size, seed), "ovr")
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    vocab = small_table(build_vocabulary(train, "terms", max_features), max_features)
    vocab = fit_idf(train, vocab, "terms")
    features = tfidf_model(vocab, "terms")
    size = len(features.stages[0].vocabulary)
    model = M.train_ovr_gd(transform(features, train), size, lr, epochs, scale, state_path=state_path)
    predicted = M.predict_ovr(model, transform(features, test)).select(*KEY, "label", "prediction", "score")
    return OvrRun(features, vocab, model, predicted, model.labels)


def benchmark_library(
    labelled: DataFrame, max_features: int = 1000, max_iter: int = 1000, test_size: float = 0.2,
    seed: int = 42, min_count: int = 2,
) -> LibraryRun:
    """Rare classes merged into `Other`; multinomial regression against the majority label."""
    rows = C.merge_rare_into_other(labelled.select(*KEY, "label", "norm"), min_count)
    rows = rows.withColumn("terms", X.terms_word2("norm"))
    rows = materialize(stratified_split(rows, test_size, seed), "library")
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    features, _ = tfidf_fit(train, "terms", max_features)
    ready = materialize(transform(features, train).select("label", "features"), "features")
    model = M.train_multinomial(ready, max_iter=max_iter)
    majority = M.train_majority(train)
    tested = transform(features, test)
    return LibraryRun(features, model, majority, {
        "Logistic Regression": M.predict(model, tested).select(*KEY, "label", "prediction"),
        "Majority": M.predict_majority(majority, test).select(*KEY, "label", "prediction"),
    }, ready)
