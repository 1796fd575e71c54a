"""Topic report."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from textmill.functions import text as X
from textmill.operators import models as M
from textmill.runtime import materialize


def topic_report(norm: DataFrame, k: int = 10, n: int = 10, seed: int = 42,
                 vocab: DataFrame | None = None) -> tuple[PipelineModel, DataFrame]:
    """Train topics on the words of normalised rows: (model, (topic, rank, term, weight))."""
    rows = materialize(norm.select(X.terms_word2("norm").alias("terms")), "topics")
    model = M.train_topics(rows, k, seed, "terms", vocab=vocab)
    return model, M.top_words(model, n)
