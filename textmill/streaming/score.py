"""Scoring new sentences, in batch or as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textmill.functions import text as X
from textmill.functions.keywords import hide_label_names
from textmill.operators.features import transform
from textmill.operators.models import OvrModel, predict, predict_ovr
from textmill.sources.readers import clean_lines

Scorer = Callable[[DataFrame], DataFrame]


def make_scorer(
    features: PipelineModel, model: OvrModel | PipelineModel, label_names: list[str],
    terms: Callable = X.terms_word2, normalize: bool = False,
) -> Scorer:
    """A function that adds `prediction` to a table with the column `value`.

    Label names are removed as substrings and the rest goes to the vectorizer as it is;
    `normalize=True` runs the text normaliser first, as in training. Only projections:
    the same function serves batch and stream. `features` must read the column `terms`.
    """
    def score(lines: DataFrame) -> DataFrame:
        clean = hide_label_names("value", label_names)
        if normalize:
            clean = X.join_tokens(X.normal_tokens(clean))
        ready = transform(features, lines.withColumn("terms", terms(clean)))
        if isinstance(model, OvrModel):
            return predict_ovr(model, ready).drop("terms", "features")
        return predict(model, ready).drop("terms", "features")

    return score


def score_lines(lines: DataFrame, scorer: Scorer) -> DataFrame:
    """One sentence per line."""
    return scorer(clean_lines(lines))


def score_prompts(lines: DataFrame, scorer: Scorer) -> DataFrame:
    """Several sentences per line, parted by semicolons."""
    return scorer(lines.select(F.explode(X.split_semicolons("value")).alias("value")))


def score_stream(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint_dir: str, scorer: Scorer,
    available_now: bool = True,
) -> StreamingQuery:
    """Score text files as they arrive in `in_dir` and append Parquet to `out_dir`.

    There is no state and hence no watermark; the checkpoint makes the output exactly once.
    """
    lines = spark.readStream.text(in_dir)
    writer = (
        score_prompts(lines, scorer).writeStream.format("parquet").outputMode("append")
        .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
