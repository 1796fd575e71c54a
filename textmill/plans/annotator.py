"""Comparison of an external annotator with the keyword labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators import corpus as C
from textmill.operators import evaluate as E
from textmill.operators.annotate import parse_replies
from textmill.operators.ranking import rank_within


def annotator_report(labelled: DataFrame, replies: DataFrame, size: int = 10, group: str = "doc_id",
                     order: str = "sent_idx") -> DataFrame:
    """Report of replies (group, batch, reply) against (group, order, label).

    A reply line is paired with its sentence by group, batch and line. Sentences without
    a line count as `Other`, as do batches without a reply.
    """
    place = rank_within(labelled.select(group, order, "label"), [group], F.floor(F.col(order) / 1024),
                        [F.col(order)], "_rank")
    truth = place.select(group, order, "label", F.floor((F.col("_rank") - 1) / size).alias("batch"),
                         ((F.col("_rank") - 1) % size).cast("int").alias("line"))
    given = C.first_label(parse_replies(replies, [group, "batch"], size=size)).select(
        group, "batch", "line", F.col("label").alias("prediction"))
    paired = truth.join(given, [group, "batch", "line"], "left")
    return E.classification_report(paired.select("label", F.coalesce("prediction", F.lit("Other")).alias("prediction")))
