"""Prompts for an external annotator, and its replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import parse_annotations
from textmill.operators.corpus import KeywordMap, batch_rows, keyword_pairs

# Keywords that one prompt can list.
MAX_KEYWORDS = 2_000


def annotation_prompts(
    df: DataFrame, kwmap: KeywordMap, size: int = 10, group: str = "doc_id", order: str = "sent_idx",
    item: str = "sentence", other: str = "Other",
) -> DataFrame:
    """(group, batch, prompt): instruction, keyword list and numbered sentences per batch.

    Every prompt repeats the keyword list; a map of more than `MAX_KEYWORDS` is refused.
    """
    pairs = keyword_pairs(kwmap, limit=MAX_KEYWORDS)
    if pairs is None:
        raise ValueError(f"more than {MAX_KEYWORDS} keywords for one prompt")
    known = "".join(f"- {keyword} = {label}\n" for keyword, label in pairs)
    head = (
        "Give each numbered sentence the labels of the keywords it mentions.\n"
        f"Keywords and labels:\n{known}"
        f"A sentence without any of them is labelled {other}. "
        "Reply with one line per sentence: its labels, separated by commas.\n"
    )
    batches = batch_rows(df, size, group, order, item)
    lines = F.transform(
        "items",
        lambda s, i: F.concat((F.col("batch") * size + i + 1).cast("string"), F.lit(". "), s, F.lit("\n")))
    return batches.select(group, "batch", F.concat(F.lit(head), F.array_join(lines, "")).alias("prompt"))


def parse_replies(replies: DataFrame, key: list[str], reply: str = "reply", size: int | None = None) -> DataFrame:
    """(key, line, labels): one row per non-blank reply line, keyed by batch and line.

    Lines beyond the batch `size` are dropped; a reply of another length thus never
    shifts the rows of a later batch.
    """
    lines = replies.select(*key, F.posexplode(parse_annotations(reply)).alias("line", "labels"))
    return lines if size is None else lines.filter(F.col("line") < size)
