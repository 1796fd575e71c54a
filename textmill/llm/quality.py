"""Quality rules: measures of each text, and verdicts on the hosts the texts come from.

A document fails by its own text (too few words, too much repetition) or with its
host: failures are counted per host and rule, the rates are shrunk to what hosts
fail at in general (a beta prior fitted to all hosts), and a host whose shrunk rate
passes `max_host_rate` takes all its documents along.

Everything is a Spark expression; text is measured inside its row and never shuffled.
Null and blank texts have no words and fail. Documents without a host (null) are
judged by their text alone. Repeated rows are judged one by one; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import SHINGLE, checked_small, let, window_hashes, words
from textmill.runtime import materialize

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A host is dropped if more than this share of its documents is expected to fail a rule.
MAX_HOST_RATE = 0.5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(hashes: Column) -> Column:
    """Words inside five-word windows that occur twice or more; `hashes` are the windows in text order."""
    def marked(pairs: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        flags = F.transform(pairs, lambda p, j: F.struct(
            p["i"].alias("i"),
            (F.coalesce((j > 0) & same(j, F.greatest(j - 1, F.lit(0))), F.lit(False))
             | F.coalesce(same(j, j + 1), F.lit(False))).alias("twice")))
        return F.sort_array(F.transform(F.filter(flags, lambda x: x["twice"]), lambda x: x["i"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # A window adds the words that the window before it has not covered.
    covered = F.aggregate(
        let(pairs, marked), F.struct(F.lit(0).alias("n"), F.lit(-SHINGLE).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(SHINGLE), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"])
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """A struct with the five measures of a text, as bigint."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def body(w: Column) -> Column:
        values = [
            F.size(w),
            F.char_length(F.array_join(w, "")),
            F.size(F.split(whole, SYMBOLS)) - 1,
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
            let(window_hashes(w), _repeat_words),
        ]
        return F.struct(*(v.cast("bigint").alias(k) for k, v in zip(MEASURES, values)))
    return let(words(text), body)


def few_words(m: Column) -> Column:
    return m["n_words"] < MIN_WORDS


def repetitive(m: Column) -> Column:
    return 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]


def _prior(hosts: DataFrame, rule: str) -> tuple[float, float]:
    """Beta prior by moments of the hosts' rates; one row reaches the driver."""
    r = hosts.agg(F.avg(F.col(rule) / F.col("n")).alias("mean"), F.var_pop(F.col(rule) / F.col("n")).alias("var"),
                  ).first()
    mean, var = r["mean"] or 0.0, r["var"] or 0.0
    # Without spread between hosts nothing is known about single ones: a strong prior.
    strength = min(1e6, max(1.0, mean * (1 - mean) / var - 1)) if var > 0 else 1e6
    return mean * strength, (1 - mean) * strength


def host_verdicts(judged: DataFrame, host: str) -> DataFrame:
    """`host, n, few_words, repetitive, rejected` for every host of a table with both rules' flags.

    `judged` has boolean columns `few_words` and `repetitive`. Counts are combined
    before the shuffle, so a host with a third of all rows is one row per task.
    """
    rules = ["few_words", "repetitive"]
    hosts = materialize(
        judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), *(F.count_if(r).alias(r) for r in rules)), "hosts")
    rejected = F.lit(False)
    for r in rules:
        a, b = _prior(hosts, r)
        rejected = rejected | ((F.col(r) + F.lit(a)) / (F.col("n") + F.lit(a + b)) > MAX_HOST_RATE)
    return hosts.withColumn("rejected", rejected)


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source",
                  keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs`, the measures, `base_failed`, `host_failed` and `kept` for every row.

    The measured table is stored once (without texts); only hosts that fail are joined back.
    """
    keep = ["doc_id"] if keep is None else keep
    m = F.col("_m")
    judged = materialize(
        # The array of one struct is exploded so that the text is measured once, not once per use.
        docs.select(*keep, F.col(host).alias("_host"), F.explode(F.array(measures(F.col(text)))).alias("_m"))
        .select(*keep, "_host", "_m", few_words(m).alias("few_words"), repetitive(m).alias("repetitive")), "judged")
    failed = checked_small(host_verdicts(judged, "_host").where("rejected").select("host"), name="failed_hosts")
    return (judged.join(failed.withColumn("_bad", F.lit(True)), F.col("_host") == F.col("host"), "left")
            .select(*keep, *(m[k].alias(k) for k in MEASURES),
                    (F.col("few_words") | F.col("repetitive")).alias("base_failed"),
                    F.coalesce(F.col("_bad"), F.lit(False)).alias("host_failed"))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of `docs` that pass, with the columns they had.

    Texts are measured twice, once to count the hosts' failures and once to filter:
    cheaper than storing or shuffling the texts.
    """
    def flagged(*columns) -> DataFrame:
        m = F.col("_m")
        return (docs.select(*columns, F.explode(F.array(measures(F.col(text)))).alias("_m"))
                .withColumns({"few_words": few_words(m), "repetitive": repetitive(m)}))

    failed = checked_small(host_verdicts(flagged(F.col(host).alias("_host")), "_host")
                           .where("rejected").select(F.col("host").alias("_bad")), name="failed_hosts")
    # The row travels as a struct, so that its names cannot clash with the ones made here.
    good = flagged(F.struct("*").alias("_row"), F.col(host).alias("_host")).where("NOT few_words AND NOT repetitive")
    return good.join(failed, F.col("_host") == F.col("_bad"), "left_anti").select("_row.*")
