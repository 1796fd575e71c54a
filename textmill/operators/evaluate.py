"""Evaluation of a table with the columns `label` (truth) and `prediction`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.keywords import OTHER
from textmill.operators.corpus import exclude_label


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def accuracy(pred: DataFrame) -> DataFrame:
    return pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))


def confusion_counts(pred: DataFrame) -> DataFrame:
    """(label, prediction, n) for the pairs that occur: all later figures come from this
    table, whose size depends on the number of classes only."""
    return pred.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def _grid(counts: DataFrame, labels: list[str] | None) -> DataFrame:
    """Every pair of classes, from one row that holds the array of classes."""
    if labels is None:
        one = counts.agg(F.array_union(F.collect_set("label"), F.collect_set("prediction")).alias("names"))
    else:
        one = counts.sparkSession.createDataFrame([(labels,)], "names array<string>")
    return one.select("names", F.explode("names").alias("label")).select(
        "label", F.explode("names").alias("prediction"))


def confusion_matrix(pred: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """(label, prediction, n) with zero cells; classes default to all that occur."""
    counts = confusion_counts(pred)
    cells = _grid(counts, labels).join(counts, ["label", "prediction"], "left")
    return cells.withColumn("n", F.coalesce("n", F.lit(0)))


def confusion_wide(pred: DataFrame, labels: list[str]) -> DataFrame:
    """One row per true class and one column per predicted class."""
    return confusion_matrix(pred, labels).groupBy("label").pivot("prediction", labels).agg(F.sum("n"))


def _label_metrics(counts: DataFrame, by: list[str]) -> DataFrame:
    # Each confusion cell counts once for its true and once for its predicted class.
    sides = F.array(
        F.struct(F.col("label").alias("name"), F.col("n").alias("support"), F.lit(0).alias("predicted")),
        F.struct(F.col("prediction").alias("name"), F.lit(0).alias("support"), F.col("n").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    cells = counts.select(*by, hit.alias("hit"), F.inline(sides))
    sums = cells.groupBy(*by, F.col("name").alias("label")).agg(
        F.sum(F.when(F.col("support") > 0, F.col("hit")).otherwise(0)).alias("tp"),
        F.sum("support").cast("long").alias("support"),
        F.sum("predicted").alias("predicted"))
    p, r = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("support"))
    scored = sums.select(*by, "label", p.alias("precision"), r.alias("recall"), "support")
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.select(*by, "label", "precision", "recall", f1.alias("f1"), "support")


def per_label_metrics(pred: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support); 0.0 where a denominator is zero."""
    return _label_metrics(confusion_counts(pred), [])


def metrics_table(pred: DataFrame) -> DataFrame:
    """The per-label metrics, rounded for display and in label order."""
    rounded = [F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")]
    return per_label_metrics(pred).select("label", *rounded, "support").orderBy("label")


def _report(counts: DataFrame, by: list[str]) -> DataFrame:
    rows = _label_metrics(counts, by)
    names = ("precision", "recall", "f1")

    def summary(name: str, *values: Column) -> DataFrame:
        agg = [v.alias(n) for v, n in zip(values, names)]
        return rows.groupBy(*by).agg(*agg, F.sum("support").alias("support")).select(
            *by, F.lit(name).alias("label"), *names, "support")

    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    hits = counts.groupBy(*by).agg(_ratio(right, F.sum("n")).alias("f1"), F.sum("n").alias("support"))
    none = F.lit(None).cast("double")
    total = hits.select(*by, F.lit("accuracy").alias("label"), none.alias("precision"), none.alias("recall"),
                        "f1", "support")
    macro = summary("macro avg", *[F.avg(n) for n in names])
    weighted = summary(
        "weighted avg", *[_ratio(F.sum(F.col(n) * F.col("support")), F.sum("support")) for n in names])
    return reduce(DataFrame.unionByName, [rows, total, macro, weighted])


def classification_report(pred: DataFrame) -> DataFrame:
    """Per-label rows plus `accuracy`, `macro avg` and `weighted avg`.

    Classes are all true and predicted ones. The accuracy stands in column `f1`.
    """
    return _report(confusion_counts(pred), [])


def metrics_excluding(pred: DataFrame, label: str = OTHER) -> DataFrame:
    """The report over rows whose true label is another one; predictions may still be `label`."""
    return classification_report(exclude_label(pred, label))


def compare_models(preds: dict[str, DataFrame]) -> DataFrame:
    """One report per model, in one table with a leading column `model`."""
    tagged = [df.select(F.lit(name).alias("model"), "label", "prediction") for name, df in preds.items()]
    counts = reduce(DataFrame.unionByName, tagged).groupBy("model", "label", "prediction").agg(
        F.count("*").alias("n"))
    return _report(counts, ["model"])


def compare_annotators(truth: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """(key, label, prediction): pair two label sources by key; rows of one source only are left out."""
    return truth.select(*on, "label").join(
        other.select(*on, F.col("label").alias("prediction")), on)


def loss_by_label(scored: DataFrame) -> DataFrame:
    """Mean binary cross-entropy per label of rows (label, y, p), with a floor of 1e-15."""
    y, p = F.col("y"), F.col("p")
    term = y * F.log(p + 1e-15) + (1 - y) * F.log(1 - p + 1e-15)
    return scored.groupBy("label").agg((-F.avg(term)).alias("loss"))
