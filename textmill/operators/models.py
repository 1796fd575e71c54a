"""Classifiers and topic models."""

from __future__ import annotations

import io
import json
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import bind, sigmoid
from textmill.operators.corpus import KEY
from textmill.operators.features import build_vocabulary, entries
from textmill.operators.topics import CELLS, term_blocks, top_topic_words, topic_mixtures, train_topic_table
from textmill.runtime import SMALL_ROWS, materialize, scratch_path, small_table
from textmill.schemas import BIASES, LOSSES, WEIGHTS

# Cells of a weight table that may be compiled into a projection; beyond it, scores are joined.
LITERAL_WEIGHTS = 2_000_000
# Cells of the label blocks that one scoring pass sends to the executors (8 bytes each).
SENT_CELLS = 50_000_000
# Cells of the work arrays of one training block: rows per block shrink with the label count.
BLOCK_CELLS = 2_000_000
# Fewest rows worth a training task of their own, and most tasks whose gradients go straight
# to the driver.
TASK_ROWS = 20_000
FLAT_TASKS = 32
# Terms whose weights make one row of a stored training state.
STATE_ROWS = 100_000
STATE = ("run string, epoch int, part int, weights binary, bias binary, "
         "losses array<struct<label:string,epoch:int,loss:double>>")
# Models live on the driver: more classes than this are refused, not cut off.
MAX_LABELS = 10_000


# --- one-vs-rest logistic regression by gradient ascent -----------------------------

@dataclass
class OvrModel:
    """Weights (labels x terms) and biases, labels in ascending order, and the loss history."""

    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray
    losses: list[tuple[str, int, float]] = field(default_factory=list)

    def weight_table(self, spark: SparkSession) -> DataFrame:
        rows = [(label, i, float(w)) for label, ws in zip(self.labels, self.weights) for i, w in enumerate(ws)]
        return spark.createDataFrame(rows, WEIGHTS)

    def bias_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(x, float(b)) for x, b in zip(self.labels, self.bias)], BIASES)

    def loss_history(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.losses, LOSSES)

    def save(self, spark: SparkSession, path: str) -> None:
        self.weight_table(spark).write.mode("overwrite").parquet(f"{path}/weights")
        self.bias_table(spark).write.mode("overwrite").parquet(f"{path}/bias")
        self.loss_history(spark).write.mode("overwrite").parquet(f"{path}/losses")

    @staticmethod
    def load(spark: SparkSession, path: str) -> OvrModel:
        bias = sorted(spark.read.schema(BIASES).parquet(f"{path}/bias").collect())
        cells = spark.read.schema(WEIGHTS).parquet(f"{path}/weights").orderBy("label", "idx").collect()
        losses = spark.read.schema(LOSSES).parquet(f"{path}/losses").collect()
        weights = np.array([c.weight for c in cells]).reshape(len(bias), -1)
        return OvrModel([b.label for b in bias], weights, np.array([b.bias for b in bias]),
                        sorted(tuple(row) for row in losses))


def _to_blocks(n_labels: int):
    """Arrow batches of (y, indices, values, times) to pickled blocks of numpy arrays."""
    cells = BLOCK_CELLS

    def run(batches):
        import pickle

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            times = batch.column("times").to_numpy(zero_copy_only=False).astype(float)
            per_row = max(1, len(batch.column("indices").flatten()) // max(1, len(y)))
            step = max(64, cells // (n_labels * per_row))
            for at in range(0, len(y), step):
                part = batch.slice(at, step)
                lists = part.column("indices")
                sizes = np.asarray(lists.value_lengths())
                idx = lists.flatten().to_numpy(zero_copy_only=False)
                val = part.column("values").flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(sizes)), sizes)
                by_term = np.argsort(idx, kind="stable")
                terms, starts = np.unique(idx[by_term], return_index=True)
                block = pickle.dumps((y[at:at + step], times[at:at + step], row, idx, val, by_term, terms, starts))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["block"])

    return run


def _gradient(model, n_labels: int, size: int):
    """Per partition: gradient of weights and bias, and loss, over all labels at once."""

    def run(blocks):
        import numpy as np

        weights, bias = model.value
        grad, grad_bias, loss = np.zeros((size, n_labels)), np.zeros(n_labels), np.zeros(n_labels)
        for y, times, row, idx, val, by_term, terms, starts in blocks:
            margin = np.tile(bias, (len(y), 1))
            if len(idx):
                rows, first = np.unique(row, return_index=True)
                margin[rows] += np.add.reduceat(val[:, None] * weights[idx], first)
            with np.errstate(over="ignore"):
                p = 1.0 / (1.0 + np.exp(-margin))
            truth = np.zeros_like(p)
            truth[np.arange(len(y)), y] = 1.0
            error = times[:, None] * (truth - p)
            grad_bias += error.sum(axis=0)
            loss -= times @ (truth * np.log(p + 1e-15) + (1 - truth) * np.log(1 - p + 1e-15))
            if len(idx):
                cells = (val[:, None] * error[row])[by_term]
                grad[terms] += np.add.reduceat(cells, starts)
        yield grad, grad_bias, loss

    return run


def _pack(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def _save_state(spark: SparkSession, path: str, run: str, epoch: int, weights: np.ndarray, bias: np.ndarray,
                losses: list) -> None:
    """One folder per state. Spark marks a folder that is complete, so half a state is never read."""
    rows = [(run, epoch, i, bytearray(_pack(weights[i:i + STATE_ROWS])), bytearray(_pack(bias)) if i == 0 else None,
             losses if i == 0 else None) for i in range(0, max(1, len(weights)), STATE_ROWS)]
    spark.createDataFrame(rows, STATE).repartition(len(rows)).write.parquet(f"{path}/epoch-{epoch:09d}")


def _load_state(spark: SparkSession, path: str) -> tuple | None:
    """(run, epoch, weights, bias, losses) of the latest complete state below `path`, if any."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return None
    for folder in sorted((str(f.getPath()) for f in fs.listStatus(hadoop)), reverse=True):
        if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")):
            rows = sorted(spark.read.schema(STATE).parquet(folder).collect(), key=lambda r: r.part)
            weights = np.concatenate([np.load(io.BytesIO(bytes(r.weights)))["arr_0"] for r in rows])
            return (rows[0].run, rows[0].epoch, weights, np.load(io.BytesIO(bytes(rows[0].bias)))["arr_0"],
                    [tuple(x) for x in rows[0].losses])
    return None


def train_ovr_gd(
    train: DataFrame, size: int, lr: float = 0.1, epochs: int = 1000, scale: str = "sum",
    features: str = "features", labels: list[str] | None = None, state_path: str | None = None, state_every: int = 100,
) -> OvrModel:
    """One-vs-rest logistic regression by full-batch gradient ascent from zero.

    `scale="sum"` adds the gradient over all rows, so steps grow with the table;
    `scale="mean"` divides by the row count. The rows stay on the executors as sparse
    blocks; per epoch the weights go out and one gradient per partition comes back
    through a tree. A lost executor's blocks are rebuilt from the stored rows.

    With `state_path`, weights and losses are stored there every `state_every` epochs. A later call
    with the same rows and settings goes on from the last stored epoch and ends with the same model as an unbroken
    run; a state of other settings is refused.
    """
    if scale not in ("sum", "mean"):
        raise ValueError("scale must be 'sum' or 'mean'")
    spark = train.sparkSession
    raw = F.unwrap_udt(features)
    # Stored once: labels, row count and blocks are taken from the stored rows.
    stored = materialize(train.select("label", raw["indices"].alias("indices"), raw["values"].alias("values")), "training")
    counts = stored.groupBy("label").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("label", "indices", "values")).alias("mark")
    ).limit(MAX_LABELS + 1).collect()
    if len(counts) > MAX_LABELS or labels is not None and len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    labels = sorted([r.label for r in counts] if labels is None else labels)
    n, k = sum(r.n for r in counts), len(labels)
    if n == 0:
        raise ValueError("no training rows")
    # Equal for equal rows in any order, and for equal settings.
    run = json.dumps([size, lr, scale, labels, n, sorted((str(r.label), r.mark) for r in counts)])
    y = (F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")) - 1).cast("int")
    rows = stored.select(y.alias("y"), "indices", "values")

    def unpack(record):
        import pickle
        return pickle.loads(record[0])

    tasks = -(-n // TASK_ROWS)
    # Equal rows are counted once each, then all are dealt by content: no copies pile up in a task, and a resumed
    # run adds up the same parts.
    content = ["y", "indices", "values"]
    dealt = rows.groupBy(*content).agg(F.count("*").alias("times")).repartition(tasks, *content).sortWithinPartitions(*content)
    blocks = dealt.mapInArrow(_to_blocks(k), "block binary").rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)
    weights, bias, losses, begin = np.zeros((size, k)), np.zeros(k), [], 0
    if state_path is not None and (state := _load_state(spark, state_path)) is not None:
        if state[0] != run or state[1] > epochs:
            raise ValueError(f"the state in {state_path} belongs to another run")
        _, begin, weights, bias, losses = state
    rate = lr if scale == "sum" else lr / n
    try:
        for epoch in range(begin + 1, epochs + 1):
            sent = spark.sparkContext.broadcast((weights, bias))
            grad, grad_bias, loss = blocks.mapPartitions(_gradient(sent, k, size)).treeReduce(
                lambda a, b: (a[0] + b[0], a[1] + b[1], a[2] + b[2]), depth=1 if tasks <= FLAT_TASKS else 2)
            sent.unpersist()
            weights, bias = weights + rate * grad, bias + rate * grad_bias
            if epoch % 100 == 0 or epoch == epochs:
                losses = losses + [(label, epoch, float(v) / n) for label, v in zip(labels, loss)]
            if state_path is not None and (epoch % state_every == 0 or epoch == epochs):
                _save_state(spark, state_path, run, epoch, weights, bias, losses)
    finally:
        blocks.unpersist()
    return OvrModel(labels, weights.T.copy(), bias, losses)


def _bounded_model(weights: DataFrame, biases: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Labels, weights (labels x terms) and biases of weight tables within `LITERAL_WEIGHTS` cells, else None."""
    bias = sorted(tuple(r) for r in biases.select("label", "bias").limit(MAX_LABELS + 1).collect())
    if len(bias) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    size = (weights.agg(F.max("idx")).first()[0] or 0) + 1
    if len(bias) * size > LITERAL_WEIGHTS:
        return None
    names = [x for x, _ in bias]
    place = {x: i for i, x in enumerate(names)}
    cells = weights.where(F.col("label").isin(names)).select("label", "idx", "weight").toArrow()
    matrix = np.zeros((len(names), size))
    rows = [place[x] for x in cells.column("label").to_pylist()]
    matrix[rows, cells.column("idx").to_numpy()] = cells.column("weight").to_numpy()
    return names, matrix, np.array([b for _, b in bias])


def score_join(features: DataFrame, weights: DataFrame, biases: DataFrame, rows: DataFrame,
               key: list[str] = KEY) -> DataFrame:
    """(key, label, score) from features in long form and a weight table of any size.

    `rows` holds every key, so that a row without features is scored by the bias alone; null keys match
    null keys. The cells of a row are gathered first, and scored for all labels inside the row; a
    weight table beyond `LITERAL_WEIGHTS` cells is joined cell by cell instead.
    """
    mine = [f"_{c}" for c in key]
    names = dict(zip(key, mine))
    model = _bounded_model(weights, biases)
    if model is not None:
        labels, matrix, bias = model
        cells = features.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("entries"))
        same = [F.col(c).eqNullSafe(F.col(m)) for c, m in names.items()]
        joined = rows.select(*key).join(cells.withColumnsRenamed(names), same, "left")
        cells = F.coalesce("entries", F.array().cast("array<struct<idx:int,weight:double>>"))
        scored = joined.withColumn("_scores", F.transform(_dots(cells, matrix, bias), sigmoid))
        pairs = F.arrays_zip(F.array(*[F.lit(x) for x in labels]).alias("label"), F.col("_scores").alias("score"))
        return scored.select(*key, F.inline(pairs))
    table = small_table(weights.filter(F.col("weight") != 0), SMALL_ROWS)
    cells = features.withColumnRenamed("weight", "x").join(table, "idx")
    dots = cells.groupBy(*key, "label").agg(F.sum(F.col("weight") * F.col("x")).alias("dot")).withColumnsRenamed(
        {**names, "label": "_label"})
    bias = biases.agg(F.collect_list(F.struct("label", "bias")).alias("_all")).first()["_all"]
    every = F.from_json(F.lit(json.dumps([b.asDict() for b in bias])), "array<struct<label:string,bias:double>>")
    same = [F.col(c).eqNullSafe(F.col(m)) for c, m in {**names, "label": "_label"}.items()]
    joined = rows.select(*key, F.inline(every)).join(dots, same, "left")
    z = F.col("bias") + F.coalesce(F.col("dot"), F.lit(0.0))
    return joined.select(*key, "label", sigmoid(z).alias("score"))


def _dots(cells: Column, weights: np.ndarray, bias: np.ndarray) -> Column:
    """The margin of every label for an array of (idx, weight), with the model as constants."""
    by_term = F.from_json(F.lit(json.dumps(weights.T.tolist())), "array<array<double>>")
    start = F.from_json(F.lit(json.dumps(bias.tolist())), "array<double>")
    # A term beyond the table has no weight.
    return F.aggregate(cells, start, lambda acc, e: F.when(F.get(by_term, e["idx"]).isNull(), acc).otherwise(
        F.zip_with(acc, F.get(by_term, e["idx"]), lambda a, w: a + w * e["weight"])))


def argmax_label(scored: DataFrame, key: list[str] = KEY) -> DataFrame:
    """(key, prediction, score): the best label of each key, ties in label order."""
    top = F.min(F.struct((-F.col("score")).alias("minus"), "label"))
    best = scored.groupBy(*key).agg(top.alias("_top"))
    return best.select(*key, F.col("_top.label").alias("prediction"), (-F.col("_top.minus")).alias("score"))


def _block_scorer(sent, names: list[str]):
    """Arrow batches with `_idx` and `_x` to the best label so far and its margin, over the blocks that were sent."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            lists = batch.column("_idx")
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            idx = lists.flatten().to_numpy(zero_copy_only=False)
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False)
            begin = np.cumsum(sizes) - sizes
            best = batch.column("_place").to_numpy(zero_copy_only=False).astype(np.int64)
            margin = batch.column("_margin").to_numpy(zero_copy_only=False).astype(float)
            # Rows by length, so that the k-th cell of all rows that have one is added at once, in the order of the cells.
            order = np.argsort(-sizes, kind="stable")
            for first, weights, bias in sent.value:
                step = max(1, BLOCK_CELLS // len(bias))
                for at in range(0, n, step):
                    rows = order[at:at + step]
                    z = np.tile(bias, (len(rows), 1))
                    for k in range(sizes[rows[0]] if len(rows) else 0):
                        some = rows[:np.searchsorted(-sizes[rows], -k, "left")]
                        cell = begin[some] + k
                        z[:len(some)] += weights[idx[cell]] * x[cell, None]
                    with np.errstate(over="ignore"):
                        p, before = 1.0 / (1.0 + np.exp(-z)), 1.0 / (1.0 + np.exp(-margin[rows]))
                    top = p.argmax(axis=1)
                    here = np.arange(len(rows))
                    better = (best[rows] < 0) | (p[here, top] > before)
                    best[rows] = np.where(better, first + top, best[rows])
                    margin[rows] = np.where(better, z[here, top], margin[rows])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(best), pa.array(margin)],
                                             [*names, "_place", "_margin"])
    return run


def _predict_blocks(model: OvrModel, df: DataFrame, features: str) -> DataFrame:
    """`predict_ovr` for models of any size: blocks of labels go out as broadcasts of bounded size, and
    each row keeps its best label so far. No keys, no joins, and no table of rows times labels."""
    spark = df.sparkSession
    cells = F.unwrap_udt(features)
    rows = df.select(F.struct("*").alias("_row"), cells["indices"].alias("_idx"), cells["values"].alias("_x"),
                     F.lit(-1).cast("bigint").alias("_place"), F.lit(0.0).alias("_margin"))
    size = model.weights.shape[1]
    per_block = max(1, LITERAL_WEIGHTS // size)
    blocks = [(i, np.ascontiguousarray(model.weights[i:i + per_block].T), model.bias[i:i + per_block])
              for i in range(0, len(model.labels), per_block)]
    per_pass = max(1, SENT_CELLS // (per_block * size))
    schema = rows.schema
    for at in range(0, len(blocks), per_pass):
        sent = spark.sparkContext.broadcast(blocks[at:at + per_pass])
        rows = rows.mapInArrow(_block_scorer(sent, ["_row", "_idx", "_x"]), schema)
    labels = F.from_json(F.lit(json.dumps(model.labels)), "array<string>")
    return rows.select("_row.*", F.get(labels, F.col("_place").cast("int")).alias("prediction"),
                       sigmoid("_margin").alias("score"))


def predict_ovr(model: OvrModel, df: DataFrame, features: str = "features", key: list[str] = KEY) -> DataFrame:
    """Add `prediction` and `score`. A row without features is scored by the bias alone.

    Scoring is a projection whatever the size: the weights enter it as constants, and those of a
    model beyond `LITERAL_WEIGHTS` cells as broadcasts of label blocks.
    """
    if model.weights.size > LITERAL_WEIGHTS:
        return _predict_blocks(model, df, features)
    scores = F.transform(_dots(F.col("entries"), model.weights, model.bias), sigmoid)
    names = F.array(*[F.lit(x) for x in model.labels])
    out = entries(df, features).withColumn("_scores", scores)
    best = F.array_max("_scores")
    return (
        out.withColumn("score", best)
        .withColumn("prediction", F.get(names, (F.array_position("_scores", F.col("score")) - 1).cast("int")))
        .select(*df.columns, "prediction", "score")
    )


# --- library classifiers ------------------------------------------------------------

def _with_labels(classifier, features: str) -> Pipeline:
    # Alphabetic label order makes ties between classes reproducible.
    index = StringIndexer(inputCol="label", outputCol="_y", stringOrderType="alphabetAsc")
    classifier = classifier.setFeaturesCol(features).setLabelCol("_y").setPredictionCol("_p")
    return Pipeline(stages=[index, classifier])


def _finish(fitted: PipelineModel) -> PipelineModel:
    index, model = fitted.stages
    if isinstance(model, OneVsRestModel) or model.numClasses == 2:
        # The summary of a two-class model holds the session, which no task can be sent once any query of it
        # was observed; a stored model has no summary.
        path = scratch_path(SparkSession.active(), "model")
        model.write().save(path)
        model = type(model).load(path)
    return PipelineModel([model, IndexToString(inputCol="_p", outputCol="prediction", labels=index.labels)])


def train_ovr(train: DataFrame, features: str = "features", max_iter: int = 50) -> PipelineModel:
    """One-vs-rest logistic regression with the standard solver, without regularisation."""
    base = LogisticRegression(regParam=0.0, standardization=False, maxIter=max_iter)
    return _finish(_with_labels(OneVsRest(classifier=base), features).fit(train))


def train_multinomial(train: DataFrame, features: str = "features", max_iter: int = 1000) -> PipelineModel:
    """Multinomial logistic regression with an L2 penalty of strength C = 1."""
    n = train.count()
    lr = LogisticRegression(family="multinomial", regParam=1.0 / n, elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter)
    return _finish(_with_labels(lr, features).fit(train))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `prediction`."""
    return model.transform(df).select(*df.columns, "prediction")


def _coefficients(model: PipelineModel) -> tuple[np.ndarray, np.ndarray, bool]:
    """Weights (classes x terms) and intercepts, and whether each class has a model of its own."""
    fitted = model.stages[0]
    if hasattr(fitted, "models"):
        return np.array([m.coefficients.toArray() for m in fitted.models]), np.array([m.intercept for m in fitted.models]), True
    return fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray(), False


def best_margin(model: PipelineModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Add `best`: the class of the largest margin, computed from the coefficients, ties in class order."""
    weights, bias, _ = _coefficients(model)
    names = F.array(*[F.lit(x) for x in model.stages[1].getLabels()])
    out = entries(df, features).withColumn("_z", _dots(F.col("entries"), weights, bias))
    place = F.array_position("_z", F.array_max("_z")) - 1
    return out.withColumn("best", F.get(names, place.cast("int"))).select(*df.columns, "best")


def optimality(model: PipelineModel, train: DataFrame, features: str = "features", penalty: float = 0.0) -> DataFrame:
    """(label, rows, loss, gradient): for every class the mean log loss of its own indicator and the largest absolute partial
    derivative of the mean penalised loss by its weights and intercept, at the trained model.

    At an optimum all are 0, however the solver got there. One pass and one aggregate by (label, term). For a multinomial
    model the probabilities are joint and `penalty` is its L2 strength; for one-vs-rest
    each class has a model of its own.
    """
    spark = train.sparkSession
    names = model.stages[1].getLabels()
    weights, bias, single = _coefficients(model)
    z = _dots(F.col("entries"), weights, bias)
    if single:
        p = F.transform(z, sigmoid)
    else:
        p = bind(z, lambda zs: bind(F.transform(zs, lambda v: F.exp(v - F.array_max(zs))), lambda es: F.transform(
            es, lambda e: e / F.aggregate(es, F.lit(0.0), lambda a, b: a + b))))
    labels = F.array(*[F.lit(x) for x in names])
    each = entries(train, features).select(
        "entries", F.posexplode(F.arrays_zip(labels.alias("name"), p.alias("p"), F.transform(
            labels, lambda x: (x == F.col("label")).cast("double")).alias("y"))).alias("place", "e"))
    # The intercept is term -1 with value 1.
    one = F.array(F.struct(F.lit(-1).alias("idx"), F.lit(1.0).alias("weight")))
    cells = each.select("place", F.col("e.name").alias("label"), (F.col("e.p") - F.col("e.y")).alias("error"),
                        F.when(F.col("e.y") == 1, -F.log(F.col("e.p") + 1e-15)).otherwise(
                            -F.log(1 - F.col("e.p") + 1e-15)).alias("loss"), F.explode(F.concat(one, "entries")).alias("c"))
    by_term = cells.groupBy("place", "label", F.col("c.idx").alias("idx")).agg(
        F.sum(F.col("error") * F.col("c.weight")).alias("g"), F.sum("loss").alias("loss"), F.count("*").alias("rows"))
    own = spark.createDataFrame([(i, t, float(v)) for i, w in enumerate(weights) for t, v in enumerate(w) if v],
                                "place int, idx int, w double")
    n = F.max(F.when(F.col("idx") == -1, F.col("rows")))
    # Terms without rows still feel the penalty.
    joined = by_term.join(own, ["place", "idx"], "full").withColumn("name", F.get(labels, F.col("place")))
    total = joined.groupBy("place", "name").agg(
        n.alias("rows"), F.max(F.when(F.col("idx") == -1, F.col("loss"))).alias("loss"),
        F.collect_list(F.struct(F.coalesce("g", F.lit(0.0)).alias("g"), F.coalesce("w", F.lit(0.0)).alias("w"))).alias("cells"))
    slope = F.array_max(F.transform("cells", lambda c: F.abs(c["g"] / F.col("rows") + penalty * c["w"])))
    return total.select(F.col("name").alias("label"), "rows", (F.col("loss") / F.col("rows")).alias("loss"), slope.alias("gradient"))


def train_majority(train: DataFrame) -> str:
    """The most frequent label, ties in label order."""
    top = train.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc("label")).first()
    if top is None:
        raise ValueError("no training rows")
    return top.label


def predict_majority(label: str, df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.lit(label))


# --- topics -------------------------------------------------------------------------

class _TopicWriter(MLWriter):
    def __init__(self, instance: TopicModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        own = self.instance
        DefaultParamsWriter.saveMetadata(own, path, self.sparkSession, extraMetadata={"k": own.k, "terms": own.terms})
        own.topics.write.parquet(f"{path}/topics")
        own.vocab.select("term", "idx").write.parquet(f"{path}/vocab")


class _TopicReader(MLReader):
    def read_part(self, path: str, schema: str) -> DataFrame:
        return self.sparkSession.read.schema(schema).parquet(path)

    def load(self, path: str) -> TopicModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        own = TopicModel(self.read_part(f"{path}/topics", CELLS), self.read_part(f"{path}/vocab", "term string, idx long"),
                         meta["k"], meta["terms"])
        own._resetUid(meta["uid"])
        return own


class TopicModel(Model, MLWritable, MLReadable):
    """Topics (idx, weights) and the vocabulary (term, idx), both as tables, so that they may be of any size."""

    def __init__(self, topics: DataFrame, vocab: DataFrame, k: int, terms: str):
        super().__init__()
        self.topics, self.vocab, self.k, self.terms = topics, vocab, k, terms

    def write(self) -> MLWriter:
        return _TopicWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TopicReader()

    def _transform(self, df: DataFrame) -> DataFrame:
        """Add `topicDistribution`, all zeros for a row without vocabulary terms. The rows are stored, to be numbered once."""
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        blocks = term_blocks(rows, self.vocab, self.terms, F.col("_row"))
        found = topic_mixtures(blocks, self.topics, self.k).select(F.col("row").alias("_row"), "mixture")
        mixture = F.coalesce("mixture", F.array_repeat(F.lit(0.0), self.k))
        return rows.join(found, "_row", "left").select(*df.columns, array_to_vector(mixture).alias("topicDistribution"))


def train_topics(
    df: DataFrame, k: int = 10, seed: int = 42, terms: str = "tokens", max_iter: int = 10,
    vocab: DataFrame | None = None,
) -> PipelineModel:
    """Latent Dirichlet allocation on term counts over the whole vocabulary, or over `vocab` (term, idx), by the steps of the
    library's online solver with priors of 1/k. The driver holds no term."""
    if vocab is None:
        vocab = materialize(build_vocabulary(df, terms, max_features=None), "vocab")
    vocab = vocab.withColumn("idx", F.col("idx").cast("bigint"))
    topics = train_topic_table(term_blocks(df, vocab, terms), vocab, k, seed, max_iter, online=True)
    return PipelineModel([TopicModel(topics, vocab, k, terms)])


def top_words(model: PipelineModel, n: int = 10) -> DataFrame:
    """(topic, rank, term, weight): the heaviest terms of each topic."""
    fitted = model.stages[-1]
    return top_topic_words(fitted.topics, fitted.vocab, fitted.k, n)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
