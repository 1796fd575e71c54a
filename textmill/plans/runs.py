"""A whole trained run on disk: every part in its folder, and a manifest that is written last.

A run is loaded through its manifest only, so one that was interrupted while it was saved, or is
being replaced, is never taken for a whole one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from textmill.operators import models as M
from textmill.operators.corpus import KeywordMap, keyword_frame
from textmill.plans.benchmark import LibraryRun, OvrRun

MANIFEST = "version int, parts string, kind string, majority string, labels array<string>, settings map<string,string>"


@dataclass
class SavedRun:
    features: PipelineModel
    model: M.OvrModel | PipelineModel
    majority: str | None
    kwmap: DataFrame
    labels: list[str]
    settings: dict[str, str]


def save_run(run: OvrRun | LibraryRun, path: str, kwmap: KeywordMap, settings: dict[str, str] | None = None) -> None:
    """Save features, model, majority label and keyword map, then the manifest. `settings` (seed, shares, ...) go
    along as they are. Saving again replaces the manifest; the parts of each save have a folder of their own."""
    single = isinstance(run, OvrRun)
    spark = run.predictions.sparkSession if single else run.train.sparkSession
    parts = f"parts-{uuid.uuid4().hex}"
    M.save_model(run.features, f"{path}/{parts}/features")
    keyword_frame(spark, kwmap).write.parquet(f"{path}/{parts}/keywords")
    if single:
        run.model.save(spark, f"{path}/{parts}/model")
    else:
        M.save_model(run.model, f"{path}/{parts}/model")
    row = (1, parts, "ovr" if single else "library", None if single else run.majority, run.labels if single else None, settings or {})
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def load_run(spark: SparkSession, path: str) -> SavedRun:
    """The run that the manifest in `path` names."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/_SUCCESS")
    if not name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(name):
        raise ValueError(f"no complete run in {path}")
    row = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").first()
    parts = f"{path}/{row.parts}"
    model = M.OvrModel.load(spark, f"{parts}/model") if row.kind == "ovr" else M.load_model(f"{parts}/model")
    return SavedRun(M.load_model(f"{parts}/features"), model, row.majority, spark.read.parquet(f"{parts}/keywords"),
                    row.labels, dict(row.settings))
