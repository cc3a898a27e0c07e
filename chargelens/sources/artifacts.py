"""A fitted model on disk: the pipeline, and one row of what is needed to use it."""

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel


class ModelNotFound(FileNotFoundError):
    pass


@dataclass
class Artifact:
    pipeline: PipelineModel     # raw feature columns in, forest score out
    threshold: float
    features_num: list
    features_cat: list
    feature_names: list
    trained_at: str
    train_rows: int
    pr_auc: float

    @property
    def forest(self):
        return self.pipeline.stages[-1]

    @property
    def inputs(self):
        return PipelineModel(self.pipeline.stages[:-1])


METADATA = ("threshold double, features_num array<string>, features_cat array<string>, "
            "feature_names array<string>, trained_at string, train_rows bigint, pr_auc double")
FIELDS = [part.split()[0] for part in METADATA.split(", ")]


def now():
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def save(artifact, folder, spark):
    artifact.pipeline.write().overwrite().save(f"{folder}/pipeline")
    row = tuple(getattr(artifact, name) for name in FIELDS)
    spark.createDataFrame([row], METADATA).write.mode("overwrite").json(f"{folder}/metadata")


def load(spark, folder):
    try:
        row = spark.read.schema(METADATA).json(f"{folder}/metadata").first()
    except AnalysisException as error:
        raise ModelNotFound(f"no model at {folder}; run the training job first") from error
    return Artifact(PipelineModel.load(f"{folder}/pipeline"), **row.asDict())
