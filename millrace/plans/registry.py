"""Model registry: versions of models as rows of a partitioned table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import NAME_MAX_LENGTH, check_metrics
from millrace.operators.trials import MAX, check_direction
from millrace.session import create_once, path_exists, shared_dir

MODEL_SCHEMA = (
    "name string, version int, metrics map<string,double>, path string, description string, experiment_id string"
)


class ModelNotFound(Exception):
    """No model of that name, version or metric."""


# Operators over a frame of model versions -------------------------------------------------------

def best_models(models: DataFrame, name: str, metric: str, direction: str) -> DataFrame:
    """The version of a model with the extreme metric; versions without it never win."""
    value = F.col("metrics")[metric]
    order = value.desc() if check_direction(direction) == MAX else value.asc()
    candidates = models.filter((F.col("name") == name) & value.isNotNull() & ~F.isnan(value))
    return candidates.orderBy(order, F.col("version").asc()).limit(1)


def model_version(models: DataFrame, name: str, version: int) -> DataFrame:
    return models.filter((F.col("name") == name) & (F.col("version") == version))


def next_versions(models: DataFrame) -> DataFrame:
    """Per model the latest version and the one an export without version takes.

    Versions may be text, as in folder names; entries that are no whole number do not count.
    """
    number = F.expr("try_cast(version AS int)")
    return models.groupBy("name").agg(
        F.coalesce(F.max(number), F.lit(0)).alias("latest_version"),
        (F.coalesce(F.max(number), F.lit(0)) + 1).alias("next_version"),
    )


def link_experiments(models: DataFrame, experiments: DataFrame) -> DataFrame:
    """Models with the run that made them; models of no run stay."""
    runs = experiments.withColumnRenamed("run_id", "experiment_id")
    return models.join(runs, "experiment_id", "left")


# Registry ---------------------------------------------------------------------------------------

class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or shared_dir(spark, "models")

    def models(self) -> DataFrame:
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], MODEL_SCHEMA)
        return self.spark.read.schema(MODEL_SCHEMA).parquet(self.root).select("name", "version", "metrics", "path",
                                                                             "description", "experiment_id")

    def export(self, path: str, name: str, version: int | None = None, metrics: Mapping | None = None,
               description: str | None = None, overwrite: bool = False, experiment_id: str | None = None) -> int:
        """Register the files at ``path`` as a model version and return the version.

        Without a version the next one is taken. A version that exists is replaced only with
        ``overwrite``. A version is reserved by a file that can be created once, so exports at the
        same time get different ones; that of an export that failed is not given out again.
        """
        checked = check_metrics(metrics)
        if not name or len(name) > NAME_MAX_LENGTH or "/" in name or "=" in name:
            raise ValueError(f"not a model name: {name!r}")
        own = self.models().filter(F.col("name") == name)
        if version is None:
            version = (own.agg(F.max("version")).first()[0] or 0) + 1
            while not self._reserve(name, version):
                version += 1
        elif not overwrite:
            if not own.filter(F.col("version") == version).isEmpty() or not self._reserve(name, version):
                raise ValueError(f"version {version} of model {name} exists")
        row = (name, int(version), checked, path, description or f"A collection of models for {name}", experiment_id)
        # Dynamic overwrite replaces this version's partition and no other.
        self.spark.createDataFrame([row], MODEL_SCHEMA).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("name", "version").parquet(self.root)
        return int(version)

    def _reserve(self, name: str, version: int) -> bool:
        return create_once(self.spark, f"{self.root.rstrip('/')}.reserved/{name}/{int(version)}")

    def get_model(self, name: str, version: int):
        return self._one(model_version(self.models(), name, version), f"{name} version {version}")

    def get_best_model(self, name: str, metric: str, direction: str = MAX):
        return self._one(best_models(self.models(), name, metric, direction), f"{name} with metric {metric}")

    @staticmethod
    def _one(found: DataFrame, what: str):
        row = found.first()
        if row is None:
            raise ModelNotFound(f"no model {what}")
        return row
