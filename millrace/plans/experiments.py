"""Experiments: runs of a function over many parameter combinations, kept as tables.

Every run appends status rows and writes its trial results once, as JSON below
``runs/run_id=<id>/``. Best picks and summaries read these rows back, so no trial runs twice.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import duration_text
from millrace.operators import evolution, trials as T
from millrace.operators.trials import MAX, check_direction
from millrace.session import path_exists, qualified, shared_dir

# --- fixed values -------------------------------------------------------------------------------
RUNNING, FINISHED, FAILED, KILLED = "RUNNING", "FINISHED", "FAILED", "KILLED"
NO_NAME = "no-name"
STATUS_SCHEMA = (
    "run_id string, name string, description string, function string, experiment_type string, "
    "direction string, optimization_key string, state string, metric double, best_params string, "
    "duration_ms long, seq long"
)
# ------------------------------------------------------------------------------------------------


def latest_status(statuses: DataFrame, key: str = "run_id", order: str = "seq") -> DataFrame:
    """Newest status row of every run; each task hands on one row per run."""
    row = F.struct(*[F.col(c) for c in statuses.columns if c != key])
    return statuses.groupBy(key).agg(F.max_by(row, order).alias("_last")).select(key, "_last.*")


def run_summary(results: DataFrame) -> DataFrame:
    """(trial_id, parameters, outputs) with both sides as JSON text."""
    return results.select("trial_id", F.to_json("params").alias("parameters"), F.to_json("outputs").alias("outputs"))


def _parsed(text: str | None):
    if text is None:
        return None
    try:
        return json.loads(text)
    except ValueError:
        return text


class Experiments:
    """Runs of one application below ``root`` (by default in the shared folder)."""

    def __init__(self, spark: SparkSession, root: str | None = None, application: str | None = None):
        self.spark = spark
        self.root = root or shared_dir(spark, "experiments")
        self.application = application or spark.sparkContext.applicationId
        self._count = 0
        self._active: str | None = None

    # Runs ---------------------------------------------------------------------------------------

    def _append(self, **status) -> None:
        row = {**status, "seq": time.time_ns()}
        self.spark.createDataFrame([row], STATUS_SCHEMA).write.mode("append").json(f"{self.root}/status")

    def _run(self, kind: str, function: Callable, body: Callable, name: str, description: str | None,
             direction: str | None, optimization_key: str | None):
        if self._active:
            raise RuntimeError(f"run {self._active} is active, only one may run at a time")
        self._count += 1
        run_id = f"{self.application}_{self._count}"
        while path_exists(self.spark, self.run_path(run_id)):  # numbers of earlier sessions
            self._count += 1
            run_id = f"{self.application}_{self._count}"
        self._active = run_id
        common = {
            "run_id": run_id,
            "name": kind if name == NO_NAME else name,
            "description": description,
            "function": getattr(function, "__name__", type(function).__name__),
            "experiment_type": kind,
            "direction": direction,
            "optimization_key": optimization_key,
        }
        started = time.time()
        state, metric, params = FAILED, None, None
        context = self.spark.sparkContext
        context.setJobDescription(f"{kind} {run_id}")
        try:
            self._append(**common, state=RUNNING, metric=None, best_params=None, duration_ms=None)
            answer, metric, params = body(run_id)
            state = FINISHED
            return answer
        except KeyboardInterrupt:
            state = KILLED
            raise
        finally:
            context.setJobDescription(None)
            self._active = None
            self._append(
                **common, state=state, metric=metric,
                best_params=json.dumps(params) if params is not None else None,
                duration_ms=round((time.time() - started) * 1000),
            )

    def run_path(self, run_id: str) -> str:
        return f"{self.root}/runs/run_id={run_id}"

    def store_results(self, run_id: str, results: DataFrame) -> DataFrame:
        """Write the trials of a run and read them back, so that nothing is computed again."""
        target = f"{self.run_path(run_id)}/trials"
        results.write.mode("overwrite").json(target)
        return self.spark.read.schema(T.RESULT_SCHEMA).json(target)

    def files_path(self, run_id: str) -> str:
        """Where files that trials return, and their logs, are kept."""
        return qualified(self.spark, f"{self.run_path(run_id)}/files")

    def _evaluated(self, run_id: str, trials: DataFrame, train_fn: Callable, key: str | None, optimise: bool, count: int) -> DataFrame:
        """Stored results of all trials; published files of lost attempts are removed."""
        files = self.files_path(run_id)
        stored = self.store_results(run_id, T.evaluate(trials, train_fn, key, optimise, count, files))
        T.drop_unnamed(stored, files)
        return stored

    def _search(self, kind, train_fn, trials, count, direction, optimization_key, name, description):
        direction = check_direction(direction)

        def body(run_id):
            stored = self._evaluated(run_id, trials, train_fn, optimization_key, True, count)
            best = T.best_trial(stored, direction).first()
            if best is None:
                raise ValueError("no trial returned a number to compare")
            params = {k: _parsed(v) for k, v in best.params.items()}
            outputs = {k: _parsed(v) for k, v in best.outputs.items()}
            return (self.run_path(run_id), params, outputs), best.metric, params

        return self._run(kind, train_fn, body, name, description, direction, optimization_key)

    def launch(self, train_fn: Callable, args_dict: Mapping[str, Sequence] | None = None, name: str = NO_NAME,
               description: str | None = None, metric_key: str | None = None) -> tuple[str, dict | None]:
        """Run once, or once per position of equally long argument lists.

        Returns the run folder and, for exactly one run, its outputs.
        """
        trials = T.zipped(self.spark, args_dict)
        count = len(next(iter(args_dict.values()))) if args_dict else 1

        def body(run_id):
            stored = self._evaluated(run_id, trials, train_fn, None, False, count)
            if count != 1:
                return (self.run_path(run_id), None), None, None
            outputs = {k: _parsed(v) for k, v in (stored.first().outputs or {}).items()}
            metric = None
            if metric_key:
                if metric_key not in outputs:
                    raise AssertionError(f"metric_key {metric_key} is not in the returned values {outputs}")
                metric = outputs[metric_key]
            elif set(outputs) <= {"metric", "log"}:
                metric = outputs.get("metric")
            return (self.run_path(run_id), outputs), (None if metric is None else float(metric)), None

        return self._run("launch", train_fn, body, name, description, None, metric_key)

    def grid_search(self, train_fn: Callable, grid_dict: Mapping[str, Sequence], direction: str = MAX,
                    name: str = NO_NAME, description: str | None = None, optimization_key: str = "metric"):
        """Every combination of the listed values. Returns (folder, best parameters, outputs)."""
        unique = {n: list(dict.fromkeys(v)) for n, v in grid_dict.items()}
        return self._search("grid_search", train_fn, T.grid(self.spark, unique), T.grid_size(unique), direction,
                            optimization_key, name, description)

    def random_search(self, train_fn: Callable, boundary_dict: Mapping[str, Sequence], samples: int = 10,
                      direction: str = MAX, name: str = NO_NAME, description: str | None = None,
                      optimization_key: str = "metric", seed: int = 42):
        """Independent draws inside the boundaries. Returns (folder, best parameters, outputs)."""
        trials = T.random_samples(self.spark, boundary_dict, samples, seed)
        return self._search("random_search", train_fn, trials, samples, direction, optimization_key, name, description)

    def differential_evolution(self, train_fn: Callable, boundary_dict: Mapping[str, Sequence], direction: str = MAX,
                               generations: int = 4, population: int = 6, mutation: float = 0.5,
                               crossover: float = 0.7, name: str = NO_NAME, description: str | None = None,
                               optimization_key: str = "metric", seed: int = 42):
        """Evolve a population. Returns (folder, best parameters, outputs) over all generations."""
        direction = check_direction(direction)

        def body(run_id):
            found = evolution.evolve(
                self.spark, lambda trials: T.evaluate(
                    trials, train_fn, optimization_key, True, population, self.files_path(run_id)
                ), boundary_dict,
                self.run_path(run_id), direction, generations, population, mutation, crossover, seed,
            )
            stored = self.store_results(run_id, numbered(found.history))
            T.drop_unnamed(stored, self.files_path(run_id))
            best = T.best_trial(stored, direction).first()
            params = {k: _parsed(v) for k, v in best.params.items()}
            outputs = {k: _parsed(v) for k, v in best.outputs.items()}
            return (self.run_path(run_id), params, outputs), best.metric, params

        return self._run("differential_evolution", train_fn, body, name, description, direction, optimization_key)

    # Reads --------------------------------------------------------------------------------------

    def statuses(self) -> DataFrame:
        """Newest status of every run, with its duration as text."""
        rows = self.spark.read.schema(STATUS_SCHEMA).json(f"{self.root}/status")
        return latest_status(rows).withColumn("duration", duration_text("duration_ms"))

    def results(self, run_id: str | None = None) -> DataFrame:
        """Stored trials of one run or of all; ``run_id`` is a partition column."""
        rows = self.spark.read.schema(T.RESULT_SCHEMA + ", run_id string").option(
            "basePath", f"{self.root}/runs"
        ).json(f"{self.root}/runs/run_id=*/trials")
        return rows if run_id is None else rows.filter(F.col("run_id") == run_id)

    def summary(self, run_id: str) -> DataFrame:
        return run_summary(self.results(run_id))


def numbered(history: DataFrame) -> DataFrame:
    """Scored combinations of a search with one id each: generation first, then individual."""
    ordered = F.col("generation") * F.lit(1 << 32) + F.col("trial_id")
    return history.select(ordered.alias("trial_id"), "trial_key", "params", "outputs", "metric")


def temporary_root(spark: SparkSession) -> str:
    return shared_dir(spark, f"experiments-{uuid.uuid4().hex}")
