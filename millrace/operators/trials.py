"""Trials: parameter combinations as rows, black-box and data-parallel evaluation, best picks.

A trial frame has ``trial_id`` (its position, which breaks ties) and one typed column per
parameter. A result frame has ``trial_id, trial_key, params, outputs, metric``.
"""

from __future__ import annotations

import contextlib
import inspect
import io
import json
import os
import shutil
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import draw, trial_key, uniform_between
from millrace.session import fresh_dir, qualified
from millrace.sources.file_writer import file_system

MAX, MIN = "MAX", "MIN"
RESULT_SCHEMA = (
    "trial_id long, trial_key string, params map<string,string>, outputs map<string,string>, metric double"
)
# Aggregates of one data scan; more trials take further scans. With many more, the generated code of a
# scan becomes too large for the JVM to compile well, which costs more than reading again.
_TRIALS_PER_SCAN = 32
# Trials whose scans make one job.
_TRIALS_PER_PAGE = 256


def check_direction(direction: str) -> str:
    if not isinstance(direction, str) or direction.upper() not in (MAX, MIN):
        raise ValueError(f"direction must be MAX or MIN, not {direction!r}")
    return direction.upper()


# Trial frames -----------------------------------------------------------------------------------

def _values(name: str, values: Sequence) -> Column:
    kinds = {("number" if isinstance(v, (int, float)) and not isinstance(v, bool) else type(v)) for v in values}
    if len(kinds) > 1:
        raise ValueError(f"values of {name} differ in type: {list(values)!r}")
    return F.array(*[F.lit(v) for v in values])


def zipped(spark: SparkSession, params: Mapping[str, Sequence] | None = None) -> DataFrame:
    """One trial per position of the value lists, which must be equally long."""
    params = params or {}
    sizes = {len(v) for v in params.values()}
    if len(sizes) > 1:
        raise ValueError(f"value lists differ in length: { {k: len(v) for k, v in params.items()} }")
    count = sizes.pop() if sizes else 1
    ids = spark.range(count).withColumnRenamed("id", "trial_id")
    position = (F.col("trial_id") + 1).cast("int")
    return ids.select("trial_id", *[F.element_at(_values(n, v), position).alias(n) for n, v in params.items()])


def grid_size(params: Mapping[str, Sequence]) -> int:
    return reduce(lambda size, values: size * len(values), params.values(), 1)


def grid(spark: SparkSession, params: Mapping[str, Sequence]) -> DataFrame:
    """Every combination, the last parameter changing fastest.

    A combination is its number written in the mixed radix of the list lengths, so the product
    needs neither a join nor a shuffle. Repeated values of a parameter count once.
    """
    params = {n: list(dict.fromkeys(v)) for n, v in params.items()}
    if not params or any(not v for v in params.values()):
        raise ValueError("a grid needs at least one value per parameter")
    count = grid_size(params)
    columns, stride = [], count
    for name, values in params.items():
        stride //= len(values)
        digit = F.pmod(F.floor(F.col("trial_id") / F.lit(stride)), F.lit(len(values)))
        columns.append(F.element_at(_values(name, values), (digit + 1).cast("int")).alias(name))
    return spark.range(count).withColumnRenamed("id", "trial_id").select("trial_id", *columns)


def random_samples(spark: SparkSession, boundaries: Mapping[str, Sequence], samples: int = 10, seed: int = 42) -> DataFrame:
    """Independent draws per parameter; repeated combinations are dropped, not drawn again."""
    for name, pair in boundaries.items():
        if len(pair) != 2:
            raise ValueError(f"boundaries of {name} must be a lower and an upper one: {pair!r}")
    drawn = spark.range(samples).withColumnRenamed("id", "trial_id").select(
        "trial_id",
        *[
            uniform_between(pair[0], pair[1], draw(seed, "trial_id", F.lit(i))).alias(name)
            for i, (name, pair) in enumerate(boundaries.items())
        ],
    )
    return drop_repeated(drawn, list(boundaries))


def drop_repeated(trials: DataFrame, names: Sequence[str]) -> DataFrame:
    """First trial of each combination.

    The earliest id per combination is a minimum, which tasks combine before the shuffle, so a
    combination that makes up most of the rows still moves one row per task.
    """
    others = [c for c in trials.columns if c not in (*names, "trial_id")]
    payload = F.struct("trial_id", *[F.col(f"`{c}`") for c in (*names, *others)])
    firsts = trials.withColumn("_key", trial_key(names)).groupBy("_key").agg(F.min_by(payload, "trial_id").alias("_row"))
    return firsts.select("_row.*").select(*trials.columns)


# Evaluation -------------------------------------------------------------------------------------

def argument_names(function: Callable) -> list[str]:
    return list(inspect.signature(function).parameters)


def _plain(value):
    """JSON-ready value of what a trial returned."""
    if hasattr(value, "tolist"):
        return value.tolist()
    if hasattr(value, "item"):
        return value.item()
    raise TypeError(f"{type(value).__name__} value cannot be stored: {value!r}")


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, default=_plain)


def _number(value) -> float:
    try:
        return float(value)
    except (TypeError, ValueError, OverflowError):
        raise ValueError(f"a metric must be a number: {value!r}") from None


def normalise(returned, optimization_key: str | None, optimise: bool) -> tuple[dict[str, str | None], float | None]:
    """Outputs as text, and the metric.

    When something is optimised, a scalar becomes ``{"metric": scalar}``, a dict must hold the key
    and its value must be a number. Otherwise anything is kept as it is.
    """
    outputs = returned if isinstance(returned, dict) else {"metric": returned}
    if not optimise:
        return {str(k): _text(v) for k, v in outputs.items()}, None
    key = optimization_key or "metric"
    if isinstance(returned, dict):
        if not returned:
            raise ValueError("the returned dict is empty, it must hold a metric")
        if not optimization_key and len(returned) > 1:
            raise ValueError("optimization_key must be set when several values are returned")
        if key not in returned:
            raise ValueError(f"optimization_key {key!r} is not in the returned dict")
    else:
        key = "metric"
    return {str(k): _text(v) for k, v in outputs.items()}, _number(outputs[key])


def published(outputs, folder: str):
    """Returned values, with local files and folders among them moved below ``folder`` and named by their new path.

    A task that is run twice publishes twice, under different names; :func:`drop_unnamed` removes
    what no result row names.
    """
    from pyarrow import fs

    if not isinstance(outputs, dict):
        return outputs
    found = dict(outputs)
    for key, value in outputs.items():
        if not isinstance(value, str) or not value or not os.path.exists(value):
            continue
        system, root = file_system(folder)
        place = f"{uuid.uuid4().hex}/{os.path.basename(value.rstrip('/'))}"
        target = f"{root}/{place}"
        system.create_dir(target if os.path.isdir(value) else os.path.dirname(target), recursive=True)
        fs.copy_files(os.path.abspath(value), target, source_filesystem=fs.LocalFileSystem(), destination_filesystem=system)
        shutil.rmtree(value) if os.path.isdir(value) else os.remove(value)
        found[key] = f"{folder}/{place}"
    return found


def drop_unnamed(results: DataFrame, folder: str) -> int:
    """Remove the published files that no output of ``results`` names, as attempts that were lost leave them.

    Returns how many folders went. Results must be stored, since a new evaluation publishes anew.
    """
    from pyarrow import fs

    system, root = file_system(folder)
    if system.get_file_info(root).type != fs.FileType.Directory:
        return 0
    spark = results.sparkSession
    present = [(i.base_name,) for i in system.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory]
    listed = spark.createDataFrame(present, "place string")
    value = results.select(F.explode(F.map_values("outputs")).alias("value"))
    named = value.filter(F.startswith("value", F.lit(f"{folder}/"))).select(
        F.substring_index(F.substring("value", len(folder) + 2, 1 << 20), "/", 1).alias("place")
    )
    lost = [r.place for r in listed.join(named, "place", "left_anti").collect()]
    for place in lost:
        system.delete_dir(f"{root}/{place}")
    return len(lost)


def _called(function: Callable, arguments: dict, shared: str | None):
    """What a trial returns, and the path of its log if it printed anything."""
    if shared is None:
        return function(**arguments), None
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        returned = published(function(**arguments), shared)
    if not shown.getvalue():
        return returned, None
    system, root = file_system(shared)
    place = f"{uuid.uuid4().hex}/output.log"
    system.create_dir(os.path.dirname(f"{root}/{place}"), recursive=True)
    with system.open_output_stream(f"{root}/{place}") as out:
        out.write(shown.getvalue().encode())
    return returned, f"{shared}/{place}"


def evaluate(
    trials: DataFrame,
    function: Callable,
    optimization_key: str | None = "metric",
    optimise: bool = True,
    parallelism: int | None = None,
    files: str | None = None,
) -> DataFrame:
    """Run a Python function once per trial and return its results as rows.

    ``parallelism`` is the number of tasks, by default as many as trials; trials go to them by their
    id in turn. An exception in the function fails the job. With ``files``, a folder that all
    executors share, local files that the function returns are moved there, and what it prints
    becomes the file ``log`` of its outputs. The frame is lazy: write it before it is used more than
    once.
    """
    names = argument_names(function)
    missing = [n for n in names if n not in trials.columns]
    if missing:
        raise KeyError(f"no values for the arguments {missing}")
    tasks = parallelism or max(1, trials.count())
    shared = None if files is None else qualified(trials.sparkSession, files)
    prepared = trials.select("trial_id", trial_key(names).alias("trial_key"), *names)
    # The id names the partition: hashing could give one task several trials and others none.
    spread = prepared.repartitionById(tasks, F.pmod("trial_id", F.lit(tasks)).cast("int"))

    def run(batches):
        import pyarrow as pa

        target = pa.schema([
            ("trial_id", pa.int64()), ("trial_key", pa.string()), ("params", pa.map_(pa.string(), pa.string())),
            ("outputs", pa.map_(pa.string(), pa.string())), ("metric", pa.float64()),
        ])
        for batch in batches:
            results = []
            for row in batch.to_pylist():
                arguments = {n: row[n] for n in names}
                returned, log = _called(function, arguments, shared)
                outputs, metric = normalise(returned, optimization_key, optimise)
                if log is not None:
                    outputs["log"] = log
                results.append({
                    "trial_id": row["trial_id"],
                    "trial_key": row["trial_key"],
                    "params": [(n, _text(v)) for n, v in arguments.items()],
                    "outputs": list(outputs.items()),
                    "metric": metric,
                })
            yield pa.RecordBatch.from_pylist(results, schema=target)

    return spread.mapInArrow(run, RESULT_SCHEMA)


def score_over(data: DataFrame, trials: DataFrame, metric: Callable[[dict[str, Column]], Column]) -> DataFrame:
    """Data-parallel evaluation: ``metric`` turns parameter literals into an aggregate over ``data``.

    Trials are aggregates of the same scan, so the data is read once per 32 trials, no row is copied
    per trial, and only one row per task is shuffled. The trial list is read in pages; if there is
    more than one page, the scans of each are written before the next page is planned, so that plan
    and driver hold one page, however many trials there are.
    """
    names = [c for c in trials.columns if c not in ("trial_id", "trial_key")]
    keyed = trials.select("trial_id", trial_key(names).alias("trial_key"), *names)

    def scan(rows):
        # The aggregate sits in one wide row and is then turned into a row per trial.
        wide = data.agg(*[
            metric({n: F.lit(r[n]) for n in names}).cast("double").alias(f"m{i}") for i, r in enumerate(rows)
        ])
        entries = [
            F.struct(
                F.lit(r.trial_id).cast("long").alias("trial_id"), F.lit(r.trial_key).alias("trial_key"),
                F.create_map(*[F.lit(x) for n in names for x in (n, _text(r[n]))]).alias("params"),
                F.col(f"m{i}").alias("metric"),
            )
            for i, r in enumerate(rows)
        ]
        return wide.select(F.inline(F.array(*entries))).select(
            "trial_id", "trial_key", "params",
            F.create_map(F.lit("metric"), F.col("metric").cast("string")).alias("outputs"), "metric",
        )

    def page_after(last):
        rest = keyed if last is None else keyed.filter(F.col("trial_id") > last)
        return rest.orderBy("trial_id").limit(_TRIALS_PER_PAGE).collect()

    def scans(rows):
        return reduce(DataFrame.unionAll, [scan(rows[i:i + _TRIALS_PER_SCAN]) for i in range(0, len(rows), _TRIALS_PER_SCAN)])

    spark = data.sparkSession
    page = page_after(None)
    if not page:
        return spark.createDataFrame([], RESULT_SCHEMA)
    if len(page) < _TRIALS_PER_PAGE:
        return scans(page)
    path = fresh_dir(spark, "scores")
    while page:
        scans(page).write.mode("append").parquet(path)
        page = page_after(page[-1].trial_id)
    return spark.read.schema(RESULT_SCHEMA).parquet(path)


# Picks and summaries ----------------------------------------------------------------------------

def _order(direction: str) -> list[Column]:
    metric = F.col("metric").desc() if check_direction(direction) == MAX else F.col("metric").asc()
    return [metric, F.col("trial_id").asc()]


def best_trial(results: DataFrame, direction: str = MAX) -> DataFrame:
    """The extreme metric; of equal ones the first trial. Each task keeps one row."""
    valid = results.filter(F.col("metric").isNotNull() & ~F.isnan("metric"))
    return valid.orderBy(*_order(direction)).limit(1)


def metric_summary(results: DataFrame) -> DataFrame:
    """Number of trials, and the maximum, minimum and mean metric."""
    valid = results.filter(F.col("metric").isNotNull() & ~F.isnan("metric"))
    return valid.agg(
        F.count(F.lit(1)).alias("trials"), F.max("metric").alias("max_metric"),
        F.min("metric").alias("min_metric"), F.avg("metric").alias("avg_metric"),
    )


def best_per_group(results: DataFrame, group: str, direction: str = MAX) -> DataFrame:
    """Mean and best metric of every group, with the first trial that reaches the best."""
    sign = 1 if check_direction(direction) == MAX else -1
    valid = results.filter(F.col("metric").isNotNull() & ~F.isnan("metric"))
    rank = F.struct((F.col("metric") * sign).alias("m"), (-F.col("trial_id")).alias("i"))
    return valid.groupBy(group).agg(
        F.count(F.lit(1)).alias("trials"), F.avg("metric").alias("avg_metric"),
        F.max_by(F.struct("trial_id", "trial_key", "metric"), rank).alias("_best"),
    ).select(group, "trials", "avg_metric", F.col("_best.metric").alias("best_metric"),
             F.col("_best.trial_id").alias("best_trial_id"), F.col("_best.trial_key").alias("best_trial_key"))


def join_parameters(outputs: DataFrame, params: DataFrame, on: str | Sequence[str] = "trial_id") -> DataFrame:
    """Outputs with the parameters of the same run; a run without stored parameters stays, with null."""
    return outputs.join(params, on=on, how="left")


# Memo and scatter -------------------------------------------------------------------------------

def unseen(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates whose combination was never scored. The history shrinks to its keys before the join."""
    return candidates.join(history.select("trial_key").distinct(), "trial_key", "left_anti")


def remembered(candidates: DataFrame, history: DataFrame, order: str = "generation") -> DataFrame:
    """Candidates scored before, with the result of the earliest generation that has it."""
    first = history.groupBy("trial_key").agg(F.min_by("metric", order).alias("metric"))
    return candidates.join(first, "trial_key", "inner")


def scatter(population: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores of unique combinations for all individuals that have them."""
    return population.join(scores.select("trial_key", "metric"), "trial_key", "left")
