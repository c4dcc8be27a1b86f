"""Run folders of other tools: trees of small JSON files, read and written by tasks.

A trial has a folder with its outputs, its metric and maybe its parameters; folders of a search by
generations lie one level deeper. The driver lists only the runs; tasks walk the folders of their
runs and read the files, so a tree of any size is one narrow job.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.trials import MAX, check_direction
from millrace.session import qualified
from millrace.sources.file_writer import file_system

# --- fixed values of the tree -------------------------------------------------------------------
OUTPUTS_FILE = ".outputs.json"
PARAMETERS_FILE = ".hparams.json"
METRIC_FILE = ".metric"
GENERATION_PREFIX = "generation."
# ------------------------------------------------------------------------------------------------

TREE_SCHEMA = (
    "run_id string, generation int, trial string, params map<string,string>, outputs map<string,string>, metric double"
)


def _texts(text: str | None) -> dict[str, str | None] | None:
    """A JSON object with its values as text; anything else is none."""
    if text is None:
        return None
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if not isinstance(found, dict):
        return None
    return {k: v if v is None or isinstance(v, str) else json.dumps(v) for k, v in found.items()}


def _number(text: str | None) -> float | None:
    try:
        return None if text is None else float(text)
    except ValueError:
        return None


def read_run_tree(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, generation, trial, params, outputs, metric), a row for each trial folder below ``root``.

    A run is a folder of the root, a trial the path of its folder below the run and its generation.
    ``generation`` is null outside generations; it is a number, so that 10 follows 9. A missing or
    broken file leaves its column null, and no trial takes another's parameters.
    """
    from pyarrow import fs

    base = qualified(spark, root)
    system, plain = file_system(base)
    runs = sorted(i.base_name for i in system.get_file_info(fs.FileSelector(plain)) if i.type == fs.FileType.Directory)
    if not runs:
        return spark.createDataFrame([], TREE_SCHEMA)
    tasks = min(len(runs), max(1, spark.sparkContext.defaultParallelism * 4))
    listed = spark.createDataFrame([(i, run) for i, run in enumerate(runs)], "n int, run string")
    listed = listed.repartitionById(tasks, F.pmod("n", F.lit(tasks))).select("run")

    def read(batches):
        import pyarrow as pa

        system, plain = file_system(base)

        def content(path):
            if system.get_file_info(path).type != fs.FileType.File:
                return None
            with system.open_input_stream(path) as stream:
                return stream.read().decode("utf-8", "replace")

        texts = pa.map_(pa.string(), pa.string())
        target = pa.schema([
            ("run_id", pa.string()), ("generation", pa.int32()), ("trial", pa.string()), ("params", texts),
            ("outputs", texts), ("metric", pa.float64()),
        ])
        for batch in batches:
            for run in batch.column(0).to_pylist():
                rows = []
                for info in system.get_file_info(fs.FileSelector(f"{plain}/{run}", recursive=True)):
                    if info.base_name != OUTPUTS_FILE:
                        continue
                    folder = info.path.rpartition("/")[0]
                    parts = folder[len(f"{plain}/{run}"):].strip("/").split("/")
                    generation = None
                    if parts[0].startswith(GENERATION_PREFIX) and parts[0][len(GENERATION_PREFIX):].isdigit():
                        generation = int(parts.pop(0)[len(GENERATION_PREFIX):])
                    params, outputs = (_texts(content(f"{folder}/{name}")) for name in (PARAMETERS_FILE, OUTPUTS_FILE))
                    rows.append({
                        "run_id": run, "generation": generation, "trial": "/".join(parts),
                        "params": None if params is None else list(params.items()),
                        "outputs": None if outputs is None else list(outputs.items()),
                        "metric": _number(content(f"{folder}/{METRIC_FILE}")),
                    })
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=target)

    return listed.mapInArrow(read, TREE_SCHEMA)


def write_run_tree(trials: DataFrame, root: str) -> int:
    """Write rows of :data:`TREE_SCHEMA` as such a tree; a folder's files are replaced. Returns the number of trials."""
    base = qualified(trials.sparkSession, root)

    def write(batches):
        import pyarrow as pa

        system, plain = file_system(base)

        def put(path, text):
            with system.open_output_stream(path) as stream:
                stream.write(text.encode())

        for batch in batches:
            for row in batch.to_pylist():
                inner = [] if row["generation"] is None else [f"{GENERATION_PREFIX}{row['generation']}"]
                folder = "/".join([plain, row["run_id"], *inner, *([row["trial"]] if row["trial"] else [])])
                system.create_dir(folder, recursive=True)
                for name, values in ((PARAMETERS_FILE, row["params"]), (OUTPUTS_FILE, row["outputs"])):
                    if values is not None:
                        put(f"{folder}/{name}", json.dumps(dict(values)))
                if row["metric"] is not None:
                    put(f"{folder}/{METRIC_FILE}", str(row["metric"]))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    names = [part.split()[0] for part in TREE_SCHEMA.split(", ")]
    return trials.select(*names).mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def best_of_runs(trials: DataFrame, direction: str = MAX) -> DataFrame:
    """One row per run: its trials and generations, and the best metric with its place and parameters.

    Of equal metrics the earliest generation counts, and then the first trial by name.
    """
    sign = -1 if check_direction(direction) == MAX else 1
    place = F.struct((F.col("metric") * sign).alias("m"), F.coalesce("generation", F.lit(-1)).alias("g"), "trial")
    valid = F.col("metric").isNotNull() & ~F.isnan("metric")
    best = F.min_by(F.struct("metric", "generation", "trial", "params"), F.when(valid, place))
    return trials.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("trials"), F.count_distinct("generation").alias("generations"), best.alias("best")
    ).select(
        "run_id", "trials", "generations", F.col("best.metric").alias("best_metric"),
        F.col("best.generation").alias("best_generation"), F.col("best.trial").alias("best_trial"),
        F.col("best.params").alias("best_params"),
    )
