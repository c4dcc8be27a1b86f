"""Batch scoring: a model, loaded once per task, applied to the rows of a frame."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, types as T

# --- fixed values -------------------------------------------------------------------------------
VERBS = (":predict", ":classify", ":regress")
# ------------------------------------------------------------------------------------------------


def _extended(df: DataFrame, outputs: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(outputs).fields])


def score(df: DataFrame, load: Callable[[], object], predict: Callable, inputs: Sequence[str], outputs: str) -> DataFrame:
    """Append predictions to the rows.

    ``load()`` runs once per task. ``predict(model, inputs)`` gets a pandas frame of the input
    columns for each Arrow batch and returns one column or a frame with the ``outputs`` columns
    (DDL text, such as ``"prediction double"``).
    """
    return chain(df, load, inputs, outputs, predict=predict)


def chain(
    df: DataFrame,
    load: Callable[[], object],
    inputs: Sequence[str],
    outputs: str,
    predict: Callable,
    preprocess: Callable | None = None,
    postprocess: Callable | None = None,
) -> DataFrame:
    """Transformer and predictor in one pass: preprocess -> predict -> postprocess per batch."""
    schema = _extended(df, outputs)
    names = [f.name for f in T.StructType.fromDDL(outputs)]

    def run(batches):
        model = load()
        for batch in batches:
            data = batch[list(inputs)]
            if preprocess is not None:
                data = preprocess(data)
            predicted = predict(model, data)
            if postprocess is not None:
                predicted = postprocess(predicted)
            if len(names) == 1 and not hasattr(predicted, "columns"):
                yield batch.assign(**{names[0]: predicted})
            else:
                yield batch.assign(**{n: predicted[n].to_numpy() for n in names})

    return df.mapInPandas(run, schema)


def request_rows(payload: str | Mapping) -> list[list[float]]:
    """Rows of a scoring request: ``{"inputs": rows}`` or ``{"instances": rows, ...}``."""
    body = json.loads(payload) if isinstance(payload, str) else payload
    for key in ("inputs", "instances"):
        if key in body:
            return body[key]
    raise ValueError("a request holds inputs or instances")


def score_request(spark, payload: str | Mapping, load: Callable[[], object], predict: Callable, verb: str = ":predict"):
    """Score one request as a frame of ``features array<double>`` rows."""
    if verb not in VERBS:
        raise ValueError(f"verb must be one of {VERBS}, not {verb!r}")
    rows = [([float(v) for v in row],) for row in request_rows(payload)]
    df = spark.createDataFrame(rows, "features array<double>")
    return score(df, load, predict, ["features"], "prediction double")
