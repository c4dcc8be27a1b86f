"""Inference events on streams. The event table is the stream; every query drains all of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.queries.common import table
from millrace.streaming import inference_log as L


def _requests(spark, sf_dir):
    """The event table, one file or a folder of them, as a stream of requests."""
    schema = table(spark, sf_dir, "events").schema
    # A glob, because a stream takes a single file only as a match.
    stream = L.file_stream(spark, f"{sf_dir}/{{events.parquet}}", schema)
    in_utc = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    return stream.withColumn("ms", F.unix_millis(in_utc))


def _events(spark, sf_dir):
    """Events named after user and event type, with the properties as the response."""
    return _requests(spark, sf_dir).select(
        F.concat(F.lit("m"), (F.col("user_id") % 7).cast("string")).alias("modelName"),
        F.col("event_id").alias("modelVersion"),
        F.col("ms").alias("requestTimestamp"),
        F.when(F.col("event_type") == "click", L.MODEL_SERVERS[0]).otherwise(L.MODEL_SERVERS[1]).alias("modelServer"),
        F.when(F.col("event_type") == "error", L.SERVING_TOOLS[1]).otherwise(L.SERVING_TOOLS[0]).alias("servingTool"),
        F.col("event_type").alias("inferenceRequest"),
        F.col("props").alias("inferenceResponse"),
    )


def infer_log_decode(spark, sf_dir):
    """All events to topic records and back, on the stream."""
    return L.drain(L.from_topic(L.to_topic(_events(spark, sf_dir), "inference")))


def infer_log_filter(spark, sf_dir):
    events = L.from_topic(L.to_topic(_events(spark, sf_dir), "inference"))
    wanted = L.select_events(events, "m3", "PYTHON", "DEFAULT")
    return L.drain(wanted.select("modelName", "modelVersion", "requestTimestamp", "inferenceResponse"))


def infer_log_modes(spark, sf_dir):
    """Rows with request and response by logging mode; without a mode nothing is logged."""
    frames = []
    for mode in (*L.LOGGING_MODES, None):
        kept = L.drain(L.logged(_events(spark, sf_dir), mode).select("inferenceRequest", "inferenceResponse"))
        frames.append(kept.agg(
            F.lit(mode or "none").alias("mode"), F.count(F.lit(1)).alias("n_rows"),
            F.count("inferenceRequest").alias("requests"), F.count("inferenceResponse").alias("responses"),
        ))
    first, *others = frames
    for frame in others:
        first = first.unionByName(frame)
    return first


def infer_log_stream(spark, sf_dir):
    """Score every request on the stream, log it to the topic, read the predictions back."""
    events = L.score_stream(
        _requests(spark, sf_dir).select("event_id", "value", "ms"), lambda: 2.0, lambda m, x: x["value"] * m,
        ["value"], "doubler", 1, F.col("ms"),
    )
    topic = L.drain(L.to_topic(events, "doubler"))
    logged = L.select_events(L.from_topic(topic), "doubler")
    return logged.select(
        "requestTimestamp",
        F.round(F.get_json_object("inferenceRequest", "$.inputs[0][0]").cast("double"), 4).alias("input"),
        F.round(F.get_json_object("inferenceResponse", "$.predictions[0]").cast("double"), 4).alias("prediction"),
    )


QUERIES = {
    "infer_log_decode": infer_log_decode,
    "infer_log_filter": infer_log_filter,
    "infer_log_modes": infer_log_modes,
    "infer_log_stream": infer_log_stream,
}

_EVENTS = (
    "(SELECT 'm' || (user_id % 7) AS \"modelName\", CAST(event_id AS BIGINT) AS \"modelVersion\", "
    "epoch_us(ts) // 1000 AS \"requestTimestamp\", "
    "CASE WHEN event_type = 'click' THEN 'TENSORFLOW_SERVING' ELSE 'PYTHON' END AS \"modelServer\", "
    "CASE WHEN event_type = 'error' THEN 'KSERVE' ELSE 'DEFAULT' END AS \"servingTool\", "
    "event_type AS \"inferenceRequest\", props AS \"inferenceResponse\" FROM events)"
)

SQL = {
    "infer_log_decode": f"SELECT * FROM {_EVENTS} e",
    "infer_log_filter": (
        f'SELECT "modelName", "modelVersion", "requestTimestamp", "inferenceResponse" FROM {_EVENTS} e '
        "WHERE \"modelName\" = 'm3' AND \"modelServer\" = 'PYTHON' AND \"servingTool\" = 'DEFAULT'"
    ),
    "infer_log_modes": (
        "SELECT 'MODEL_INPUTS' AS mode, count(*) AS n_rows, count(event_type) AS requests, 0::BIGINT AS responses FROM events "
        "UNION ALL SELECT 'PREDICTIONS', count(*), 0, count(props) FROM events "
        "UNION ALL SELECT 'ALL', count(*), count(event_type), count(props) FROM events "
        "UNION ALL SELECT 'none', 0, 0, 0"
    ),
    "infer_log_stream": (
        "SELECT epoch_us(ts) // 1000 AS \"requestTimestamp\", round(value, 4) AS input, "
        "round(value * 2, 4) AS prediction FROM events"
    ),
}
