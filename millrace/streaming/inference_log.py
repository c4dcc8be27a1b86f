"""Inference events on a stream: subscribe, decode, filter, log and drain.

A topic is any streaming frame with ``key, value, topic, timestamp``: Kafka when its package is
there, else files that appear in a folder. Every step is stateless, so one micro-batch is one
narrow job and the checkpoint holds only source offsets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from millrace.plans.scoring import score
from millrace.session import shared_dir
from millrace.sources.connectors import require_format

# --- fixed values -------------------------------------------------------------------------------
MODEL_INPUTS, PREDICTIONS, ALL = "MODEL_INPUTS", "PREDICTIONS", "ALL"
LOGGING_MODES = (MODEL_INPUTS, PREDICTIONS, ALL)
MODEL_SERVERS = ("TENSORFLOW_SERVING", "PYTHON")
SERVING_TOOLS = ("DEFAULT", "KSERVE")
EVENT_SCHEMA = (
    "modelName string, modelVersion long, requestTimestamp long, modelServer string, servingTool string, "
    "inferenceRequest string, inferenceResponse string"
)
# ------------------------------------------------------------------------------------------------


def file_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """Files of a folder as a stream, oldest first."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def subscribe(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A Kafka topic from its earliest record."""
    from millrace.sources.connectors import kafka_options, read_kafka

    return read_kafka(spark, kafka_options(servers, topic, **options))


def logged(events: DataFrame, mode: str | None) -> DataFrame:
    """Events as a logging mode keeps them: inputs, predictions or both; no mode logs nothing."""
    if mode is None:
        return events.filter(F.lit(False))
    if mode not in LOGGING_MODES:
        raise ValueError(f"mode must be one of {LOGGING_MODES}, not {mode!r}")
    missing = F.lit(None).cast("string")
    if mode == MODEL_INPUTS:
        return events.withColumn("inferenceResponse", missing)
    return events.withColumn("inferenceRequest", missing) if mode == PREDICTIONS else events


def to_topic(events: DataFrame, topic: str, avro_schema: str | None = None) -> DataFrame:
    """Events as topic records; the model name is the key and the event, as JSON text, the value.

    With an Avro schema the value is Avro, which needs Spark's package for it.
    """
    event = F.struct(*[F.col(f"`{c}`") for c in events.columns])
    if avro_schema is None:
        value = F.to_json(event).cast("binary")
    else:
        require_format(events.sparkSession, "avro")
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(event, avro_schema)
    return events.select(
        F.col("modelName").cast("binary").alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
        F.current_timestamp().alias("timestamp"),
    )


def from_topic(records: DataFrame, schema: str = EVENT_SCHEMA, avro_schema: str | None = None) -> DataFrame:
    """Events out of topic records; records without a value are skipped, and a broken value fails the job."""
    if avro_schema is None:
        event = F.from_json(F.col("value").cast("string"), schema, {"mode": "FAILFAST"})
    else:
        require_format(records.sparkSession, "avro")
        from pyspark.sql.avro.functions import from_avro

        event = from_avro("value", avro_schema)
    return records.filter("value IS NOT NULL").select(event.alias("event")).select("event.*")


def select_events(events: DataFrame, model_name: str | None = None, model_server: str | None = None,
                  serving_tool: str | None = None) -> DataFrame:
    wanted = {"modelName": model_name, "modelServer": model_server, "servingTool": serving_tool}
    for column, value in wanted.items():
        if value is not None:
            events = events.filter(F.col(column) == value)
    return events


def score_stream(
    requests: DataFrame, load: Callable[[], object], predict: Callable, inputs: Sequence[str], model_name: str,
    model_version: int, timestamp_ms, model_server: str = "PYTHON", serving_tool: str = "DEFAULT",
) -> DataFrame:
    """Score request rows and give the inference events to log."""
    scored = score(requests, load, predict, inputs, "prediction double")
    return scored.select(
        F.lit(model_name).alias("modelName"),
        F.lit(model_version).cast("long").alias("modelVersion"),
        timestamp_ms.cast("long").alias("requestTimestamp"),
        F.lit(model_server).alias("modelServer"),
        F.lit(serving_tool).alias("servingTool"),
        F.to_json(F.struct(F.array(F.array(*[F.col(c).cast("double") for c in inputs])).alias("inputs"))).alias(
            "inferenceRequest"
        ),
        F.to_json(F.struct(F.array("prediction").alias("predictions"))).alias("inferenceResponse"),
    )


def drain(stream: DataFrame, path: str | None = None, checkpoint: str | None = None, timeout: int | None = None) -> DataFrame:
    """Process what the source holds now, exactly once, and return the written rows.

    The same ``path`` and ``checkpoint`` continue where the last call stopped.
    """
    spark = stream.sparkSession
    target = path or shared_dir(spark, f"drain-{uuid.uuid4().hex}")
    query = stream.writeStream.format("parquet").option("path", target).option(
        "checkpointLocation", checkpoint or f"{target}-checkpoint"
    ).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout) and timeout is not None:
        query.stop()
        raise TimeoutError(f"the stream was not drained in {timeout} seconds")
    return spark.read.schema(stream.schema).parquet(target)
