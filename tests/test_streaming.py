"""Inference events on file streams."""

import pytest
from pyspark.sql import functions as F

from millrace.session import fresh_dir
from millrace.streaming import inference_log as L


@pytest.fixture
def requests(spark, folder):
    spark.range(0, 60, 1, 6).select("id", (F.col("id") * 1.5).alias("x")).write.parquet(folder)
    return folder


def stream_of(spark, path, **options):
    return L.file_stream(spark, path, spark.read.parquet(path).schema, **options)


def test_score_log_and_read_back(spark, requests):
    def events(name, tool):
        return L.score_stream(stream_of(spark, requests), lambda: 2.0, lambda m, d: d["x"] * m, ["x"], name, 3,
                              F.col("id") * 1000, serving_tool=tool)

    topic = L.drain(L.to_topic(events("irisA", "KSERVE"), "inference"))
    assert topic.columns == ["key", "value", "topic", "timestamp"] and topic.count() == 60
    rows = L.select_events(L.from_topic(topic), "irisA", "PYTHON", "KSERVE").collect()
    assert len(rows) == 60
    row = next(r for r in rows if r.requestTimestamp == 10000)
    assert row.inferenceRequest == '{"inputs":[[15.0]]}' and row.inferenceResponse == '{"predictions":[30.0]}'
    assert L.select_events(L.from_topic(topic), "irisA", "TENSORFLOW_SERVING").count() == 0


def test_drain_continues_where_it_stopped(spark, requests):
    target = fresh_dir(spark, "drained")
    assert L.drain(stream_of(spark, requests, max_files=2), target).count() == 60
    spark.range(60, 70).select("id", (F.col("id") * 1.5).alias("x")).write.mode("append").parquet(requests)
    again = L.drain(stream_of(spark, requests), target)
    assert again.count() == 70 and again.select("id").distinct().count() == 70


def test_logging_modes(spark):
    df = spark.sql("SELECT 'q' AS inferenceRequest, 'a' AS inferenceResponse")
    assert tuple(L.logged(df, "MODEL_INPUTS").first()) == ("q", None)
    assert tuple(L.logged(df, "PREDICTIONS").first()) == (None, "a")
    assert tuple(L.logged(df, "ALL").first()) == ("q", "a")
    assert L.logged(df, None).count() == 0
    with pytest.raises(ValueError):
        L.logged(df, "SOME")


def test_kafka_is_gated(spark):
    with pytest.raises(RuntimeError, match="class path"):
        L.subscribe(spark, "a:1", "t")
