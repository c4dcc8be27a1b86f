import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from millrace.plans import registry as R
from millrace.plans import scoring


def test_registry(spark, folder):
    models = R.ModelRegistry(spark, folder)
    with pytest.raises(R.ModelNotFound):
        models.get_model("mnist", 1)
    assert models.export("/models/mnist", "mnist") == 1
    assert models.export("/models/mnist", "mnist", metrics={"accuracy": 21.5, "loss": "31.3"}) == 2
    assert models.export("/models/mnist", "mnist", metrics={"accuracy": 0.5}) == 3
    assert models.export("/models/mnist", "mnist_abs", 4, metrics={"accuracy": 99}) == 4
    assert models.export("/models/mnist", "mnist", 5, metrics={"accuracy": 30}, experiment_id="app_1") == 5
    assert models.get_best_model("mnist", "accuracy", "MAX").version == 5
    assert models.get_best_model("mnist", "accuracy", "MIN").version == 3
    assert models.get_model("mnist", 2).metrics == {"accuracy": 21.5, "loss": 31.3}
    assert models.get_model("mnist", 1).description == "A collection of models for mnist"
    for name, metric in (("mnist", "unknown"), ("unknown", "accuracy")):
        with pytest.raises(R.ModelNotFound):
            models.get_best_model(name, metric, "MAX")
    with pytest.raises(ValueError):
        models.get_best_model("mnist", "accuracy", "UP")
    with pytest.raises(ValueError, match="exists"):
        models.export("/models/other", "mnist", 5)
    models.export("/models/other", "mnist", 5, overwrite=True)
    assert models.get_model("mnist", 5).path == "/models/other" and models.models().count() == 5
    for bad in ({"accuracy": "not number"}, {1337: "0.5"}):
        with pytest.raises(AssertionError):
            models.export("/models/mnist", "mnist", metrics=bad)
    plan = plan_of(models.models().filter("name = 'mnist' AND version = 2"))
    assert "PartitionFilters: [isnotnull(name" in plan


def test_next_versions(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "12"), ("a", "draft"), ("b", "x")], "name string, version string")
    assert {tuple(r) for r in R.next_versions(df).collect()} == {("a", 12, 13), ("b", 0, 1)}


def test_scoring(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), "id")
    scored = scoring.score(df, lambda: 3.0, lambda m, d: d["x"] * m, ["x"], "prediction double")
    assert all(r.prediction == 3.0 * r.id for r in scored.collect()) and scored.columns == ["x", "id", "prediction"]
    chained = scoring.chain(
        df, lambda: 1.0, ["x"], "low double, high double", predict=lambda m, d: d["x"] + m,
        preprocess=lambda d: d * 2, postprocess=lambda y: pd.DataFrame({"low": y - 1, "high": y + 1}),
    )
    assert all((r.low, r.high) == (2 * r.id, 2 * r.id + 2) for r in chained.collect())


def test_requests(spark):
    predict = lambda m, d: d["features"].map(sum)
    for payload in ('{"inputs": [[1, 2, 3, 4]]}', {"signature_name": "s", "instances": [[1, 2, 3, 4]]}):
        assert scoring.score_request(spark, payload, lambda: None, predict).first().prediction == 10
    with pytest.raises(ValueError):
        scoring.score_request(spark, {"inputs": []}, lambda: None, predict, ":run")
    with pytest.raises(ValueError):
        scoring.request_rows({"rows": []})


def test_exports_at_the_same_time_get_different_versions(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda i: R.ModelRegistry(spark, f"{folder}/models").export("p", "m", metrics={"a": i}), range(4)))
    assert sorted(found) == [1, 2, 3, 4]
    registry = R.ModelRegistry(spark, f"{folder}/models")
    assert registry.models().count() == 4 and registry.export("p", "m") == 5
    with pytest.raises(ValueError, match="exists"):
        registry.export("p", "m", version=3)
    assert registry.export("q", "m", version=3, overwrite=True) == 3
    assert registry.get_model("m", 3).path == "q"
