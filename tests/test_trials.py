"""Trial frames, evaluation, picks, evolution and experiments."""

import itertools
import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import plan_of
from millrace.operators import evolution as E
from millrace.operators import trials as T
from millrace.plans.experiments import Experiments


# Functions of this module travel with the job; tasks cannot import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def experiments(spark, folder):
    return Experiments(spark, folder)


def total(a, b):
    return a + b


def test_grid_is_the_product_in_order(spark):
    params = {"a": [1, 2, 3], "b": ["x", "y"], "c": [0.5, 1.5]}
    df = T.grid(spark, params)
    assert [tuple(r)[1:] for r in df.orderBy("trial_id").collect()] == list(itertools.product(*params.values()))
    plan = plan_of(df)
    assert "Join" not in plan and "Product" not in plan and "Exchange" not in plan
    assert T.grid(spark, {"a": [1, 1, 2]}).count() == 2
    for bad in ({}, {"a": []}, {"a": [1, "x"]}):
        with pytest.raises(ValueError):
            T.grid(spark, bad)


def test_zip(spark):
    df = T.zipped(spark, {"a": [-5, 4.9], "b": [-8, 10.3]})
    assert [tuple(r) for r in df.orderBy("trial_id").collect()] == [(0, -5.0, -8.0), (1, 4.9, 10.3)]
    assert T.zipped(spark).count() == 1
    with pytest.raises(ValueError, match="length"):
        T.zipped(spark, {"a": [1], "b": [1, 2]})


def test_random_samples(spark):
    df = T.random_samples(spark, {"a": [-1, 1], "b": [-1, 1]}, samples=100)
    rows = [tuple(r)[1:] for r in df.collect()]
    assert len(rows) == len(set(rows)) == 9
    assert sorted(T.random_samples(spark, {"a": [0.0, 1.0]}, 50, seed=3).collect()) == sorted(
        T.random_samples(spark, {"a": [0.0, 1.0]}, 50, seed=3).collect())
    for bad in ({"a": [1]}, {"a": [1, 2, 3]}, {"a": ["x", "y"]}):
        with pytest.raises(ValueError):
            T.random_samples(spark, bad)


def test_first_trial_of_a_hot_combination(spark):
    df = spark.range(3000).select(
        (2999 - F.col("id")).alias("trial_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"),
        F.lit("x").alias("note"),
    )
    rows = {r.a: r.trial_id for r in T.drop_repeated(df, ["a"]).collect()}
    wanted = {}
    for i in range(3000):
        a, t = (0 if i % 3 == 0 else i), 2999 - i
        wanted[a] = min(wanted.get(a, t), t)
    assert rows == wanted


def test_each_trial_has_its_own_task(spark):
    trials = T.grid(spark, {"a": list(range(6))})

    def where(a):
        from pyspark import TaskContext

        return TaskContext.get().partitionId()

    rows = T.evaluate(trials, where, optimise=True, parallelism=6).collect()
    assert sorted(r.metric for r in rows) == [0, 1, 2, 3, 4, 5]


def test_missing_argument(spark):
    with pytest.raises(KeyError):
        T.evaluate(T.grid(spark, {"a": [1]}), total)


def test_outputs_are_normalised():
    assert T.normalise(10, "metric", True) == ({"metric": "10"}, 10.0)
    assert T.normalise({"value": -10.3}, "value", True) == ({"value": "-10.3"}, -10.3)
    assert T.normalise({"v": np.float32(0.5), "a": np.arange(2)}, "v", True) == ({"v": "0.5", "a": "[0, 1]"}, 0.5)
    assert T.normalise("7", "metric", True)[1] == 7.0
    assert T.normalise(None, None, False) == ({"metric": None}, None)
    for returned, key in (({}, "v"), ({"a": 1, "b": 2}, None), ({"a": 1}, "v"), ({"a": "text"}, "a"), (None, "metric")):
        with pytest.raises(ValueError):
            T.normalise(returned, key, True)
    with pytest.raises(TypeError):
        T.normalise({"a": object()}, None, False)


def test_scores_over_data_match_brute_force(spark):
    data = spark.range(1000).select((F.col("id") % 17).alias("x"))
    trials = T.grid(spark, {"low": list(range(8)), "high": list(range(7, 12))})
    scored = T.score_over(data, trials, lambda p: F.count_if((F.col("x") >= p["low"]) & (F.col("x") < p["high"])))
    rows = scored.collect()
    assert len(rows) == 40  # two scans
    values = [i % 17 for i in range(1000)]
    for r in rows:
        low, high = int(r.params["low"]), int(r.params["high"])
        assert r.metric == sum(low <= v < high for v in values)


def test_picks(spark):
    df = spark.createDataFrame(
        [(3, "c", 5.0), (1, "a", 5.0), (2, "b", 1.0), (4, "d", float("nan")), (5, "e", None)],
        "trial_id long, trial_key string, metric double",
    )
    best = T.best_trial(df, "max")
    assert best.first().trial_id == 1 and "TakeOrderedAndProject" in plan_of(best)
    assert T.best_trial(df, "MIN").first().trial_id == 2
    summary = T.metric_summary(df).first()
    assert (summary.trials, summary.max_metric, summary.min_metric) == (3, 5.0, 1.0)
    assert summary.avg_metric == pytest.approx(11 / 3)
    grouped = T.best_per_group(df.withColumn("g", F.lit(1)), "g", "MAX").first()
    assert grouped.best_trial_id == 1 and grouped.best_metric == 5.0
    with pytest.raises(ValueError):
        T.best_trial(df, "UP")


def test_negative_metrics_have_a_best(spark):
    df = spark.createDataFrame([(1, "a", -5.0), (2, "b", -1.0)], "trial_id long, trial_key string, metric double")
    assert T.best_trial(df, "MAX").first().trial_id == 2


def test_memo(spark):
    history = spark.createDataFrame([("a", 3.0, 2), ("a", 1.0, 1), ("b", 7.0, 1)], "trial_key string, metric double, generation int")
    candidates = spark.createDataFrame([("a",), ("c",), ("a",)], "trial_key string")
    assert [r.trial_key for r in T.unseen(candidates, history).collect()] == ["c"]
    assert [tuple(r) for r in T.remembered(candidates, history).collect()] == [("a", 1.0), ("a", 1.0)]
    assert {tuple(r) for r in T.scatter(candidates, history.filter("metric > 2")).collect()} == {("a", 3.0), ("c", None)}


# Evolution --------------------------------------------------------------------------------------

def test_donors_are_distinct_and_uniform(spark):
    df = spark.range(5).withColumnRenamed("id", "individual")
    seen = set()
    for generation in range(40):
        for r in E.donor_indices(df, 5, 1, generation).collect():
            assert len({*r.picks, r.individual}) == 4 and all(0 <= p < 5 for p in r.picks)
            seen.add((r.individual, tuple(r.picks)))
    assert len(seen) > 90  # of 120 ordered choices


def test_population_stays_in_bounds(spark):
    genes = E.genes_of({"i": [1, 9], "f": [0.5, 2.5], "c": ["x", "y"]})
    start = E.initial_population(spark, genes, 20, 3)
    mixed = E.trial_population(start, genes, 20, 2.0, 1.0, 3, 1)
    for column in ("genes", "trial_genes"):
        for r in E.as_trials(mixed, genes, column).collect():
            assert 1 <= r.i <= 9 and 0.5 <= r.f <= 2.5 and r.c in ("x", "y")


def test_crossover_rate_zero_keeps_targets(spark):
    genes = E.genes_of({"f": [0.0, 1.0], "g": [0.0, 1.0]})
    start = E.initial_population(spark, genes, 6, 3)
    rows = E.trial_population(start, genes, 6, 0.5, 0.0, 3, 1).collect()
    # A draw of exactly zero would still cross over; none occurs with this seed.
    assert all(r.genes == r.trial_genes for r in rows)


def test_selection_is_strict(spark):
    df = spark.createDataFrame(
        [(0, [1.0], 5.0, [2.0], 5.0), (1, [1.0], 5.0, [2.0], 6.0)],
        "individual long, genes array<double>, score double, trial_genes array<double>, trial_score double",
    )
    rows = {r.individual: r.genes for r in E.select_better(df, "MAX").collect()}
    assert rows == {0: [1.0], 1: [2.0]}


def test_evolution_never_worsens_and_scores_once(spark, folder):
    def evaluator(trials):
        return T.evaluate(trials, lambda a, b: -(a - 3) ** 2 - (b - 0.5) ** 2, parallelism=4)

    found = E.evolve(spark, evaluator, {"a": [0, 9], "b": [0.0, 1.0]}, folder, "MAX", 3, 5, seed=4)
    summary = E.generation_summary(found.populations).collect()
    assert [r.generation for r in summary] == [0, 1, 2, 3]
    best = [r.best_metric for r in summary]
    assert best == sorted(best)
    keys = [r.trial_key for r in found.history.collect()]
    assert len(keys) == len(set(keys)) <= 20
    assert all(r.n == 5 for r in found.populations.groupBy("generation").agg(F.count("*").alias("n")).collect())
    with pytest.raises(ValueError):
        E.evolve(spark, evaluator, {"a": [0, 9]}, folder, population=3)
    with pytest.raises(ValueError):
        E.evolve(spark, evaluator, {"a": [0, 9]}, folder, generations=1)
    with pytest.raises(ValueError):
        E.genes_of({"a": [1]})


# Experiments ------------------------------------------------------------------------------------

def test_launch(experiments):
    path, outputs = experiments.launch(lambda: {"value": 10, "more": 0.5, "logfile": "testfile.txt"})
    assert outputs == {"value": 10, "more": 0.5, "logfile": "testfile.txt"} and path
    assert experiments.launch(lambda: None)[1] == {"metric": None}
    assert experiments.launch(total, {"a": [-5], "b": [-8]})[1] == {"metric": -13}
    path, outputs = experiments.launch(total, {"a": [-5, 4.9], "b": [-8, 10.3]})
    assert outputs is None
    run_id = path.rsplit("run_id=", 1)[1]
    summary = [(json.loads(r.parameters), json.loads(r.outputs)) for r in experiments.summary(run_id).orderBy("trial_id").collect()]
    assert summary == [({"a": "-5.0", "b": "-8.0"}, {"metric": "-13.0"}), ({"a": "4.9", "b": "10.3"}, {"metric": "15.200000000000001"})]
    with pytest.raises(ValueError):
        experiments.launch(total, {"a": [1], "b": [1, 2]})
    with pytest.raises(AssertionError):
        experiments.launch(lambda: {"a": 1}, metric_key="b")


def test_searches(experiments):
    grid = {"a": [-1, 1.5], "b": [-1.5, 1]}
    assert experiments.grid_search(total, grid, "MIN")[1] == {"a": -1, "b": -1.5}
    assert experiments.grid_search(total, grid, "MAX")[1] == {"a": 1.5, "b": 1}
    _, params, outputs = experiments.grid_search(
        lambda a, b: {"value": a + b, "more": b}, grid, "MAX", optimization_key="value")
    assert params == {"a": 1.5, "b": 1} and outputs == {"value": 2.5, "more": 1.0}
    bounds = {"a": [-1, 1], "b": [-1, 1]}
    assert experiments.random_search(total, bounds, samples=100, direction="MIN")[1] == {"a": -1, "b": -1}
    assert experiments.random_search(total, bounds, samples=100, direction="max")[1] == {"a": 1, "b": 1}
    with pytest.raises(ValueError):
        experiments.grid_search(total, grid, "UP")


def test_differential_evolution(experiments):
    bounds = {"a": [4, 5], "b": [1, 2]}
    assert experiments.differential_evolution(total, bounds, "MAX", generations=2, seed=5)[1] == {"a": 5, "b": 2}
    _, params, outputs = experiments.differential_evolution(
        lambda a, b: {"cost": a * 10 + (b == "slow")}, {"a": [4, 5], "b": ["slow", "fast"]}, "min", generations=2,
        optimization_key="cost", seed=5)
    assert params == {"a": 4, "b": "fast"} and outputs == {"cost": 40}


def test_lifecycle(experiments):
    def fails(a):
        raise RuntimeError("no luck")

    def nested(a):
        return a

    with pytest.raises(Exception, match="no luck"):
        experiments.grid_search(fails, {"a": [1]})
    experiments.grid_search(nested, {"a": [1, 2]}, name="named", description="text")
    rows = experiments.statuses().orderBy("seq").collect()
    assert [(r.state, r.name, r.metric) for r in rows] == [("FAILED", "grid_search", None), ("FINISHED", "named", 2.0)]
    assert [r.run_id.rsplit("_", 1)[1] for r in rows] == ["1", "2"]
    assert rows[1].duration.startswith("0 hours") and rows[1].duration_ms > 0
    again = Experiments(experiments.spark, experiments.root)
    assert again.launch(lambda: 1)[0].endswith("_3")
    experiments._active = "x_1"
    with pytest.raises(RuntimeError, match="only one"):
        experiments.launch(lambda: 1)


def test_nan_never_wins(spark):
    from millrace.operators.evolution import select_better

    nan = float("nan")
    rows = [(0, [0.0], 5.0, [1.0], nan), (1, [0.0], nan, [1.0], 3.0), (2, [0.0], 5.0, [1.0], None), (3, [0.0], 1.0, [1.0], 2.0)]
    df = spark.createDataFrame(rows, "individual int, genes array<double>, score double, trial_genes array<double>, trial_score double")
    assert [r.score for r in select_better(df, "max").orderBy("individual").collect()] == [5.0, 3.0, 5.0, 2.0]


def test_many_trials_in_waves(spark, monkeypatch):
    monkeypatch.setattr(T, "_TRIALS_PER_SCAN", 4)
    monkeypatch.setattr(T, "_TRIALS_PER_PAGE", 10)
    data = spark.range(100).select(F.col("id").cast("double").alias("x"))
    for n in (0, 9, 10, 37):
        trials = spark.range(n).select((F.col("id") * 3).alias("trial_id"), F.col("id").alias("low"))
        scored = T.score_over(data, trials, lambda p: F.count_if(F.col("x") >= p["low"]))
        assert {r.trial_id: r.metric for r in scored.collect()} == {3 * i: 100 - i for i in range(n)}
        # However many trials, a plan has the scans of one page at most.
        assert scored._jdf.queryExecution().toString().count("Relation [") + 1 < 40


def test_returned_files_are_published_once(spark, folder):
    import os

    os.makedirs(f"{folder}/local")

    def train(a):
        print("trial", a)
        with open(f"{folder}/local/{a}.txt", "w") as file:
            file.write(str(a))
        os.makedirs(f"{folder}/local/d{a}")
        with open(f"{folder}/local/d{a}/inner", "w") as file:
            file.write("x")
        return {"metric": a, "plot": f"{folder}/local/{a}.txt", "model": f"{folder}/local/d{a}", "note": "no file"}

    target = f"{folder}/shared"
    trials = T.zipped(spark, {"a": [1, 2, 3]})
    results = T.evaluate(trials, train, files=target)
    results.collect()  # an attempt whose rows are lost
    results.write.json(f"{folder}/rows")
    stored = spark.read.schema(T.RESULT_SCHEMA).json(f"{folder}/rows")
    assert len(os.listdir(target)) == 18 and T.drop_unnamed(stored, f"file:{target}") == 9
    assert len(os.listdir(target)) == 9 and os.listdir(f"{folder}/local") == []
    for row in stored.collect():
        paths = {k: v.removeprefix("file:") for k, v in row.outputs.items()}
        assert open(paths["plot"]).read() == row.outputs["metric"] and os.listdir(paths["model"]) == ["inner"]
        assert open(paths["log"]).read() == f"trial {row.outputs['metric']}\n" and paths["note"] == "no file"


def test_trees_of_other_tools(spark, folder):
    from millrace.plans import run_trees as R

    rows = [("app_1", None, f"a={i}", {"a": str(i)}, {"metric": str(i / 4), "log": "l"}, i / 4) for i in range(3)]
    rows += [("app_2", g, f"b={i}", {"b": str(i)}, {"metric": "1.0"}, 1.0 + (g == 10) * i) for g in (2, 10) for i in range(2)]
    rows += [("app_3", None, "", None, {"x": "[1, 2]"}, None)]
    assert R.write_run_tree(spark.createDataFrame(rows, R.TREE_SCHEMA), f"{folder}/tree") == len(rows)
    with open(f"{folder}/tree/app_1/a=0/.hparams.json", "w") as file:
        file.write("{broken")
    found = {tuple(r)[:3]: tuple(r)[3:] for r in R.read_run_tree(spark, f"{folder}/tree").collect()}
    wanted = {r[:3]: r[3:] for r in rows}
    wanted["app_1", None, "a=0"] = (None, *wanted["app_1", None, "a=0"][1:])
    assert found == wanted
    best = {r.run_id: r for r in R.best_of_runs(R.read_run_tree(spark, f"{folder}/tree")).collect()}
    assert (best["app_1"].best_trial, best["app_1"].best_metric) == ("a=2", 0.5) and best["app_3"].best_metric is None
    assert (best["app_2"].best_generation, best["app_2"].best_trial, best["app_2"].generations) == (10, "b=1", 2)
    worst = {r.run_id: r for r in R.best_of_runs(R.read_run_tree(spark, f"{folder}/tree"), "min").collect()}
    assert (worst["app_2"].best_generation, worst["app_2"].best_trial) == (2, "b=0")
