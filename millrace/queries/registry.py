"""Model registry and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import registry as R
from millrace.plans import scoring
from millrace.queries.common import table


def _models(spark, sf_dir):
    """Orders as model versions; only some have an accuracy."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").cast("int").alias("version"),
        F.when(
            F.col("o_orderstatus") == "F",
            F.create_map(F.lit("accuracy"), F.col("o_totalprice"), F.lit("loss"), F.lit(1.0)),
        ).otherwise(F.create_map(F.lit("loss"), F.col("o_totalprice"))).alias("metrics"),
        F.col("o_custkey").alias("experiment_id"),
    )


def _best(direction):
    def run(spark, sf_dir):
        found = R.best_models(_models(spark, sf_dir), "2-HIGH", "accuracy", direction)
        return found.select("name", "version", F.col("metrics")["accuracy"].alias("accuracy"))

    return run


def model_get(spark, sf_dir):
    return R.model_version(_models(spark, sf_dir), "5-LOW", 0).select("name", "version", "experiment_id")


def model_next_version(spark, sf_dir):
    """Folder names as versions; those of open orders are no numbers."""
    folders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("draft"), F.col("o_orderkey").cast("string")))
        .otherwise(F.col("o_orderkey").cast("string")).alias("version"),
    )
    return R.next_versions(folders)


def model_experiment_link(spark, sf_dir):
    runs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_name").alias("run_name"))
    return R.link_experiments(_models(spark, sf_dir), runs).select("name", "version", "experiment_id", "run_name")


_INPUTS = ["l_quantity", "l_discount", "l_tax"]
_WEIGHTS = [0.5, -20.0, 8.0]


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_INPUTS)


def batch_score(spark, sf_dir):
    """A linear model loaded once per task."""
    def load():
        import numpy as np

        return np.array(_WEIGHTS)

    scored = scoring.score(_lines(spark, sf_dir), load, lambda m, x: x.to_numpy() @ m + 1.0, _INPUTS, "prediction double")
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 6).alias("prediction"))


def score_chain(spark, sf_dir):
    """Scale the inputs, predict, and turn the prediction into a class."""
    def load():
        import numpy as np

        return np.array(_WEIGHTS)

    def postprocess(y):
        import pandas as pd

        return pd.DataFrame({"value": y, "is_high": y > 3.0})

    scored = scoring.chain(
        _lines(spark, sf_dir), load, _INPUTS, "value double, is_high boolean",
        predict=lambda m, x: x.to_numpy() @ m,
        preprocess=lambda x: x.assign(l_quantity=x["l_quantity"] / 10.0),
        postprocess=postprocess,
    )
    return scored.select("l_orderkey", "l_linenumber", F.round("value", 6).alias("value"),
                         F.col("is_high").cast("int").alias("is_high"))


QUERIES = {
    "model_best_max": _best("MAX"),
    "model_best_min": _best("MIN"),
    "model_get": model_get,
    "model_next_version": model_next_version,
    "model_experiment_link": model_experiment_link,
    "batch_score": batch_score,
    "score_chain": score_chain,
}


def _best_sql(order: str) -> str:
    return (
        "SELECT o_orderpriority AS name, CAST(o_orderkey AS INTEGER) AS version, o_totalprice AS accuracy FROM orders "
        f"WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' ORDER BY o_totalprice {order}, o_orderkey LIMIT 1"
    )


SQL = {
    "model_best_max": _best_sql("DESC"),
    "model_best_min": _best_sql("ASC"),
    "model_get": (
        "SELECT o_orderpriority AS name, CAST(o_orderkey AS INTEGER) AS version, o_custkey AS experiment_id "
        "FROM orders WHERE o_orderkey = 0 AND o_orderpriority = '5-LOW'"
    ),
    "model_next_version": (
        "SELECT o_orderpriority AS name, "
        "CAST(coalesce(max(CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END), 0) AS INTEGER) AS latest_version, "
        "CAST(coalesce(max(CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END), 0) + 1 AS INTEGER) AS next_version "
        "FROM orders GROUP BY o_orderpriority"
    ),
    "model_experiment_link": (
        "SELECT o_orderpriority AS name, CAST(o_orderkey AS INTEGER) AS version, o_custkey AS experiment_id, "
        "c_name AS run_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey"
    ),
    "batch_score": (
        "SELECT l_orderkey, l_linenumber, round(l_quantity * 0.5::DOUBLE + l_discount * -20.0::DOUBLE "
        "+ l_tax * 8.0::DOUBLE + 1.0::DOUBLE, 6) AS prediction FROM lineitem"
    ),
    "score_chain": (
        "SELECT l_orderkey, l_linenumber, round(v, 6) AS value, CAST(v > 3.0 AS INTEGER) AS is_high FROM "
        "(SELECT l_orderkey, l_linenumber, l_quantity / 10.0::DOUBLE * 0.5::DOUBLE + l_discount * -20.0::DOUBLE "
        "+ l_tax * 8.0::DOUBLE AS v FROM lineitem)"
    ),
}
