"""Trials, picks, memo and scatter, evolution, run records."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalars import trial_key
from millrace.operators import evolution as E
from millrace.operators import trials as T
from millrace.plans import run_trees
from millrace.plans.experiments import Experiments, latest_status, run_summary
from millrace.queries.common import table
from millrace.session import fresh_dir

_DISCOUNTS = [0.0, 0.02, 0.04, 0.06, 0.08]
_QUANTITIES = [5.0, 15.0, 25.0, 35.0, 45.0]


def _lines(spark, sf_dir):
    """Lines with their price in cents: whole numbers add up exactly."""
    return table(spark, sf_dir, "lineitem").select(
        "l_discount", "l_quantity", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents")
    )


def _price(p):
    """Cents of the lines that pass both thresholds."""
    passed = (F.col("l_discount") >= p["discount"]) & (F.col("l_quantity") < p["quantity"])
    return F.sum(F.when(passed, F.col("cents")).otherwise(F.lit(0)))


def _scored_grid(spark, sf_dir):
    grid = T.grid(spark, {"discount": _DISCOUNTS, "quantity": _QUANTITIES})
    return T.score_over(_lines(spark, sf_dir), grid, _price)


def trials_objective(spark, sf_dir):
    return _scored_grid(spark, sf_dir).select("trial_id", "trial_key", "metric")


def _order_trials(spark, sf_dir):
    """Stored results with one trial per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trial_id"),
        F.concat(F.lit("priority="), "o_orderpriority").alias("trial_key"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("params"),
        F.create_map(F.lit("metric"), F.col("o_totalprice").cast("string")).alias("outputs"),
        F.col("o_totalprice").alias("metric"),
        F.year("o_orderdate").alias("generation"),
    )


def trials_best_max(spark, sf_dir):
    return T.best_trial(_order_trials(spark, sf_dir), "MAX").select("trial_id", "trial_key", "metric")


def trials_best_min(spark, sf_dir):
    return T.best_trial(_order_trials(spark, sf_dir), "MIN").select("trial_id", "trial_key", "metric")


def trials_summary(spark, sf_dir):
    return T.metric_summary(_order_trials(spark, sf_dir)).withColumn("avg_metric", F.round("avg_metric", 4))


def trials_per_generation(spark, sf_dir):
    return T.best_per_group(_order_trials(spark, sf_dir), "generation", "MAX").withColumn(
        "avg_metric", F.round("avg_metric", 4)
    )


def trials_grid(spark, sf_dir):
    """A grid over texts, each combination scored by the orders it matches."""
    grid = T.grid(spark, {"status": ["F", "O", "P"], "priority": ["1-URGENT", "3-MEDIUM", "5-LOW"]})
    return T.score_over(
        table(spark, sf_dir, "orders"), grid,
        lambda p: F.count_if((F.col("o_orderstatus") == p["status"]) & (F.col("o_orderpriority") == p["priority"])),
    ).select("trial_id", "trial_key", "metric")


def trials_zip(spark, sf_dir):
    trials = T.zipped(spark, {"low": [0, 100000, 250000], "high": [100000, 250000, 600000]})
    return T.score_over(
        table(spark, sf_dir, "orders"), trials,
        lambda p: F.count_if((F.col("o_totalprice") >= p["low"]) & (F.col("o_totalprice") < p["high"])),
    ).select("trial_id", "trial_key", "metric")


def trials_random(spark, sf_dir):
    trials = T.random_samples(spark, {"discount": [0.0, 0.1], "quantity": [1, 50]}, samples=20, seed=7)
    return T.score_over(_lines(spark, sf_dir), trials, _price).select("trial_id", "trial_key", "metric")


def trials_dedup(spark, sf_dir):
    """First order of every status and priority."""
    trials = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trial_id"), "o_orderstatus", "o_orderpriority"
    )
    return T.drop_repeated(trials, ["o_orderstatus", "o_orderpriority"])


def trials_python_objective(spark, sf_dir):
    """A Python function run on every part."""
    trials = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("trial_id"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")
    )

    def objective(size, price):
        return {"value": size * 2.0 + price, "size": size}

    tasks = spark.sparkContext.defaultParallelism
    return T.evaluate(trials, objective, "value", parallelism=tasks).select(
        "trial_id", F.col("outputs")["size"].cast("int").alias("size"), F.round("metric", 4).alias("metric")
    )


def _customer_trials(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("trial_id"), "c_custkey", "c_nationkey")
    return customers.withColumn("trial_key", trial_key(["c_custkey"]))


def _urgent_history(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    orders = urgent.withColumnRenamed("o_custkey", "c_custkey")
    return orders.select(trial_key(["c_custkey"]).alias("trial_key"), F.col("o_totalprice").alias("metric"),
                         F.col("o_orderkey").alias("generation"))


def trials_memo(spark, sf_dir):
    """Customers nobody scored yet: those without urgent orders."""
    return T.unseen(_customer_trials(spark, sf_dir), _urgent_history(spark, sf_dir)).select("trial_key", "c_nationkey")


def trials_remembered(spark, sf_dir):
    """Customers scored before take the score of their earliest urgent order."""
    return T.remembered(_customer_trials(spark, sf_dir), _urgent_history(spark, sf_dir)).select(
        "trial_key", "c_nationkey", "metric"
    )


def trials_scatter(spark, sf_dir):
    """Scores of unique combinations back to every order."""
    names = ["o_orderstatus", "o_orderpriority"]
    population = table(spark, sf_dir, "orders").select("o_orderkey", trial_key(names).alias("trial_key"))
    scores = table(spark, sf_dir, "orders").groupBy(*names).agg(F.max("o_totalprice").alias("metric")).select(
        trial_key(names).alias("trial_key"), "metric"
    )
    return T.scatter(population, scores)


def trials_join_parameters(spark, sf_dir):
    outputs = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("run"), "o_totalprice")
    params = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run"), "c_mktsegment")
    return T.join_parameters(outputs, params, "run")


def de_donors(spark, sf_dir):
    """Three distinct others for every customer, checked."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("individual"))
    size = customers.count()
    picks = F.col("picks")
    valid = (
        (F.size(F.array_distinct(F.array_append(picks, F.col("individual")))) == 4)
        & F.forall(picks, lambda p: (p >= 0) & (p < size))
    )
    return E.donor_indices(customers, size, 42, 1).agg(
        F.count(F.lit(1)).alias("individuals"), F.count_if(valid).alias("valid")
    )


def _evolved(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")

    def objective(p):
        # Fewer passing lines lower the total, more of them raise the penalty: a peak in between.
        passed = (F.col("l_discount") * 100 >= p["discount"]) & (F.col("l_quantity") < p["quantity"])
        gain = F.sum(F.when(passed, F.col("l_extendedprice")).otherwise(0.0))
        return gain / 1000 - F.count_if(passed) * p["quantity"]

    return E.evolve(
        spark, lambda trials: T.score_over(lineitem, trials, objective), {"discount": [0, 10], "quantity": [1.0, 50.0]},
        fresh_dir(spark, "evolution"), "MAX", generations=3, population=5, seed=11,
    )


def de_search(spark, sf_dir):
    return _evolved(spark, sf_dir).history.select("generation", "trial_id", "trial_key", "metric")


def de_generation(spark, sf_dir):
    return E.generation_summary(_evolved(spark, sf_dir).populations)


def experiment_status(spark, sf_dir):
    """Newest state of every user's run."""
    statuses = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.upper("event_type").alias("state"), F.col("value").alias("metric"),
        F.col("event_id").alias("seq"),
    )
    return latest_status(statuses)


def experiment_results(spark, sf_dir):
    """Trials of three runs, stored below their run folders and read back together."""
    runs = Experiments(spark, fresh_dir(spark, "experiments"), "app")
    trials = _order_trials(spark, sf_dir).drop("generation")
    for state in ("F", "O", "P"):
        orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == state)
        runs.store_results(f"app_{state}", trials.join(orders, F.col("trial_id") == F.col("o_orderkey"), "left_semi"))
    return runs.results().select(
        "run_id", "trial_id", F.col("params")["priority"].alias("priority"), "metric"
    )


def run_summaries(spark, sf_dir):
    return run_summary(_order_trials(spark, sf_dir).withColumn(
        "outputs", F.create_map(F.lit("cents"), F.round(F.col("metric") * 100).cast("long").cast("string"))
    ))


def runs_foreign(spark, sf_dir):
    """A tree of run folders written from the orders, read back and folded to a row per run."""
    root = fresh_dir(spark, "runs")
    grouped = table(spark, sf_dir, "orders").groupBy(
        F.regexp_replace("o_orderpriority", " ", "_").alias("run_id"), F.month("o_orderdate").alias("generation"),
        F.concat(F.lit("status="), "o_orderstatus").alias("trial"), "o_orderstatus",
    ).agg(F.max("o_totalprice").alias("metric"), F.count(F.lit(1)).alias("n"))
    run_trees.write_run_tree(grouped.select(
        "run_id", "generation", "trial", F.create_map(F.lit("status"), "o_orderstatus").alias("params"),
        F.create_map(F.lit("n"), F.col("n").cast("string")).alias("outputs"), "metric",
    ), root)
    trials = run_trees.read_run_tree(spark, root)
    sums = trials.groupBy("run_id").agg(F.sum(F.col("outputs")["n"].cast("long")).alias("n_orders"))
    return run_trees.best_of_runs(trials).drop("best_params").join(sums, "run_id")


QUERIES = {
    "runs_foreign": runs_foreign,
    "trials_objective": trials_objective,
    "trials_grid": trials_grid,
    "trials_zip": trials_zip,
    "trials_random": trials_random,
    "trials_dedup": trials_dedup,
    "trials_best_max": trials_best_max,
    "trials_best_min": trials_best_min,
    "trials_summary": trials_summary,
    "trials_per_generation": trials_per_generation,
    "trials_python_objective": trials_python_objective,
    "trials_memo": trials_memo,
    "trials_remembered": trials_remembered,
    "trials_scatter": trials_scatter,
    "trials_join_parameters": trials_join_parameters,
    "de_donors": de_donors,
    "de_search": de_search,
    "de_generation": de_generation,
    "experiment_status": experiment_status,
    "experiment_results": experiment_results,
    "run_summaries": run_summaries,
}


def _values(numbers) -> str:
    return "(VALUES " + ", ".join(f"({i}, {v}::DOUBLE)" for i, v in enumerate(numbers)) + ")"


def _texts(values) -> str:
    return "(VALUES " + ", ".join(f"({i}, '{v}')" for i, v in enumerate(values)) + ")"


_TRIALS = (
    "(SELECT o_orderkey AS trial_id, 'priority=' || o_orderpriority AS trial_key, o_totalprice AS metric, "
    "CAST(year(o_orderdate) AS INTEGER) AS generation FROM orders)"
)

SQL = {
    "runs_foreign": (
        "WITH t AS (SELECT replace(o_orderpriority, ' ', '_') AS run_id, CAST(month(o_orderdate) AS INTEGER) AS generation, "
        "'status=' || o_orderstatus AS trial, max(o_totalprice) AS metric, count(*) AS n FROM orders GROUP BY ALL), "
        "b AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY metric DESC, generation, trial) AS place FROM t) "
        "SELECT run_id, count(*) AS trials, count(DISTINCT generation) AS generations, max(metric) AS best_metric, "
        "max(generation) FILTER (WHERE place = 1) AS best_generation, max(trial) FILTER (WHERE place = 1) AS best_trial, "
        "CAST(sum(n) AS BIGINT) AS n_orders FROM b GROUP BY run_id"
    ),
    "trials_objective": (
        "SELECT CAST(d.i * 5 + q.i AS BIGINT) AS trial_id, 'discount=' || d.v || '&quantity=' || q.v AS trial_key, "
        "CAST(sum(CASE WHEN l_discount >= d.v AND l_quantity < q.v "
        "THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END) AS DOUBLE) AS metric "
        f"FROM {_values(_DISCOUNTS)} d(i, v) CROSS JOIN {_values(_QUANTITIES)} q(i, v) CROSS JOIN lineitem "
        "GROUP BY d.i, d.v, q.i, q.v"
    ),
    "trials_grid": (
        "SELECT CAST(s.i * 3 + p.i AS BIGINT) AS trial_id, 'status=' || s.v || '&priority=' || p.v AS trial_key, "
        "CAST(count(*) FILTER (WHERE o_orderstatus = s.v AND o_orderpriority = p.v) AS DOUBLE) AS metric "
        f"FROM {_texts(['F', 'O', 'P'])} s(i, v) CROSS JOIN {_texts(['1-URGENT', '3-MEDIUM', '5-LOW'])} p(i, v) "
        "CROSS JOIN orders GROUP BY s.i, s.v, p.i, p.v"
    ),
    "trials_zip": (
        "SELECT CAST(t.i AS BIGINT) AS trial_id, 'low=' || t.lo || '&high=' || t.hi AS trial_key, "
        "CAST(count(*) FILTER (WHERE o_totalprice >= t.lo AND o_totalprice < t.hi) AS DOUBLE) AS metric "
        "FROM (VALUES (0, 0, 100000), (1, 100000, 250000), (2, 250000, 600000)) t(i, lo, hi) CROSS JOIN orders "
        "GROUP BY t.i, t.lo, t.hi"
    ),
    "trials_dedup": (
        "SELECT min(o_orderkey) AS trial_id, o_orderstatus, o_orderpriority FROM orders "
        "GROUP BY o_orderstatus, o_orderpriority"
    ),
    "trials_best_max": (
        f"SELECT trial_id, trial_key, metric FROM {_TRIALS} t ORDER BY metric DESC, trial_id LIMIT 1"
    ),
    "trials_best_min": f"SELECT trial_id, trial_key, metric FROM {_TRIALS} t ORDER BY metric, trial_id LIMIT 1",
    "trials_summary": (
        "SELECT count(*) AS trials, max(metric) AS max_metric, min(metric) AS min_metric, "
        f"round(avg(metric), 4) AS avg_metric FROM {_TRIALS} t"
    ),
    "trials_per_generation": (
        "SELECT generation, trials, round(avg_metric, 4) AS avg_metric, metric AS best_metric, "
        "trial_id AS best_trial_id, trial_key AS best_trial_key FROM (SELECT *, "
        "count(*) OVER (PARTITION BY generation) AS trials, avg(metric) OVER (PARTITION BY generation) AS avg_metric, "
        f"row_number() OVER (PARTITION BY generation ORDER BY metric DESC, trial_id) AS rn FROM {_TRIALS} t) "
        "WHERE rn = 1"
    ),
    "trials_python_objective": (
        "SELECT p_partkey AS trial_id, p_size AS size, round(p_size * 2.0::DOUBLE + p_retailprice, 4) AS metric FROM part"
    ),
    "trials_memo": (
        "SELECT 'c_custkey=' || c_custkey AS trial_key, c_nationkey FROM customer "
        "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')"
    ),
    "trials_remembered": (
        "SELECT 'c_custkey=' || c_custkey AS trial_key, c_nationkey, metric FROM customer JOIN "
        "(SELECT o_custkey, arg_min(o_totalprice, o_orderkey) AS metric FROM orders "
        "WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) o "
        "ON o_custkey = c_custkey"
    ),
    "trials_scatter": (
        "SELECT o_orderkey, 'o_orderstatus=' || o_orderstatus || '&o_orderpriority=' || o_orderpriority AS trial_key, "
        "max(o_totalprice) OVER (PARTITION BY o_orderstatus, o_orderpriority) AS metric FROM orders"
    ),
    "trials_join_parameters": (
        "SELECT o_custkey AS run, o_orderkey, o_totalprice, c_mktsegment FROM orders "
        "LEFT JOIN customer ON c_custkey = o_custkey"
    ),
    "de_donors": "SELECT count(*) AS individuals, count(*) AS valid FROM customer",
    "experiment_status": (
        "SELECT user_id AS run_id, upper(event_type) AS state, value AS metric, event_id AS seq FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"
    ),
    "experiment_results": (
        "SELECT 'app_' || o_orderstatus AS run_id, o_orderkey AS trial_id, o_orderpriority AS priority, "
        "o_totalprice AS metric FROM orders"
    ),
    "run_summaries": (
        "SELECT o_orderkey AS trial_id, '{\"priority\":\"' || o_orderpriority || '\"}' AS parameters, "
        "'{\"cents\":\"' || CAST(round(o_totalprice * 100) AS BIGINT) || '\"}' AS outputs FROM orders"
    ),
}
