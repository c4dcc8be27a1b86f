"""Differential evolution with the population as a frame.

A population row is (individual, genes, score). Each generation writes its scored candidates and
its population as tables below the run folder and reads them back, which keeps plans short and
lets a lost executor cost only its own tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import category, clamp, clamp_whole, crossover, donor, draw, trial_key
from millrace.operators import trials as trial_ops
from millrace.operators.trials import MAX, check_direction

INT, FLOAT, CATEGORY = "int", "float", "cat"


@dataclass(frozen=True)
class Gene:
    """One searched parameter: its type follows from the lower bound."""

    name: str
    kind: str
    low: float
    high: float
    values: tuple = ()

    @classmethod
    def of(cls, name: str, pair: Sequence) -> Gene:
        if len(pair) != 2:
            raise ValueError(f"boundaries of {name} must have two entries: {pair!r}")
        low, high = pair
        if isinstance(low, int) and not isinstance(low, bool):
            return cls(name, INT, low, high)
        if isinstance(low, float):
            return cls(name, FLOAT, low, high)
        return cls(name, CATEGORY, 0, 1, tuple(pair))

    def bounded(self, value: Column) -> Column:
        if self.kind == FLOAT:
            return clamp(value, self.low, self.high)
        return clamp_whole(value, self.low, self.high)

    def decoded(self, value: Column) -> Column:
        if self.kind == INT:
            return value.cast("long")
        return category(self.values, value) if self.kind == CATEGORY else value


def genes_of(boundaries: Mapping[str, Sequence]) -> list[Gene]:
    return [Gene.of(name, pair) for name, pair in boundaries.items()]


def initial_population(spark: SparkSession, genes: Sequence[Gene], size: int, seed: int) -> DataFrame:
    drawn = [
        g.bounded(F.lit(float(g.low)) + draw(seed, "individual", F.lit(i)) * F.lit(float(g.high - g.low)))
        for i, g in enumerate(genes)
    ]
    ids = spark.range(size).withColumnRenamed("id", "individual")
    return ids.select("individual", F.array(*drawn).alias("genes"))


def donor_indices(population: DataFrame, size: int, seed: int, generation: int) -> DataFrame:
    """Add ``picks``: three distinct individuals other than the row's own, each equally likely.

    The k-th pick is drawn from the remaining ones and moved past those already taken, so no
    pairs of individuals are formed.
    """
    def past(pick, taken):
        return pick + F.when(pick >= taken, 1).otherwise(0)

    def add(taken, k):
        unit = draw(seed, "individual", F.lit(generation), k)
        drawn = F.floor(unit * (F.lit(size - 1) - k)).cast("long")
        return F.array_append(taken, F.aggregate(F.array_sort(taken), drawn, past))

    own = F.array(F.col("individual").cast("long"))
    steps = F.sequence(F.lit(0), F.lit(2))
    return population.withColumn("picks", F.slice(F.aggregate(steps, own, add), 2, 3))


def trial_population(
    population: DataFrame, genes: Sequence[Gene], size: int, mutation: float, crossover_rate: float,
    seed: int, generation: int,
) -> DataFrame:
    """Mutate and recombine: (individual, genes, trial_genes)."""
    picks = F.col("picks")
    chosen = donor_indices(population, size, seed, generation).select(
        "individual", "genes", picks[0].alias("ia"), picks[1].alias("ib"), picks[2].alias("ic")
    )
    for index, name in (("ia", "a"), ("ib", "b"), ("ic", "c")):
        other = population.select(F.col("individual").alias(index), F.col("genes").alias(name))
        chosen = chosen.join(other, index)
    mixed = []
    for i, gene in enumerate(genes):
        mutated = gene.bounded(donor(F.col("a")[i], F.col("b")[i], F.col("c")[i], mutation))
        unit = draw(seed, "individual", F.lit(generation), F.lit(2000 + i))
        mixed.append(crossover(unit, crossover_rate, mutated, F.col("genes")[i]))
    return chosen.select("individual", "genes", F.array(*mixed).alias("trial_genes"))


def as_trials(population: DataFrame, genes: Sequence[Gene], column: str = "genes") -> DataFrame:
    """Individuals as typed trials: trial_id is the individual."""
    return population.select(
        F.col("individual").alias("trial_id"),
        *[g.decoded(F.col(column)[i]).alias(g.name) for i, g in enumerate(genes)],
    )


def select_better(scored: DataFrame, direction: str) -> DataFrame:
    """Per individual the candidate when it is strictly better, else the present one.

    A null or NaN score never wins and loses against every number.
    """
    better = F.col("trial_score") > F.col("score")
    if check_direction(direction) != MAX:
        better = F.col("trial_score") < F.col("score")
    known, had = (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in ("trial_score", "score"))
    better = known & (~had | F.coalesce(better, F.lit(False)))
    return scored.select(
        "individual",
        F.when(better, F.col("trial_genes")).otherwise(F.col("genes")).alias("genes"),
        F.when(better, F.col("trial_score")).otherwise(F.col("score")).alias("score"),
    )


def generation_summary(populations: DataFrame, direction: str = MAX) -> DataFrame:
    """Per generation the mean and best score and the first individual that has the best."""
    results = populations.select(
        "generation", F.col("individual").alias("trial_id"),
        F.concat_ws(",", F.transform("genes", lambda g: g.cast("string"))).alias("trial_key"),
        F.col("score").alias("metric"),
    )
    return trial_ops.best_per_group(results, "generation", direction).select(
        "generation", "avg_metric", "best_metric", F.col("best_trial_id").alias("best_individual")
    ).orderBy("generation")


@dataclass(frozen=True)
class Evolved:
    """Tables of a finished search."""

    path: str
    history: DataFrame  # every scored combination: generation, trial_id, trial_key, params, outputs, metric
    populations: DataFrame  # generation, individual, genes, score


def evolve(
    spark: SparkSession,
    evaluator: Callable[[DataFrame], DataFrame],
    boundaries: Mapping[str, Sequence],
    path: str,
    direction: str = MAX,
    generations: int = 4,
    population: int = 6,
    mutation: float = 0.5,
    crossover: float = 0.7,
    seed: int = 42,
) -> Evolved:
    """Search below ``path``; ``evaluator`` turns a trial frame into a result frame.

    Combinations are scored once: repeats inside a generation and combinations of earlier
    generations take the stored score. The driver only loops over generations.
    """
    direction = check_direction(direction)
    if not population > 3:
        raise ValueError("the population must have more than three individuals")
    if not generations > 1:
        raise ValueError("there must be more than one generation")
    genes = genes_of(boundaries)
    names = [g.name for g in genes]
    history_path, population_path = f"{path}/history", f"{path}/population"

    def history() -> DataFrame:
        return spark.read.parquet(history_path)

    def score(candidates: DataFrame, column: str, generation: int) -> DataFrame:
        """Score what is new and return (individual, trial_key, metric) for all candidates.

        Draws depend on the seed only, so candidates may be computed again from the stored
        population; only the scores, which cost work, are written.
        """
        keyed = as_trials(candidates, genes, column)
        fresh = trial_ops.drop_repeated(keyed, names)
        if generation:
            fresh = trial_ops.unseen(fresh.withColumn("trial_key", trial_key(names)), history()).drop("trial_key")
        evaluator(fresh).write.mode("overwrite").parquet(f"{history_path}/generation={generation}")
        wanted = keyed.select(F.col("trial_id").alias("individual"), trial_key(names).alias("trial_key"))
        return trial_ops.remembered(wanted, history())

    def keep(frame: DataFrame, generation: int) -> DataFrame:
        target = f"{population_path}/generation={generation}"
        frame.write.mode("overwrite").parquet(target)
        return spark.read.parquet(target)

    start = initial_population(spark, genes, population, seed)
    scored = score(start, "genes", 0)
    current = keep(start.join(scored.select("individual", F.col("metric").alias("score")), "individual"), 0)
    for generation in range(1, generations + 1):
        mixed = trial_population(current, genes, population, mutation, crossover, seed, generation)
        scored = score(mixed, "trial_genes", generation)
        compared = mixed.join(current.select("individual", "score"), "individual").join(
            scored.select("individual", F.col("metric").alias("trial_score")), "individual"
        )
        current = keep(select_better(compared, direction), generation)
    populations = spark.read.option("basePath", population_path).parquet(
        *[f"{population_path}/generation={g}" for g in range(generations + 1)]
    )
    return Evolved(path, history(), populations)
