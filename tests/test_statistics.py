"""Statistics against known values and brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import statistics as S


@pytest.fixture
def scores(spark):
    """4210 ones, 1567 twos and 4223 threes."""
    return spark.range(10000).select(
        F.when(F.col("id") < 4210, 1).when(F.col("id") < 5777, 2).otherwise(3).alias("score")
    )


def test_known_measures(scores):
    found = {r.metric: r.value for r in S.descriptive_statistics(scores).collect()}
    assert found["count"] == 10000 and found["min"] == 1 and found["max"] == 3
    assert found["mean"] == pytest.approx(2.0013)
    assert found["stddev"] == pytest.approx(0.9183587, abs=1e-7)


def test_known_histogram(scores):
    rows = {r.bin: (r.bin_label, r.frequency) for r in S.histograms(scores).collect()}
    assert len(rows) == 20
    assert rows[0] == (1.1, 4210) and rows[10] == (2.1, 1567) and rows[19] == (3.0, 4223)
    assert sum(n for _, n in rows.values()) == 10000


def test_histogram_edges(spark):
    df = spark.createDataFrame(
        [(1.0, 7, None), (2.0, 7, None), (float("nan"), 7, None), (None, 7, None), (50.0, 7, None), (float("inf"), 7, None)],
        "x double, constant int, empty double",
    )
    rows = S.histograms(df).collect()
    x = {r.bin: r.frequency for r in rows if r.feature == "x"}
    assert sum(x.values()) == 3 and x[19] == 1
    assert [(r.bin_label, r.frequency) for r in rows if r.feature == "constant"] == [(7.0, 6)]
    assert not [r for r in rows if r.feature == "empty"]


def test_correlations_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(400, 6)), columns=list("abcdef"))
    pdf["d"] = (pdf["a"] * 2 + pdf["d"]).round(1)
    pdf["e"] = pdf["e"] + 1e9
    df = spark.createDataFrame(pdf).repartition(3)
    for names, method in ((list("abcd"), "pearson"), (list("abcdef"), "pearson"), (list("abcd"), "spearman")):
        wanted = pdf[names].corr(method=method)
        rows = S.correlation_matrix(df, names, method).collect()
        assert len(rows) == len(names) ** 2
        for r in rows:
            assert r.correlation == pytest.approx(wanted.loc[r.feature, r.other], abs=1e-6)


def test_matrix_products_leave_out_nulls(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(300, 6)), columns=list("abcdef"))
    pdf = pdf.mask(rng.random(pdf.shape) < 0.2)
    pdf["f"] = 3.0
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(4)
    wanted = pdf.corr()
    found = {(r.feature, r.other): r.correlation for r in S.correlation_matrix(df).collect()}
    assert len(found) == 36
    for (a, b), value in found.items():
        if a == b:
            assert value == 1.0
        elif "f" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(wanted.loc[a, b], abs=1e-9)


def test_ranks_of_a_hot_value(spark):
    """A third of all rows share one value."""
    values = [5.0] * 300 + [float(i) for i in range(600)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    wanted = pd.Series(values).rank()
    expected = dict(zip(values, wanted))
    assert {r.x: r._rank for r in S.average_ranks(df, "x").collect()} == expected


@pytest.mark.parametrize("most", [1 << 16, 30, 0])
def test_ranks_pair_by_pair(spark, monkeypatch, most):
    """Ranks from broadcast tables, from joins, and from both; a pair does not see other columns' gaps."""
    monkeypatch.setattr(S, "BROADCAST_RANKS", most)
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(size=(500, 4)).round(1), columns=list("abcd"))
    pdf["b"] = (pdf["b"] + pdf["a"]).round(0)
    pdf["c"] = pdf["c"].mask(rng.random(500) < 0.3)
    pdf["d"] = pdf["d"].mask(rng.random(500) < 0.5)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    wanted = pdf.corr(method="spearman")
    found = {(r.feature, r.other): r.correlation for r in S.correlation_matrix(df, method="spearman").collect()}
    assert len(found) == 16
    for (a, b), value in found.items():
        assert value == pytest.approx(wanted.loc[a, b], abs=1e-9)
    alone = {(r.feature, r.other): r.correlation for r in S.correlation_matrix(df, ["a", "b"], "spearman").collect()}
    assert alone["a", "b"] == pytest.approx(found["a", "b"], abs=1e-12)
    assert S.correlation_matrix(df.limit(0), method="spearman").count() == 0


def test_measures_of_odd_numbers(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame(
        [(1.0, inf, nan, None, 5.0), (None, 2.0, 1.0, None, None), (3.0, -inf, 2.0, None, None)],
        "plain double, both double, gap double, none double, one double",
    )
    found = {(r.feature, r.metric): r.value for r in S.descriptive_statistics(df).collect()}
    of = lambda c: [found[c, m] for m in S.METRICS]
    assert of("plain") == [2, 2, pytest.approx(2**0.5), 1, 3] and of("none") == [0, None, None, None, None]
    assert of("one") == [1, 5, None, 5, 5] and of("both")[3:] == [-inf, inf] and of("gap")[3] == 1
    assert all(v != v for v in (*of("both")[1:3], *of("gap")[1:3], of("gap")[4]))


def test_states_add_up(spark):
    df = spark.range(1000).select((F.col("id") % 17 + 1e6).alias("a"), (F.sqrt("id")).alias("b")).repartition(5)
    whole = S.merged(S.moments(df, ["a", "b"])).orderBy("feature", "other").collect()
    parts = S.moments(df.filter("b < 9"), ["a", "b"]).unionByName(S.moments(df.filter("b >= 9"), ["a", "b"]))
    for x, y in zip(whole, S.merged(parts).orderBy("feature", "other").collect()):
        assert x[:2] == y[:2] and list(x[2:]) == [v if v is None else pytest.approx(v, rel=1e-9) for v in y[2:]]


def test_pairs_leave_out_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 6.0), (None, 1.0), (4.0, 8.0)], "a double, b double")
    found = {(r.feature, r.other): r.correlation for r in S.correlation_matrix(df).collect()}
    assert found[("a", "b")] == pytest.approx(1.0) and found[("b", "a")] == found[("a", "b")]


def test_measures_of_many_columns(spark):
    columns = [(F.col("id") * (i + 1) / 3).alias(f"c{i}") for i in range(11)]
    df = spark.range(100).select(*columns, F.lit(None).cast("double").alias("empty"))
    found = {(r.feature, r.metric): r.value for r in S.descriptive_statistics(df).collect()}
    few = {(r.feature, r.metric): r.value for n in range(0, 11, 5)
           for r in S.descriptive_statistics(df, [f"c{i}" for i in range(n, min(n + 5, 11))]).collect()}
    assert len(found) == 60 and found[("empty", "count")] == 0 and found[("empty", "mean")] is None
    for key, value in few.items():
        assert found[key] == pytest.approx(value, rel=1e-12)
    assert {r.feature for r in S.descriptive_statistics(df.limit(0)).collect()} == set(df.columns)


def test_many_columns(spark):
    wide = spark.range(30).select(*[(F.rand(i) * 10).alias(f"c{i}") for i in range(49)])
    assert S.correlation_matrix(wide).count() == 49 * 49
    with pytest.raises(ValueError, match="fewer than 50"):
        S.correlation_matrix(wide.withColumn("c49", F.lit(1.0)))


def test_unknown_columns(spark):
    with pytest.raises(ValueError, match="not numeric"):
        S.descriptive_statistics(spark.sql("SELECT 'a' AS x"), ["x"])


def test_clusters(spark):
    points = spark.range(200).select(
        F.col("id").alias("point"), ((F.col("id") % 5) * 100 + F.rand(1)).alias("x"), ((F.col("id") % 5) * -50 + F.rand(2)).alias("y")
    )
    rows = S.cluster_analysis(points, ["x", "y"], id_column="point").collect()
    assert len(rows) == 200
    groups = {}
    for r in rows:
        groups.setdefault(int(r.datapoint) % 5, set()).add(r.cluster)
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == 5
    assert S.cluster_analysis(points, ["x", "y"], id_column="point", sample_points=47).count() == 47


def test_correlation_does_not_depend_on_other_columns(spark):
    rows = [(float(i), float((i * 7) % 11), 1e9 + i % 5 if i > 1200 else None, float(i % 3), 1.0 * i * i, -float(i)) for i in range(3000)]
    rows.append((float("nan"), None, 1.0, 2.0, 3.0, 4.0))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double")
    matrix = {(r.feature, r.other): r.correlation for r in S.correlation_matrix(df).collect()}
    for x, y in (("a", "b"), ("b", "c"), ("c", "d"), ("e", "f")):
        pair = {(r.feature, r.other): r.correlation for r in S.correlation_matrix(df, [x, y]).collect()}
        kept = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        assert matrix[x, y] == pytest.approx(pair[x, y])
        # Values near 1e9 leave the one-pass aggregate itself about seven digits.
        assert matrix[x, y] == pytest.approx(kept.agg(F.corr(x, y)).first()[0], abs=1e-6)
    assert matrix["a", "d"] != matrix["a", "d"]
