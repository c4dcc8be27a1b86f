"""Column statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import statistics as S
from millrace.queries.common import new_store, table

_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def stats_descriptive(spark, sf_dir):
    return _rounded(S.descriptive_statistics(table(spark, sf_dir, "lineitem")), "value")


def stats_descriptive_pivot(spark, sf_dir):
    long_form = S.descriptive_statistics(table(spark, sf_dir, "lineitem"), _COLUMNS)
    return _rounded(S.descriptive_table(long_form), *S.METRICS)


def stats_correlation(spark, sf_dir):
    return _rounded(S.correlation_matrix(table(spark, sf_dir, "lineitem"), _COLUMNS), "correlation", digits=6)


def stats_spearman(spark, sf_dir):
    matrix = S.correlation_matrix(table(spark, sf_dir, "lineitem"), _COLUMNS, "spearman")
    return _rounded(matrix, "correlation", digits=6)


def stats_histogram(spark, sf_dir):
    return _rounded(S.histograms(table(spark, sf_dir, "lineitem"), _COLUMNS), "bin_label", digits=6)


def stats_clusters(spark, sf_dir):
    """Cluster and plane position of every vector."""
    return S.cluster_analysis(table(spark, sf_dir, "embeddings"), ["embedding"], id_column="vec_id")


def stats_clusters_check(spark, sf_dir):
    """All vectors are in the result once, in five clusters."""
    return stats_clusters(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("points"), F.countDistinct("datapoint").alias("vectors"),
        F.countDistinct("cluster").alias("clusters"),
        F.count(F.when(F.col("first_dimension").isNull() | F.col("second_dimension").isNull(), 1)).alias("unplaced"),
    )


def stats_spearman_nulls(spark, sf_dir):
    """Rank correlations of columns with gaps, each pair ranked where both have a value."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("l_quantity"), "l_extendedprice",
        F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias("l_discount"), "l_tax",
    )
    return _rounded(S.correlation_matrix(rows, _COLUMNS, "spearman"), "correlation", digits=6)


def stats_descriptive_decimal(spark, sf_dir):
    """Decimals have the same measures alone as among many columns."""
    rows = table(spark, sf_dir, "lineitem").select(
        *[F.col(c).cast("decimal(12,2)").alias(c) for c in _COLUMNS], *[F.col("l_tax").alias(f"tax_{i}") for i in range(8)]
    )
    alone = S.descriptive_statistics(rows, ["l_discount"]).withColumn("feature", F.lit("alone"))
    return _rounded(S.descriptive_statistics(rows, _COLUMNS + ("tax_7",)).unionByName(alone), "value", digits=9)


_STATED = ("o_totalprice", "o_custkey", "o_orderkey")


def _families(store, entity):
    """All families as (family, feature, other, value); clusters as their number and their points."""
    stats, none = store.statistics, F.lit(None).cast("string")
    points = stats.frame("cluster", entity)
    return _rounded(
        stats.frame("descriptive", entity).select(F.lit("descriptive").alias("family"), "feature", F.col("metric").alias("other"), "value")
        .unionByName(stats.frame("correlation", entity).select(F.lit("correlation").alias("family"), "feature", "other", F.col("correlation").alias("value")))
        .unionByName(stats.frame("histogram", entity).select(
            F.lit("histogram").alias("family"), "feature", F.col("bin").cast("string").alias("other"), F.col("frequency").cast("double").alias("value")))
        .unionByName(points.agg(F.countDistinct("cluster").cast("double").alias("value")).select(
            F.lit("clusters").alias("family"), none.alias("feature"), none.alias("other"), "value"))
        .unionByName(points.select(F.lit("points").alias("family"), none.alias("feature"), F.col("datapoint").alias("other"), F.lit(1.0).alias("value"))),
        "value",
    )


def stats_stored(spark, sf_dir):
    """All four families computed with a group and read back from the store; points have the group's key."""
    store = new_store(spark)
    store.create_featuregroup(table(spark, sf_dir, "orders"), "orders", primary_key=["o_orderkey"], stat_columns=_STATED)
    return _families(store, "orders_1")


def stats_after_append(spark, sf_dir):
    """The same after three appends, of which the last widens the range of a column."""
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_totalprice")).first()[0]
    high = F.col("o_totalprice") >= 0.9 * top
    store = new_store(spark)
    first, *others = [orders.filter(~high & (F.col("o_custkey") % 3 == part)) for part in range(3)]
    store.create_featuregroup(first, "orders", primary_key=["o_orderkey"], stat_columns=_STATED)
    for part in (*others, orders.filter(high)):
        store.insert_into_featuregroup(part, "orders")
    return _families(store, "orders_1")


QUERIES = {
    "stats_descriptive": stats_descriptive,
    "stats_descriptive_pivot": stats_descriptive_pivot,
    "stats_correlation": stats_correlation,
    "stats_spearman": stats_spearman,
    "stats_histogram": stats_histogram,
    "stats_clusters": stats_clusters,
    "stats_clusters_check": stats_clusters_check,
    "stats_stored": stats_stored,
    "stats_after_append": stats_after_append,
    "stats_spearman_nulls": stats_spearman_nulls,
    "stats_descriptive_decimal": stats_descriptive_decimal,
}


def _measure_sql(column: str, relation: str, name: str | None = None, digits: int = 4) -> str:
    expressions = {
        "count": f"CAST(count({column}) AS DOUBLE)", "mean": f"avg({column})", "stddev": f"stddev_samp({column})",
        "min": f"CAST(min({column}) AS DOUBLE)", "max": f"CAST(max({column}) AS DOUBLE)",
    }
    return " UNION ALL ".join(
        f"SELECT '{name or column}' AS feature, '{m}' AS metric, round({e}, {digits}) AS value FROM {relation}"
        for m, e in expressions.items()
    )


def _histogram_sql(column: str, relation: str = "lineitem") -> str:
    return f"""
SELECT '{column}' AS feature, CAST(g.b AS INTEGER) AS bin,
       round(CASE WHEN g.b = 19 THEN m.hi ELSE round(m.lo + (g.b + 1) * ((m.hi - m.lo) / 20.0), 10) END, 6) AS bin_label,
       coalesce(h.n, 0) AS frequency
FROM (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {relation}) m
CROSS JOIN (SELECT range AS b FROM range(0, 20)) g
LEFT JOIN (
  SELECT CAST(least(floor(({column} - m.lo) / ((m.hi - m.lo) / 20.0)), 19) AS BIGINT) AS b, count(*) AS n
  FROM {relation} CROSS JOIN (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {relation}) m
  WHERE {column} IS NOT NULL GROUP BY 1
) h ON h.b = g.b"""


def _rank_sql(column: str) -> str:
    return (f"rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0 AS {column}")


def _matrix_sql(relation: str, digits: int = 6, columns=_COLUMNS) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature, '{b}' AS other, "
        + ("1.0::DOUBLE" if a == b else f"round(corr({min(a, b)}, {max(a, b)}), {digits})")
        + f" AS correlation FROM {relation}" + (" HAVING count(*) > 0" if a == b else "")
        for a in columns for b in columns
    )


def _pair_ranks_sql(a: str, b: str) -> str:
    """One pair, ranked among the rows where both have a value."""
    if a == b:
        return f"SELECT '{a}' AS feature, '{b}' AS other, 1.0::DOUBLE AS correlation"
    x, y = sorted((a, b))
    return (
        f"SELECT '{a}' AS feature, '{b}' AS other, round(corr({x}, {y}), 6) AS correlation FROM "
        f"(SELECT {_rank_sql(x)}, {_rank_sql(y)} FROM gaps WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


def _families_sql() -> str:
    parts = [
        *[f"SELECT 'descriptive' AS family, feature, metric AS other, value FROM ({_measure_sql(c, 'orders')})" for c in _STATED],
        "SELECT 'correlation', feature, other, round(correlation, 4) FROM (" + _matrix_sql("orders", 4, _STATED) + ")",
        *[f"SELECT 'histogram', feature, CAST(bin AS VARCHAR), CAST(frequency AS DOUBLE) FROM ({_histogram_sql(c, 'orders')})" for c in _STATED],
        "SELECT 'clusters', NULL, NULL, 5.0::DOUBLE",
        "SELECT 'points', NULL, CAST(o_orderkey AS VARCHAR), 1.0::DOUBLE FROM orders",
    ]
    return " UNION ALL ".join(parts)


_ALL_NUMERIC = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_COLUMNS)

SQL = {
    "stats_descriptive": " UNION ALL ".join(_measure_sql(c, "lineitem") for c in _ALL_NUMERIC),
    "stats_descriptive_pivot": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, round(min({c}), 4) AS min, round(max({c}), 4) AS max FROM lineitem"
        for c in _COLUMNS
    ),
    "stats_correlation": _matrix_sql("lineitem"),
    "stats_spearman": (
        "WITH r AS (SELECT " + ", ".join(_rank_sql(c) for c in _COLUMNS) + " FROM lineitem) " + _matrix_sql("r")
    ),
    "stats_histogram": " UNION ALL ".join(_histogram_sql(c) for c in _COLUMNS),
    "stats_clusters_check": (
        "SELECT count(*) AS points, count(DISTINCT vec_id) AS vectors, CAST(5 AS BIGINT) AS clusters, "
        "CAST(0 AS BIGINT) AS unplaced FROM embeddings"
    ),
    "stats_stored": _families_sql(),
    "stats_after_append": _families_sql(),
    "stats_spearman_nulls": (
        "WITH gaps AS (SELECT CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS l_quantity, l_extendedprice, "
        "CASE WHEN l_returnflag <> 'R' THEN l_discount END AS l_discount, l_tax FROM lineitem) "
        + " UNION ALL ".join(_pair_ranks_sql(a, b) for a in _COLUMNS for b in _COLUMNS)
    ),
    "stats_descriptive_decimal": " UNION ALL ".join([
        *[_measure_sql(c, "lineitem", digits=9) for c in _COLUMNS], _measure_sql("l_tax", "lineitem", "tax_7", 9),
        _measure_sql("l_discount", "lineitem", "alone", 9),
    ]),
}
