"""Scalar operators over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.queries.common import table


def path_normalise(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.strip_scheme("url").alias("path"))


def path_expand(spark, sf_dir):
    """Absolute paths, relative ones and ones with the scheme become URIs."""
    orders = table(spark, sf_dir, "orders")
    path = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("/Projects/demo/"), "o_orderkey"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("hdfs://host:8020/data/"), "o_orderkey"))
        .otherwise(F.concat(F.lit("Resources/"), "o_orderkey"))
    )
    return orders.select("o_orderkey", S.expand_path(path, "hdfs://host:8020", "/Projects/demo").alias("uri"))


def duration_text(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    millis = S.duration_ms(F.col("value") * 1000)
    return events.select("event_id", millis.alias("millis"), S.duration_text(millis).alias("duration"))


def connector_args(spark, sf_dir):
    arguments = F.concat(F.lit("user="), "c_name", F.lit(",segment="), "c_mktsegment", F.lit(",note=a=b"))
    parsed = table(spark, sf_dir, "customer").select("c_custkey", S.parse_arguments(arguments).alias("m"))
    return parsed.select("c_custkey", F.col("m")["user"].alias("user_name"), F.col("m")["segment"].alias("segment"),
                         F.col("m")["note"].alias("note"))


def jdbc_url_parse(spark, sf_dir):
    url = F.concat(F.lit("jdbc:redshift://c"), "s_suppkey", F.lit(".abc.region-"), "s_nationkey",
                   F.lit(".example.com:5439/db"), "s_nationkey", F.lit("?user=u"), "s_suppkey", F.lit("&ssl=true"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", S.redshift_parts(url).alias("p")).select(
        "s_suppkey", "p.region", "p.cluster", "p.database", F.col("p.user").alias("user_name")
    )


def metric_cast(spark, sf_dir):
    """Numbers in text, among words."""
    raw = F.when(F.col("event_type") == "click", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))).when(
        F.col("event_type") == "error", "failed"
    ).otherwise(F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", S.to_metric(raw).alias("metric"))


def outputs_decode(spark, sf_dir):
    """Stored outputs: an object, or a bare number that becomes the metric."""
    stored = F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).otherwise(F.col("props"))
    decoded = table(spark, sf_dir, "events").select("event_id", S.decode_outputs(stored).alias("m"))
    return decoded.select("event_id", F.col("m")["metric"].alias("metric"), F.col("m")["k"].alias("k"))


def run_metric(spark, sf_dir):
    """The metric of a run is taken from exactly {metric, log}."""
    value = F.col("value").cast("string")
    outputs = F.when(
        F.col("event_type") == "click", F.create_map(F.lit("metric"), value, F.lit("log"), F.lit("out.log"))
    ).otherwise(F.create_map(F.lit("metric"), value))
    events = table(spark, sf_dir, "events").withColumn("outputs", outputs)
    return events.select("event_id", S.run_metric("outputs").cast("double").alias("implicit"),
                         S.run_metric("outputs", "metric").cast("double").alias("named"))


def invalid_metrics(spark, sf_dir):
    metrics = F.create_map(F.lit("price"), F.col("o_totalprice").cast("string"), F.lit("status"), F.col("o_orderstatus"))
    checked = table(spark, sf_dir, "orders").select("o_orderkey", S.invalid_metrics(metrics).alias("bad"))
    return checked.select("o_orderkey", F.concat_ws(",", "bad").alias("bad"))


def names_derive(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select(
        "p_partkey",
        S.index_name("p_brand", "p_type").alias("index_name"),
        S.versioned_name("p_type", "p_size").alias("versioned"),
        S.project_of(F.concat("p_type", F.lit("__"), "p_name")).alias("project"),
        S.is_valid_name("p_name").cast("int").alias("valid_name"),
        S.is_valid_name("p_type").cast("int").alias("valid_type"),
    )


def iso_timestamps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", S.ISO_FORMAT)
    return orders.select("o_orderkey", F.unix_timestamp(S.iso_timestamp(text)).alias("seconds"))


def genes(spark, sf_dir):
    """Bounds, rounding and donor arithmetic; halves go to the even number."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber",
        S.clamp(F.col("l_quantity") - 10, 0, 30).alias("clamped"),
        S.clamp_whole(F.col("l_quantity") / 2, 2, 20).alias("whole"),
        F.round(S.donor(F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"), 0.5), 6).alias("donor"),
        S.crossover(F.col("l_discount") * 10, 0.7, F.lit(1), F.lit(0)).alias("crossed"),
        S.category(["low", "high"], (F.col("l_quantity") > 25).cast("int")).alias("gene"),
    )


QUERIES = {
    "path_normalise": path_normalise,
    "path_expand": path_expand,
    "duration_text": duration_text,
    "connector_args": connector_args,
    "jdbc_url_parse": jdbc_url_parse,
    "metric_cast": metric_cast,
    "outputs_decode": outputs_decode,
    "run_metric": run_metric,
    "invalid_metrics": invalid_metrics,
    "names_derive": names_derive,
    "iso_timestamps": iso_timestamps,
    "genes": genes,
}

SQL = {
    "path_normalise": (
        "SELECT page_id, regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*', '') AS path FROM pages"
    ),
    "path_expand": (
        "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'hdfs://host:8020/Projects/demo/' || o_orderkey "
        "WHEN 'O' THEN 'hdfs://host:8020/data/' || o_orderkey "
        "ELSE 'hdfs://host:8020/Projects/demo/Resources/' || o_orderkey END AS uri FROM orders"
    ),
    "duration_text": (
        "SELECT event_id, ms AS millis, CAST((ms // 3600000) % 24 AS VARCHAR) || ' hours, ' || "
        "CAST((ms // 60000) % 60 AS VARCHAR) || ' minutes, ' || CAST((ms // 1000) % 60 AS VARCHAR) || ' seconds' "
        "AS duration FROM (SELECT event_id, CAST(round_even(value * 1000 * 1000, 0) AS BIGINT) AS ms FROM events)"
    ),
    "connector_args": (
        "SELECT c_custkey, c_name AS user_name, c_mktsegment AS segment, 'a=b' AS note FROM customer"
    ),
    "jdbc_url_parse": (
        "SELECT s_suppkey, 'region-' || s_nationkey AS region, 'c' || s_suppkey AS cluster, "
        "'db' || s_nationkey AS database, 'u' || s_suppkey AS user_name FROM supplier"
    ),
    "metric_cast": (
        "SELECT event_id, CASE event_type WHEN 'click' THEN value WHEN 'error' THEN NULL "
        "ELSE CAST(event_id AS DOUBLE) END AS metric FROM events"
    ),
    "outputs_decode": (
        "SELECT event_id, CASE WHEN event_type = 'click' THEN CAST(event_id AS VARCHAR) END AS metric, "
        "CASE WHEN event_type <> 'click' THEN regexp_extract(props, '\"k\": ([0-9]+)', 1) END AS k FROM events"
    ),
    "run_metric": (
        "SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS implicit, value AS named FROM events"
    ),
    "invalid_metrics": "SELECT o_orderkey, 'status' AS bad FROM orders",
    "names_derive": (
        "SELECT p_partkey, lower(p_brand || '_' || p_type) AS index_name, p_type || '_' || p_size AS versioned, "
        "p_type AS project, CAST(regexp_full_match(p_name, '[a-zA-Z0-9]+') AS INTEGER) AS valid_name, "
        "CAST(regexp_full_match(p_type, '[a-zA-Z0-9]+') AS INTEGER) AS valid_type FROM part"
    ),
    "iso_timestamps": "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS seconds FROM orders",
    "genes": (
        "SELECT l_orderkey, l_linenumber, greatest(0.0::DOUBLE, least(30.0::DOUBLE, l_quantity - 10)) AS clamped, "
        "round_even(greatest(2.0::DOUBLE, least(20.0::DOUBLE, l_quantity / 2)), 0) AS whole, "
        "round(l_quantity + 0.5::DOUBLE * (l_tax - l_discount), 6) AS donor, "
        "CASE WHEN l_discount * 10 <= 0.7::DOUBLE THEN 1 ELSE 0 END AS crossed, "
        "CASE WHEN l_quantity > 25 THEN 'high' ELSE 'low' END AS gene FROM lineitem"
    ),
}
