"""Feature groups, feature joins, SQL, inserts, upserts and training datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.types import primary_key_violations, record_schema
from millrace.operators.upsert import latest_by_key
from millrace.queries.common import NO_STATS, SPEND, URGENT, customer_store, new_store, source, table


def _cached(spark, sf_dir, name, **options):
    store = new_store(spark)
    store.create_featuregroup(table(spark, sf_dir, name), name, **NO_STATS, **options)
    return store


def fg_scan(spark, sf_dir):
    return _cached(spark, sf_dir, "customer", primary_key=["c_custkey"]).get_featuregroup("customer")


def fg_feature(spark, sf_dir):
    return customer_store(spark, sf_dir).get_feature("c_acctbal")


def fg_features_join(spark, sf_dir):
    return customer_store(spark, sf_dir).get_features(
        ["c_custkey", "c_acctbal", "order_total"], featuregroups_version_dict={"customer": 1, "spend": 1}
    )


def fg_features_join_key(spark, sf_dir):
    store = new_store(spark)
    lineitem = source(sf_dir, "lineitem")
    store.create_on_demand_featuregroup(
        f"SELECT l_suppkey, l_linenumber, sum(l_quantity) AS quantity FROM {lineitem} GROUP BY ALL", "volume")
    store.create_on_demand_featuregroup(
        f"SELECT l_suppkey, l_linenumber, max(l_discount) AS top_discount FROM {lineitem} GROUP BY ALL", "discounts")
    return store.get_features(
        ["l_suppkey", "l_linenumber", "quantity", "top_discount"], join_key=["l_suppkey", "l_linenumber"]
    )


def fg_features_qualified(spark, sf_dir):
    return customer_store(spark, sf_dir).get_features(["customer_1.c_name", "spend_1.order_count"])


def fg_features_nway(spark, sf_dir):
    return customer_store(spark, sf_dir).get_features(
        ["c_custkey", "c_mktsegment", "order_total", "urgent_count", "urgent_max"], join_key="c_custkey", how="left"
    )


def fg_features_bucketed(spark, sf_dir):
    """Groups bucketed by their key: the join itself shuffles nothing."""
    store = new_store(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, rows in (
        ("customer", table(spark, sf_dir, "customer")),
        ("spend", spark.sql(SPEND.format(orders=source(sf_dir, "orders")))),
    ):
        store.create_featuregroup(rows, name, primary_key=["c_custkey"], buckets=buckets, **NO_STATS)
    return store.get_features(["c_custkey", "c_acctbal", "order_count"], join_key="c_custkey")


def fg_sql_join(spark, sf_dir):
    store = customer_store(spark, sf_dir)
    store.create_on_demand_featuregroup(f"SELECT * FROM {source(sf_dir, 'orders')}", "orders")
    return store.sql(
        "SELECT c_name, o_orderkey, o_totalprice FROM customer_1 JOIN orders_1 ON o_custkey = c_custkey"
    )


def fg_sql_filter(spark, sf_dir):
    return customer_store(spark, sf_dir).sql(
        "SELECT c_custkey, c_acctbal FROM customer_1 WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'"
    )


def fg_on_demand(spark, sf_dir):
    store = new_store(spark)
    store.create_on_demand_featuregroup(
        f"SELECT * FROM {source(sf_dir, 'part')} WHERE p_size > 25", "large_parts"
    )
    return store.get_featuregroup("large_parts")


def fg_rename(spark, sf_dir):
    store = _cached(spark, sf_dir, "supplier")
    renamed = store.get_featuregroup("supplier").withColumnsRenamed(
        {"s_suppkey": "proveedor_id", "s_name": "nombre", "s_acctbal": "saldo"}
    )
    store.create_featuregroup(renamed, "proveedores", **NO_STATS)
    return store.get_featuregroup("proveedores")


def fg_append(spark, sf_dir):
    store = _cached(spark, sf_dir, "supplier")
    more = table(spark, sf_dir, "supplier").withColumn("s_acctbal", F.round(F.col("s_acctbal") + 1, 2))
    store.insert_into_featuregroup(more, "supplier")
    store.insert_into_featuregroup(more, "supplier", featuregroup_version=1)
    return store.get_featuregroup("supplier")


def fg_overwrite(spark, sf_dir):
    store = _cached(spark, sf_dir, "supplier")
    negated = store.get_featuregroup("supplier").withColumn("s_acctbal", -F.col("s_acctbal"))
    store.insert_into_featuregroup(negated, "supplier", mode="overwrite")
    return store.get_featuregroup("supplier")


def _versions(spark, sf_dir):
    store = _cached(spark, sf_dir, "part")
    store.create_featuregroup(
        table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size") * 2), "part", featuregroup_version=2,
        **NO_STATS,
    )
    return store


def fg_versions(spark, sf_dir):
    store = _versions(spark, sf_dir)
    parts = [
        store.get_featuregroup("part", featuregroup_version=v).select("p_partkey", "p_size", F.lit(v).alias("version"))
        for v in (1, 2)
    ]
    return parts[0].unionByName(parts[1])


def fg_latest_version(spark, sf_dir):
    store = _versions(spark, sf_dir)
    latest = store.get_latest_featuregroup_version("part")
    unknown = store.get_latest_featuregroup_version("no_such_group")
    return store.get_featuregroup("part", featuregroup_version=latest).agg(
        F.lit(latest).alias("latest"), F.lit(unknown).alias("unknown"), F.sum("p_size").alias("total_size")
    )


def fg_listing(spark, sf_dir):
    """Groups of a store with their row counts."""
    store = customer_store(spark, sf_dir)
    counts = [
        store.sql(f"SELECT '{g}' AS featuregroup, count(*) AS n_rows FROM `{g}`") for g in store.get_featuregroups()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def fg_feature_list(spark, sf_dir):
    """Features of a store with their number of values, one scan per group."""
    store = customer_store(spark, sf_dir)
    frames = []
    for group in store.get_featuregroups():
        df = store.sql(f"SELECT * FROM `{group}`")
        wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
        frames.append(wide.unpivot([], df.columns, "feature", "n_values").withColumn("featuregroup", F.lit(group)))
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).select("featuregroup", "feature", "n_values")


def fg_tags(spark, sf_dir):
    """Tags with values taken from the data, one of them removed again."""
    store = _cached(spark, sf_dir, "orders")
    df = store.get_featuregroup("orders")
    facts = df.agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("last"),
                   F.countDistinct("o_orderpriority").alias("priorities")).first().asDict()
    store.add_metadata("orders", {k: str(v) for k, v in facts.items()} | {"draft": "yes"})
    store.remove_metadata("orders", ["draft"])
    return spark.createDataFrame(sorted(store.get_metadata("orders").items()), "tag string, tag_value string")


def fg_partition_pruned(spark, sf_dir):
    store = _cached(spark, sf_dir, "customer", primary_key=["c_custkey"], partition_by=["c_mktsegment"])
    return store.get_featuregroup("customer").filter(F.col("c_mktsegment") == "MACHINERY").select(
        "c_custkey", "c_acctbal", "c_mktsegment"
    )


def fg_online_upsert(spark, sf_dir):
    """Every order changes the balance of its customer; the newest change counts."""
    changes = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select("c_custkey", "c_name", "c_nationkey", F.col("o_totalprice").alias("c_acctbal"), "c_mktsegment", "o_orderkey")
    store = _cached(spark, sf_dir, "customer", primary_key=["c_custkey"])
    store.upsert_into_featuregroup(changes, "customer", order="o_orderkey")
    return store.get_featuregroup("customer")


def _last_orders(spark, sf_dir):
    """The newest order of each customer in an online copy, from batches of which each has late changes."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    batches = [orders.filter(F.col("o_orderkey") % 3 == part) for part in (1, 2, 0)]
    store = new_store(spark)
    first = latest_by_key(batches[0], ["o_custkey"], "o_orderkey")
    store.create_featuregroup(first, "last_order", primary_key=["o_custkey"], **NO_STATS)
    store.enable_featuregroup_online("last_order", order="o_orderkey", buckets=16)
    for batch in batches[1:]:
        store.upsert_into_featuregroup(batch, "last_order", order="o_orderkey")
    return store


def fg_online_upsert_late(spark, sf_dir):
    return _last_orders(spark, sf_dir).get_featuregroup("last_order", online=True)


def fg_online_lookup(spark, sf_dir):
    """Online rows of the customers of one segment, some of whom have no order."""
    wanted = table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return _last_orders(spark, sf_dir).get_online_features(wanted, "last_order")


def fg_primary_key_check(spark, sf_dir):
    return primary_key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumnRenamed(
        "rows", "n_rows"
    )


def _dataset(data_format):
    def run(spark, sf_dir):
        store = new_store(spark)
        store.create_training_dataset(table(spark, sf_dir, "part"), "parts", data_format=data_format)
        return store.get_training_dataset("parts")

    return run


def td_csv_texts(spark, sf_dir):
    """Whole texts with line ends and quotes, in csv files that are read by splits."""
    store = new_store(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    store.create_training_dataset(documents, "texts", data_format="csv")
    return store.get_training_dataset("texts")


def td_overwrite(spark, sf_dir):
    """An insert replaces the rows, here with rows computed from the dataset itself."""
    store = new_store(spark)
    store.create_training_dataset(table(spark, sf_dir, "part"), "parts", data_format="parquet")
    doubled = store.get_training_dataset("parts").withColumn("p_size", F.col("p_size") * 2)
    store.insert_into_training_dataset(doubled, "parts")
    return store.get_training_dataset("parts")


_LINE_NUMBERS = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def td_npy(spark, sf_dir):
    store = new_store(spark)
    store.create_training_dataset(table(spark, sf_dir, "lineitem").select(*_LINE_NUMBERS), "lines", data_format="npy")
    return store.get_training_dataset("lines")


def td_tfrecord(spark, sf_dir):
    """Record files keep reals in single precision."""
    store = new_store(spark)
    store.create_training_dataset(table(spark, sf_dir, "lineitem").select(*_LINE_NUMBERS, "l_returnflag"), "lines")
    return store.get_training_dataset("lines").withColumns(
        {c: F.round(c, 2) for c in ("l_quantity", "l_extendedprice")}
    )


def tf_schema(spark, sf_dir):
    schema = record_schema(table(spark, sf_dir, "embeddings"))
    rows = [(n, f["feature"], str(f["shape"]), f["type"]) for n, f in schema.items()]
    return spark.createDataFrame(rows, "feature string, kind string, shape string, element string")


QUERIES = {
    "fg_features_join": fg_features_join,
    "fg_scan": fg_scan,
    "fg_feature": fg_feature,
    "fg_features_join_key": fg_features_join_key,
    "fg_features_qualified": fg_features_qualified,
    "fg_features_nway": fg_features_nway,
    "fg_features_bucketed": fg_features_bucketed,
    "fg_sql_join": fg_sql_join,
    "fg_sql_filter": fg_sql_filter,
    "fg_on_demand": fg_on_demand,
    "fg_rename": fg_rename,
    "fg_append": fg_append,
    "fg_overwrite": fg_overwrite,
    "fg_versions": fg_versions,
    "fg_latest_version": fg_latest_version,
    "fg_listing": fg_listing,
    "fg_feature_list": fg_feature_list,
    "fg_tags": fg_tags,
    "fg_partition_pruned": fg_partition_pruned,
    "fg_online_upsert": fg_online_upsert,
    "fg_online_upsert_late": fg_online_upsert_late,
    "fg_online_lookup": fg_online_lookup,
    "fg_primary_key_check": fg_primary_key_check,
    "td_csv": _dataset("csv"),
    "td_csv_texts": td_csv_texts,
    "td_tsv": _dataset("tsv"),
    "td_json": _dataset("json"),
    "td_parquet": _dataset("parquet"),
    "td_orc": _dataset("orc"),
    "td_petastorm": _dataset("petastorm"),
    "td_overwrite": td_overwrite,
    "td_npy": td_npy,
    "td_tfrecord": td_tfrecord,
    "tf_schema": tf_schema,
}

_SPEND = "(" + SPEND.format(orders="orders") + ")"
_URGENT = "(" + URGENT.format(orders="orders") + ")"

_LAST_ORDERS = (
    "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice, "
    "arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders {where}GROUP BY o_custkey"
)

SQL = {
    "fg_online_upsert_late": _LAST_ORDERS.format(where=""),
    "fg_online_lookup": _LAST_ORDERS.format(
        where="WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') "
    ),
    "fg_features_join": f"SELECT c_custkey, c_acctbal, order_total FROM customer JOIN {_SPEND} s USING (c_custkey)",
    "fg_scan": "SELECT * FROM customer",
    "fg_feature": "SELECT c_acctbal FROM customer",
    "fg_features_join_key": (
        "SELECT l_suppkey, l_linenumber, sum(l_quantity) AS quantity, max(l_discount) AS top_discount "
        "FROM lineitem GROUP BY l_suppkey, l_linenumber"
    ),
    "fg_features_qualified": f"SELECT c_name, order_count FROM customer JOIN {_SPEND} s USING (c_custkey)",
    "fg_features_nway": (
        f"SELECT c_custkey, c_mktsegment, order_total, urgent_count, urgent_max FROM customer "
        f"LEFT JOIN {_SPEND} s USING (c_custkey) LEFT JOIN {_URGENT} u USING (c_custkey)"
    ),
    "fg_features_bucketed": f"SELECT c_custkey, c_acctbal, order_count FROM customer JOIN {_SPEND} s USING (c_custkey)",
    "fg_sql_join": "SELECT c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON o_custkey = c_custkey",
    "fg_sql_filter": (
        "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000 AND c_mktsegment = 'BUILDING'"
    ),
    "fg_on_demand": "SELECT * FROM part WHERE p_size > 25",
    "fg_rename": (
        "SELECT s_suppkey AS proveedor_id, s_name AS nombre, s_nationkey, s_acctbal AS saldo FROM supplier"
    ),
    "fg_append": (
        "SELECT * FROM supplier UNION ALL "
        "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal + 1, 2) FROM supplier UNION ALL "
        "SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal + 1, 2) FROM supplier"
    ),
    "fg_overwrite": "SELECT s_suppkey, s_name, s_nationkey, -s_acctbal AS s_acctbal FROM supplier",
    "fg_versions": (
        "SELECT p_partkey, p_size, 1 AS version FROM part UNION ALL SELECT p_partkey, p_size * 2, 2 FROM part"
    ),
    "fg_latest_version": (
        "SELECT 2 AS latest, 0 AS unknown, CAST(sum(p_size * 2) AS BIGINT) AS total_size FROM part"
    ),
    "fg_listing": (
        "SELECT 'customer_1' AS featuregroup, count(*) AS n_rows FROM customer UNION ALL "
        f"SELECT 'spend_1', count(*) FROM {_SPEND} s UNION ALL SELECT 'urgent_1', count(*) FROM {_URGENT} u"
    ),
    "fg_feature_list": " UNION ALL ".join(
        [f"SELECT 'customer_1' AS featuregroup, '{c}' AS feature, count({c}) AS n_values FROM customer"
         for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
        + [f"SELECT 'spend_1', '{c}', count({c}) FROM {_SPEND} s"
           for c in ("c_custkey", "order_count", "order_total")]
        + [f"SELECT 'urgent_1', '{c}', count({c}) FROM {_URGENT} u"
           for c in ("c_custkey", "urgent_count", "urgent_max")]
    ),
    "fg_tags": (
        "SELECT 'rows' AS tag, CAST(count(*) AS VARCHAR) AS tag_value FROM orders UNION ALL "
        "SELECT 'last', CAST(max(o_orderkey) AS VARCHAR) FROM orders UNION ALL "
        "SELECT 'priorities', CAST(count(DISTINCT o_orderpriority) AS VARCHAR) FROM orders"
    ),
    "fg_partition_pruned": "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'",
    "fg_online_upsert": (
        "SELECT c_custkey, c_name, c_nationkey, coalesce(o_totalprice, c_acctbal) AS c_acctbal, c_mktsegment "
        "FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders "
        "GROUP BY o_custkey) o ON o_custkey = c_custkey"
    ),
    "fg_primary_key_check": (
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber "
        "HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL"
    ),
    **{f"td_{f}": "SELECT * FROM part" for f in ("csv", "tsv", "json", "parquet", "orc", "petastorm")},
    "td_csv_texts": "SELECT doc_id, text, lang, n_chars FROM documents",
    "td_overwrite": "SELECT p_partkey, p_name, p_brand, p_type, p_size * 2 AS p_size, p_retailprice FROM part",
    "td_npy": "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
    "td_tfrecord": (
        "SELECT l_orderkey, l_linenumber, round(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE), 2) AS l_quantity, "
        "round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 2) AS l_extendedprice, l_returnflag FROM lineitem"
    ),
    "tf_schema": (
        "SELECT 'vec_id' AS feature, 'fixed_len' AS kind, '[]' AS shape, 'int64' AS element UNION ALL "
        "SELECT 'embedding', CASE WHEN min(len(embedding)) = max(len(embedding)) THEN 'fixed_len' ELSE 'var_len' END, "
        "CASE WHEN min(len(embedding)) = max(len(embedding)) THEN '[' || max(len(embedding)) || ']' ELSE 'None' END, "
        "'float32' FROM embeddings UNION ALL SELECT 'label', 'fixed_len', '[]', 'int64'"
    ),
}
