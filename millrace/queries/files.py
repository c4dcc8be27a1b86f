"""Readers, writers and listings. Inputs are files that Spark first writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.queries.common import table
from millrace.session import fresh_dir
from millrace.sources import files as L
from millrace.sources import arrays, tables, text


def text_matrix(spark, sf_dir):
    """Lines of numbers with a trailing comment."""
    path = fresh_dir(spark, "matrix")
    table(spark, sf_dir, "lineitem").select(
        F.concat_ws(" ", "l_orderkey", "l_quantity", "l_extendedprice", F.lit("# line"), "l_linenumber")
    ).write.text(path)
    values = F.col("values")
    return text.read_matrix(spark, path).select(
        values[0].cast("long").alias("orderkey"), values[1].alias("quantity"), values[2].alias("price")
    )


def text_missing(spark, sf_dir):
    """Prices of open orders are missing, and some are no numbers."""
    path = fresh_dir(spark, "gaps")
    price = F.when(F.col("o_orderstatus") == "O", "").when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    table(spark, sf_dir, "orders").select(F.concat_ws(",", "o_orderkey", price)).write.text(path)
    values = F.col("values")
    return text.read_matrix_with_gaps(spark, path, delimiter=",").select(
        values[0].cast("long").alias("orderkey"), F.when(~F.isnan(values[1]), values[1]).alias("price")
    )


def text_skip_header(spark, sf_dir):
    """Three heading lines in every file."""
    path = fresh_dir(spark, "headed")
    bucket = F.floor(F.col("p_partkey") / 100000).alias("bucket")  # a bounded number of rows per file
    rows = table(spark, sf_dir, "part").select(F.concat_ws(";", "p_partkey", "p_size").alias("value"), bucket)
    heads = table(spark, sf_dir, "part").select(bucket).distinct().select(
        F.explode(F.array(F.lit("one;1"), F.lit("two;2"), F.lit("three;3"))).alias("value"), "bucket"
    )
    both = heads.withColumn("o", F.lit(0)).unionByName(rows.withColumn("o", F.lit(1)))
    both.repartition("bucket").sortWithinPartitions("bucket", "o").select("value", "bucket").write.partitionBy(
        "bucket"
    ).text(path)
    values = F.col("values")
    return text.read_matrix(spark, path, delimiter=";", skip_header=3).select(
        values[0].cast("long").alias("partkey"), values[1].cast("int").alias("size")
    )


def regex_reader(spark, sf_dir):
    """Fields out of log-like lines; other lines do not match."""
    path = fresh_dir(spark, "log")
    events = table(spark, sf_dir, "events")
    events.select(F.explode(F.array(
        F.concat(F.lit("[event "), "event_id", F.lit("] type="), "event_type", F.lit(" value="), "value"),
        F.concat(F.lit("noise "), "event_id"),
    ))).write.text(path)
    return text.read_regex(
        spark, path, r"\[event (\d+)\] type=(\w+) value=(\S+)", "event_id long, event_type string, value double"
    )


def binary_records(spark, sf_dir):
    """Fixed-width records."""
    path = fresh_dir(spark, "fixed")
    table(spark, sf_dir, "lineitem").select(F.concat(
        F.lpad("l_orderkey", 12, "0"), F.lpad("l_linenumber", 4, "0"), "l_returnflag"
    )).write.text(path)
    read = text.read_binary_records(spark, path, [("orderkey", "S12"), ("line", "S4"), ("flag", "S1"), ("end", "S1")])
    return read.select(F.col("orderkey").cast("long").alias("orderkey"), F.col("line").cast("int").alias("line"), "flag")


def npy_rows(spark, sf_dir):
    """Vectors as stacked arrays, read back element by element."""
    path = fresh_dir(spark, "npy")
    arrays.write_npy(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), path)
    rows = arrays.read_npy(spark, path).select(F.col("values")[0].cast("long").alias("vec_id"), F.posexplode("values"))
    return rows.where("pos > 0").select("vec_id", F.col("pos").alias("place"), F.col("col").alias("cell"))


def npz_arrays(spark, sf_dir):
    """One array per column; unnamed ones are numbered."""
    path = fresh_dir(spark, "npz")
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_linenumber", "l_discount")
    arrays.write_npz(rows, path, names=["l_quantity"], compressed=True)
    return arrays.read_npy(spark, path).groupBy("array_name").agg(
        F.count(F.lit(1)).alias("n_values"), F.round(F.sum(F.col("values")[0]), 2).alias("total")
    )


def npy_exact(spark, sf_dir):
    """Integers beyond 2 ** 53, missing booleans and reals in one file of typed records."""
    path = fresh_dir(spark, "npy")
    rows = table(spark, sf_dir, "lineitem").select(
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 2**38 + 1).alias("line_key"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R").alias("returned"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("later_line"), "l_extendedprice",
    )
    arrays.write_npy(rows, path, layout="records")
    return arrays.read_npy_table(spark, path, rows.schema)


def csv_roundtrip(spark, sf_dir):
    """Long multi-line texts with quotes survive."""
    path = fresh_dir(spark, "csv")
    documents = table(spark, sf_dir, "documents")
    tables.write_csv(documents.select("doc_id", "lang", "text"), path)
    return tables.read_csv(spark, path, schema="doc_id long, lang string, text string", usecols=["doc_id", "text"],
                           multi_line=True)


def json_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "json")
    tables.write_json(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), path)
    return tables.read_json(spark, path, schema="doc_id long, text string, source string")


def json_columns(spark, sf_dir):
    """One column-oriented object per ten thousand customers, regrouped to rows."""
    path = fresh_dir(spark, "jsoncols")
    customers = table(spark, sf_dir, "customer")
    label = F.col("c_custkey").cast("string")
    objects = customers.groupBy(F.floor(F.col("c_custkey") / 10000)).agg(F.to_json(F.struct(
        F.map_from_entries(F.collect_list(F.struct(label, "c_name"))).alias("name"),
        F.map_from_entries(F.collect_list(F.struct(label, F.col("c_acctbal").cast("string")))).alias("balance"),
    )).alias("value")).select("value")
    # A file of this layout holds one object, so each object gets its own.
    objects.repartition(F.xxhash64("value")).withColumn("part", F.sha2("value", 256)).write.partitionBy("part").text(path)
    return tables.read_json(spark, path, "columns", "name string, balance double").select(
        F.col("index").cast("long").alias("custkey"), "name", "balance"
    )


def text_dump(spark, sf_dir):
    path = fresh_dir(spark, "dump")
    tables.write_text(table(spark, sf_dir, "nation"), path, "n_name")
    return spark.read.text(path)


def whole_files(spark, sf_dir):
    """Characters of whole files of texts, by language and source; a line end follows each text."""
    path = fresh_dir(spark, "whole")
    documents = table(spark, sf_dir, "documents")
    documents.select(F.coalesce("text", F.lit("")).alias("value"), "lang", "source").write.partitionBy(
        "lang", "source"
    ).text(path)
    read = tables.read_whole(spark, path)
    place = F.regexp_extract("path", r"lang=([^/]*)/source=([^/]*)/", 1)
    source = F.regexp_extract("path", r"lang=([^/]*)/source=([^/]*)/", 2)
    return read.groupBy(place.alias("lang"), source.alias("source")).agg(F.sum(F.length("content")).alias("n_chars"))


def _tree(spark, sf_dir):
    """Customer names as text files, one folder per segment and nation."""
    path = fresh_dir(spark, "tree")
    rows = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment", "c_nationkey")
    rows.write.partitionBy("c_mktsegment", "c_nationkey").text(path)
    listed = L.relative_to(L.list_files(spark, path, recursive=True, pattern="part-*"), path)
    part = lambda name: F.regexp_extract("relative", name + "=([^/]*)/", 1)
    return listed.withColumns({"segment": part("c_mktsegment"), "nation": part("c_nationkey").cast("int")})


def file_listing(spark, sf_dir):
    """Folders of a written tree, with the bytes of their files."""
    return _tree(spark, sf_dir).groupBy("segment", "nation").agg(F.sum("length").alias("n_bytes"))


def file_totals(spark, sf_dir):
    """Size of a written tree, and of the part of it below one folder."""
    tree = _tree(spark, sf_dir)
    totals = [(name, L.total_size(part)) for name, part in (("all", tree), ("building", tree.filter("segment = 'BUILDING'")))]
    first, second = [rows.select(F.lit(name).alias("tree"), "bytes") for name, rows in totals]
    return first.unionByName(second)


def tree_attributes(spark, sf_dir):
    """Attributes of paths: set, set again and removed, for all folders of a written tree."""
    folders = _tree(spark, sf_dir).select("segment").distinct()
    attributes = folders.select(F.concat(F.lit("/tree/"), "segment").alias("path"), F.lit("owner").alias("name"), F.col("segment").alias("value"))
    attributes = L.set_attribute(attributes, "/tree/BUILDING", "owner", "nobody")
    attributes = L.set_attribute(attributes, "/tree/BUILDING", "checked", 1)
    return L.remove_attribute(attributes, "/tree/MACHINERY", "owner")


def tree_copies(spark, sf_dir):
    """Whether a tree has the same files as a copy, and as a part of it."""
    names = _tree(spark, sf_dir).select(F.concat_ws("/", "segment", "nation").alias("name"))
    rows = [("copy", L.same_tree(names, names)), ("part", L.same_tree(names, names.filter("NOT startswith(name, 'BUILDING')")))]
    return spark.createDataFrame(rows, "other string, same boolean")


def file_manifest_diff(spark, sf_dir):
    """The same table written twice, once with a further partition."""
    left, right = fresh_dir(spark, "left"), fresh_dir(spark, "right")
    rows = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    for path, kept in ((left, rows), (right, rows.filter("s_nationkey <> 3"))):
        kept.write.partitionBy("s_nationkey").text(path)

    def listing(root):
        files = L.relative_to(L.list_files(spark, root, recursive=True, pattern="part-*"), root)
        return files.withColumn("relative", F.regexp_extract("relative", r"^[^/]+", 0)).groupBy("relative").agg(
            F.sum("length").alias("length")
        )

    return L.compare_listings(listing(left), listing(right)).select("file", "status")


def provenance(spark, sf_dir):
    """Rows that were read from each table's files: folders count as the table."""
    read = L.provenance(
        table(spark, sf_dir, "lineitem").filter("l_quantity > 10").select("l_orderkey"), table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "documents").filter("doc_id % 2 = 1"),
    )
    name = F.regexp_extract("path", r"/(\w+)\.parquet(/[^/]*)?$", 1)
    return read.groupBy(name.alias("name")).agg(F.sum("rows").alias("n_rows"))


QUERIES = {
    "text_matrix": text_matrix,
    "text_missing": text_missing,
    "text_skip_header": text_skip_header,
    "regex_reader": regex_reader,
    "binary_records": binary_records,
    "npy_rows": npy_rows,
    "npz_arrays": npz_arrays,
    "npy_exact": npy_exact,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "json_columns": json_columns,
    "text_dump": text_dump,
    "whole_files": whole_files,
    "file_listing": file_listing,
    "file_totals": file_totals,
    "tree_attributes": tree_attributes,
    "tree_copies": tree_copies,
    "file_manifest_diff": file_manifest_diff,
    "provenance": provenance,
}

SQL = {
    "text_matrix": "SELECT l_orderkey AS orderkey, l_quantity AS quantity, l_extendedprice AS price FROM lineitem",
    "text_missing": (
        "SELECT o_orderkey AS orderkey, CASE WHEN o_orderstatus NOT IN ('O', 'P') THEN o_totalprice END AS price FROM orders"
    ),
    "text_skip_header": "SELECT p_partkey AS partkey, p_size AS size FROM part",
    "regex_reader": "SELECT event_id, event_type, value FROM events",
    "binary_records": "SELECT l_orderkey AS orderkey, l_linenumber AS line, l_returnflag AS flag FROM lineitem",
    "npy_rows": (
        "SELECT vec_id, CAST(unnest(range(1, len(embedding) + 1)) AS INTEGER) AS place, "
        "CAST(unnest(embedding) AS DOUBLE) AS cell FROM embeddings"
    ),
    "npy_exact": (
        "SELECT (l_orderkey * 8 + l_linenumber) * 274877906944 + 1 AS line_key, "
        "CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS returned, "
        "CASE WHEN l_linenumber > 1 THEN l_linenumber END AS later_line, l_extendedprice FROM lineitem"
    ),
    "npz_arrays": (
        "SELECT 'l_quantity' AS array_name, count(*) AS n_values, round(sum(l_quantity), 2) AS total FROM lineitem "
        "UNION ALL SELECT 'arr_0', count(*), CAST(sum(l_linenumber) AS DOUBLE) FROM lineitem "
        "UNION ALL SELECT 'arr_1', count(*), round(sum(l_discount), 2) FROM lineitem"
    ),
    "csv_roundtrip": "SELECT doc_id, text FROM documents",
    "json_roundtrip": "SELECT doc_id, text, source FROM documents",
    "json_columns": "SELECT c_custkey AS custkey, c_name AS name, c_acctbal AS balance FROM customer",
    "text_dump": "SELECT n_name AS value FROM nation",
    "whole_files": "SELECT lang, source, CAST(sum(length(coalesce(text, '')) + 1) AS BIGINT) AS n_chars FROM documents GROUP BY lang, source",
    "file_listing": (
        "SELECT c_mktsegment AS segment, c_nationkey AS nation, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS n_bytes "
        "FROM customer GROUP BY ALL"
    ),
    "file_manifest_diff": (
        "SELECT DISTINCT 's_nationkey=' || s_nationkey AS file, "
        "CASE WHEN s_nationkey = 3 THEN 'only_left' ELSE 'same' END AS status FROM supplier"
    ),
    "provenance": (
        "SELECT 'lineitem' AS name, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem WHERE l_quantity > 10 UNION ALL "
        "SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'documents', count(*) FROM documents WHERE doc_id % 2 = 1"
    ),
    "file_totals": (
        "SELECT 'all' AS tree, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS bytes FROM customer UNION ALL "
        "SELECT 'building', CAST(sum(strlen(c_name) + 1) AS BIGINT) FROM customer WHERE c_mktsegment = 'BUILDING'"
    ),
    "tree_attributes": (
        "SELECT '/tree/' || c_mktsegment AS path, 'owner' AS name, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'nobody' ELSE c_mktsegment END AS value FROM customer "
        "WHERE c_mktsegment <> 'MACHINERY' GROUP BY ALL UNION ALL SELECT '/tree/BUILDING', 'checked', '1'"
    ),
    "tree_copies": "SELECT 'copy' AS other, true AS same UNION ALL SELECT 'part', false",
}
