"""Options of external connectors. Formats that need a jar are checked before use."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import REDSHIFT_PATTERN, REDSHIFT_USER_PATTERN
from millrace.functions.types import row_store_type

# --- fixed values: option names of the connectors -----------------------------------------------
SECURITY_PROTOCOL = "SSL"
ELASTICSEARCH_FORMAT = "org.elasticsearch.spark.sql"
S3_PREFIX = "s3a://"
S3_TRAINING_FOLDER = "TRAINING_DATASETS"
S3_ACCESS_KEY = "fs.s3a.access.key"
S3_SECRET_KEY = "fs.s3a.secret.key"
S3_SESSION_TOKEN = "fs.s3a.session.token"
S3_PROVIDER = "fs.s3a.aws.credentials.provider"
S3_TEMPORARY_PROVIDER = "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"
# ------------------------------------------------------------------------------------------------

_CLASSES = {
    "kafka": "org.apache.spark.sql.kafka010.KafkaSourceProvider",
    "avro": "org.apache.spark.sql.avro.AvroDataToCatalyst",
    ELASTICSEARCH_FORMAT: "org.elasticsearch.spark.sql.DefaultSource",
}


def has_format(spark: SparkSession, name: str) -> bool:
    """Whether the classes of a data source are on the class path."""
    jvm = spark.sparkContext._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        jvm.java.lang.Class.forName(_CLASSES[name], False, loader)
        return True
    except Exception:
        return False


def require_format(spark: SparkSession, name: str) -> None:
    if not has_format(spark, name):
        raise RuntimeError(f"the {name} data source is not on the class path: start Spark with its package")


# Kafka ------------------------------------------------------------------------------------------

def broker_list(servers: str) -> list[str]:
    """Broker addresses of a comma-separated list, listener prefix removed."""
    return [s.strip().replace("INTERNAL://", "") for s in servers.split(",") if s.strip()]


def kafka_options(servers: str, topic: str, truststore: str | None = None, truststore_password: str | None = None,
                  keystore: str | None = None, keystore_password: str | None = None,
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": ",".join(broker_list(servers)),
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    ssl = {
        "kafka.ssl.truststore.location": truststore, "kafka.ssl.truststore.password": truststore_password,
        "kafka.ssl.keystore.location": keystore, "kafka.ssl.keystore.password": keystore_password,
    }
    if any(ssl.values()):
        options["kafka.security.protocol"] = SECURITY_PROTOCOL
        options.update({k: v for k, v in ssl.items() if v})
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, options: Mapping[str, str], stream: bool = True) -> DataFrame:
    require_format(spark, "kafka")
    return (spark.readStream if stream else spark.read).format("kafka").options(**options).load()


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Rows with ``key`` and ``value`` to a topic; a streaming frame needs a checkpoint folder."""
    require_format(df.sparkSession, "kafka")
    options = {"kafka.bootstrap.servers": ",".join(broker_list(servers)), "topic": topic}
    rows = df.select(F.col("key").cast("string"), F.col("value"))
    if df.isStreaming:
        return rows.writeStream.format("kafka").options(**options, checkpointLocation=checkpoint).start()
    return rows.write.format("kafka").options(**options).save()


# Elasticsearch ----------------------------------------------------------------------------------

def elasticsearch_index(project: str, index: str) -> str:
    return f"{project}_{index}".lower()


def elasticsearch_options(nodes: str, project: str, index: str, keystore: str, keystore_password: str,
                          truststore: str, truststore_password: str, authorization: str) -> dict[str, str]:
    return {
        "es.nodes": nodes,
        "es.nodes.wan.only": "true",
        "es.net.ssl": "true",
        "es.net.ssl.keystore.location": keystore,
        "es.net.ssl.keystore.pass": keystore_password,
        "es.net.ssl.truststore.location": truststore,
        "es.net.ssl.truststore.pass": truststore_password,
        "es.net.http.header.Authorization": authorization,
        "es.resource": elasticsearch_index(project, index),
    }


def read_elasticsearch(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    require_format(spark, ELASTICSEARCH_FORMAT)
    return spark.read.format(ELASTICSEARCH_FORMAT).options(**options).load()


def write_elasticsearch(df: DataFrame, options: Mapping[str, str], mode: str = "append") -> None:
    require_format(df.sparkSession, ELASTICSEARCH_FORMAT)
    df.write.format(ELASTICSEARCH_FORMAT).options(**options).mode(mode).save()


# JDBC -------------------------------------------------------------------------------------------

def jdbc_options(url: str, arguments: str = "", **extra: str) -> dict[str, str]:
    """Options of a connector: its connection string and ``k=v`` arguments, ``,`` or ``;`` separated."""
    pairs = (p.split("=", 1) for p in re.split("[,;]", arguments) if "=" in p)
    return {"url": url, **{k.strip(): v for k, v in pairs}, **extra}


def redshift_url_parts(url: str) -> tuple[str, str, str, str]:
    """(region, cluster, database, user) of a Redshift JDBC URL."""
    found = re.match(REDSHIFT_PATTERN, url)
    if not found:
        raise ValueError(f"not a Redshift JDBC URL: {url}")
    user = re.search(REDSHIFT_USER_PATTERN, url)
    if not user or not user[1]:
        raise ValueError(f"the URL names no user: {url}")
    cluster, _, region, database = found.groups()
    return region, cluster, database, user[1]


def read_jdbc(spark: SparkSession, options: Mapping[str, str], table: str, partition_column: str | None = None,
              bounds: tuple | None = None, partitions: int = 8) -> DataFrame:
    """A table, read by several tasks when a partition column and its bounds are given."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column:
        if bounds is None:
            dialect = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(options["url"])
            column = dialect.quoteIdentifier(partition_column)
            query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
            row = spark.read.format("jdbc").options(**options).option("dbtable", query).load().first()
            bounds = (row[0], row[1])
        if bounds[0] is not None:
            reader = reader.options(partitionColumn=partition_column, lowerBound=str(bounds[0]),
                                    upperBound=str(bounds[1]), numPartitions=str(partitions))
    return reader.load()


def write_jdbc(df: DataFrame, options: Mapping[str, str], table: str, mode: str = "append",
               mysql_types: bool = False, partitions: int | None = None) -> None:
    """Rows to a row store. ``mysql_types`` creates text columns with its types; Spark knows the others."""
    writer = (df.coalesce(partitions) if partitions else df).write.format("jdbc").options(**options)
    if mysql_types and (texts := row_store_texts(df.schema)):
        writer = writer.option("createTableColumnTypes", texts)
    writer.option("dbtable", table).mode(mode).save()


def row_store_texts(schema: T.StructType) -> str:
    """The text columns of :func:`row_store_columns`, the only types that Spark's option must name and can parse."""
    texts = [f for f in schema if isinstance(f.dataType, T.StringType)]
    return ", ".join(f"`{f.name}` {row_store_type(f.dataType)}" for f in texts)


def row_store_columns(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {row_store_type(f.dataType)}" for f in schema)


# S3 ---------------------------------------------------------------------------------------------

def s3_settings(access_key: str, secret_key: str, session_token: str | None = None) -> dict[str, str]:
    """Spark settings for ``s3a://`` paths."""
    settings = {S3_ACCESS_KEY: access_key, S3_SECRET_KEY: secret_key}
    if session_token:
        settings[S3_SESSION_TOKEN] = session_token
        settings[S3_PROVIDER] = S3_TEMPORARY_PROVIDER
    return {f"spark.hadoop.{k}": v for k, v in settings.items()}


def s3_training_path(bucket: str, name: str, version: int) -> str:
    bucket = bucket.removeprefix(S3_PREFIX).strip("/")
    return f"{S3_PREFIX}{bucket}/{S3_TRAINING_FOLDER}/{name}_{version}"
