"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Folders made for sessions that name none, by application id (local masters only).
_LOCAL_FOLDERS: dict[str, str] = {}


def get_spark(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Build or get a session. AQE, UTC and ANSI are on; everything else is left to the cluster.

    Partition counts are not fixed here: AQE coalesces small shuffle partitions and splits skewed
    ones, so a cluster sets ``spark.sql.shuffle.partitions`` high and tests set it low.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false" if (master or "").startswith("local") else "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, which the cluster sets.

    A local master may leave it unset and then gets a temporary folder. On a cluster an unset value
    is an error, because a machine-local folder would lose data with its machine.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or _LOCAL_FOLDERS.get(context.applicationId)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return "/".join([root.rstrip("/"), *parts])


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path below :func:`shared_dir` that no other caller uses. It is not created."""
    return shared_dir(spark, f"{label}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses for its scheme."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and host, as Spark resolves it: tasks outside the JVM then write where Spark reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return target.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists. Of several callers at a time one succeeds."""
    target = qualified(spark, path)
    if target.startswith("file:"):
        # Hadoop's local file system looks first and creates then; the operating system does both at once.
        plain = "/" + target.removeprefix("file:").lstrip("/")
        os.makedirs(os.path.dirname(plain), exist_ok=True)
        try:
            os.close(os.open(plain, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(target)
    try:
        file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file, False).close()
    except Py4JJavaError as error:
        if path_exists(spark, target):
            return False
        raise error
    return True
