"""File listings as frames, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import strip_scheme


def _plain_path(path):
    """Paths as the file system prints them: not URL-encoded, local ones with a single slash."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _all_paths(frame: DataFrame) -> DataFrame:
    """Paths of all files of a frame, as its file index on the driver has them."""
    paths = frame.sparkSession.createDataFrame([(p,) for p in frame.inputFiles()], "value string")
    decoded = F.url_decode(F.replace(F.col("value"), F.lit("+"), F.lit("%2B")))
    return paths.select(_plain_path(decoded).alias("path"))


def list_files(
    spark: SparkSession, path: str, recursive: bool = False, pattern: str | None = None, include_empty: bool = True
) -> DataFrame:
    """Files as (path, name, length, modified). Contents are not read.

    ``pattern`` is a glob over file names. Scans leave out empty files; ``include_empty`` adds them
    with length 0 and no modification time, from the file index that the driver holds anyway.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    frame = reader.load(path)
    known = frame.select(
        _plain_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified")
    )
    if include_empty:
        known = _all_paths(frame).join(known, "path", "left")
    return known.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.coalesce("length", F.lit(0).cast("long")).alias("length"),
        "modified",
    )


def total_size(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def relative_to(files: DataFrame, root: str) -> DataFrame:
    """Listing with ``relative`` paths below the root."""
    plain = strip_scheme(F.regexp_replace("path", "^file:/", "/"))
    base = root.split("://", 1)[-1].rstrip("/")
    return files.withColumn("relative", F.regexp_replace(plain, f"^.*?\\Q{base}\\E/", ""))


def compare_listings(left: DataFrame, right: DataFrame, on: str = "relative") -> DataFrame:
    """Files of either tree as (name, status): same, resized, only_left or only_right."""
    a = left.select(F.col(on).alias("file"), F.col("length").alias("left_length"))
    b = right.select(F.col(on).alias("file"), F.col("length").alias("right_length"))
    status = (
        F.when(F.col("right_length").isNull(), "only_left")
        .when(F.col("left_length").isNull(), "only_right")
        .when(F.col("left_length") == F.col("right_length"), "same")
        .otherwise("resized")
    )
    return a.join(b, "file", "full_outer").select("file", "left_length", "right_length", status.alias("status"))


def same_tree(left: DataFrame, right: DataFrame) -> bool:
    """Whether two listings have the same base names, each as often."""
    a, b = left.select("name"), right.select("name")
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def provenance(*frames: DataFrame) -> DataFrame:
    """(path, length, modified, rows): the input files that the rows of the frames come from.

    The files are told by the rows themselves, which tasks count per file: a file all of whose rows
    are filtered out is none. Each frame must be a scan of files, filtered and projected at will.
    """
    where = ("file_path", "file_size", "file_modification_time")
    counted = [
        frame.select(*[F.col(f"_metadata.{name}") for name in where]).groupBy(*where).agg(F.count(F.lit(1)).alias("rows"))
        for frame in frames
    ]
    listed = counted[0]
    for more in counted[1:]:
        listed = listed.unionByName(more)
    path = _plain_path(F.url_decode(F.replace(F.col("file_path"), F.lit("+"), F.lit("%2B"))))
    return listed.groupBy(path.alias("path")).agg(
        F.max("file_size").alias("length"), F.max("file_modification_time").alias("modified"), F.sum("rows").alias("rows")
    )


# Attributes of paths ----------------------------------------------------------------------------

def set_attribute(attributes: DataFrame, path: str, name: str, value) -> DataFrame:
    """Attribute table (path, name, value) with one entry set; values are kept as text."""
    entry = attributes.sparkSession.createDataFrame([(path, name, str(value))], "path string, name string, value string")
    return remove_attribute(attributes, path, name).unionByName(entry)


def remove_attribute(attributes: DataFrame, path: str, name: str) -> DataFrame:
    return attributes.filter(~((F.col("path") == path) & (F.col("name") == name)))


def get_attributes(attributes: DataFrame, path: str, name: str | None = None) -> dict[str, str]:
    """Attributes of one path, which are few."""
    found = attributes.filter(F.col("path") == path)
    if name is not None:
        found = found.filter(F.col("name") == name)
    return {r.name: r.value for r in found.collect()}
