"""Numbers and records out of text files and fixed-width binary files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, types as T
from pyspark.sql import functions as F

from millrace.functions.scalars import NUMBER_PATTERN

# --- fixed values -------------------------------------------------------------------------------
SPECIAL_NUMBERS = ("nan", "inf", "-inf", "infinity", "-infinity")
# ------------------------------------------------------------------------------------------------


def _lines(spark: SparkSession, path: str, comment: str | None, skip_header: int) -> DataFrame:
    lines = spark.read.text(path)
    if skip_header:
        lines = skip_first_lines(lines, skip_header)
    value = F.col("value")
    if comment:
        value = F.substring_index(value, comment, 1)
    return lines.select(F.trim(value).alias("value")).filter(F.length("value") > 0)


def skip_first_lines(lines: DataFrame, count: int) -> DataFrame:
    """Drop the first lines of every file of a ``spark.read.text`` frame, in whatever splits they lie.

    A task sees the lines of a split in order. Files of several splits have the lines of each
    counted, in one more pass over them; their sums tell in which splits heading lines are left.
    """
    located = lines.select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("cut"),
    )
    counted = located.filter("cut").groupBy("file", "start").count()
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("file", "start", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    # The few splits that still have heading lines.
    heads = F.broadcast(before.filter((F.col("start") > 0) & (F.col("before") < count)))
    found = F.when(F.col("start") == 0, F.lit(0)).otherwise(F.col("before")).cast("long")
    located = located.join(heads, ["file", "start"], "left").select("value", "file", "start", found.alias("before"))

    def drop(batches):
        import numpy as np
        import pyarrow as pa

        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = np.ones(batch.num_rows, dtype=bool)
            files, starts = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            heading = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            places = batch.column(3).fill_null(0).to_numpy()
            turns = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
            for low, high in zip([0, *turns], [*turns, len(files)]):
                if heading[low]:
                    split = (files[low], starts[low])
                    done = seen.get(split, places[low])
                    keep[low : min(high, low + max(0, count - done))] = False
                    seen[split] = done + high - low
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep))], names=["value"])

    return located.mapInArrow(drop, "value string")


def _tokens(delimiter: str | None):
    return F.split("value", r"\s+" if delimiter is None else f"\\s*\\Q{delimiter}\\E\\s*")


def _to_number(token):
    trimmed = F.trim(token)
    known = trimmed.rlike(NUMBER_PATTERN) | F.lower(trimmed).isin(*SPECIAL_NUMBERS)
    return F.when(known, trimmed.try_cast("double"))


def read_matrix(
    spark: SparkSession,
    path: str,
    delimiter: str | None = None,
    comment: str | None = "#",
    skip_header: int = 0,
    check: bool = True,
) -> DataFrame:
    """Numeric text as ``values array<double>``. Every row must have the same number of values.

    Text that is no number fails the job; a wrong row length is found by one small aggregate,
    which ``check=False`` leaves out.
    """
    def strict(token):
        message = F.concat(F.lit("could not convert text to a number: "), token)
        return F.coalesce(_to_number(token), F.raise_error(message).cast("double"))

    tokens = _lines(spark, path, comment, skip_header).select(_tokens(delimiter).alias("tokens"))
    if check:
        sizes = tokens.agg(F.min(F.size("tokens")).alias("low"), F.max(F.size("tokens")).alias("high")).first()
        if sizes.low != sizes.high:
            raise ValueError(f"rows have from {sizes.low} to {sizes.high} values")
    return tokens.select(F.transform("tokens", strict).alias("values"))


def read_matrix_with_gaps(
    spark: SparkSession,
    path: str,
    delimiter: str | None = None,
    comment: str | None = "#",
    skip_header: int = 0,
    filling: float = float("nan"),
) -> DataFrame:
    """As :func:`read_matrix`, but missing or malformed values become ``filling``."""
    tokens = _lines(spark, path, comment, skip_header).select(_tokens(delimiter).alias("tokens"))
    return tokens.select(
        F.transform("tokens", lambda t: F.coalesce(_to_number(t), F.lit(float(filling)))).alias("values")
    )


def read_regex(spark: SparkSession, path: str, pattern: str, schema: T.StructType | str, whole_files: bool = False) -> DataFrame:
    """One record per match, one field per group, cast to the schema. Other text is left out.

    Matches are looked for line by line, in splittable files; ``whole_files`` lets a match span
    lines and then reads a file as one value.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = spark.read.text(path, wholetext=whole_files).filter(F.col("value").rlike(pattern))
    groups = [F.regexp_extract_all("value", F.lit(pattern), F.lit(i + 1)).alias(f.name) for i, f in enumerate(fields)]
    matches = text.select(F.inline(F.arrays_zip(*groups)))
    return matches.select(*[
        F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields
    ])


def read_binary_records(spark: SparkSession, path: str, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Fixed-width records; ``fields`` are (name, numpy type) such as ``("price", "<f8")``.

    Splits fall on record borders, so one large file feeds many tasks. Decoding is done per Arrow
    batch.
    """
    import numpy as np

    layout = np.dtype([(n, t) for n, t in fields])
    spark_types = {"i1": "tinyint", "i2": "smallint", "i4": "int", "i8": "bigint", "u1": "smallint", "u2": "int",
                   "u4": "bigint", "f4": "float", "f8": "double", "b1": "boolean"}
    columns, arrow_types = [], {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64",
                                "float": "float32", "double": "float64", "boolean": "bool"}
    for name, _ in fields:
        kind = layout[name].str[1:]
        if kind[0] not in "SUV" and kind not in spark_types:
            raise ValueError(f"field {name} has a type that Spark lacks: {layout[name]}")
        columns.append((name, spark_types.get(kind, "binary" if kind[0] == "V" else "string")))
    schema = ", ".join(f"`{n}` {t}" for n, t in columns)
    # The splits stay in the JVM until whole Arrow batches of records go to the decoder.
    context = spark.sparkContext
    pieces = context._jsc.sc().binaryRecords(path, layout.itemsize, context._jsc.hadoopConfiguration())
    encoder = context._jvm.org.apache.spark.sql.Encoders.BINARY()
    records = DataFrame(spark._jsparkSession.createDataset(pieces, encoder).toDF(), spark)

    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            block = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=layout)
            arrays = []
            for name, kind in columns:
                values = block[name]
                if kind == "string":
                    texts = values.tolist()
                    arrays.append(pa.array([v.decode() if isinstance(v, bytes) else v for v in texts], pa.string()))
                elif kind == "binary":
                    arrays.append(pa.array([v.tobytes() for v in values], pa.binary()))
                else:
                    arrays.append(pa.array(values.astype(arrow_types[kind])))
            yield pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in columns])

    return records.mapInArrow(decode, schema)
