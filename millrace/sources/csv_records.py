"""Records of CSV files whose quoted values hold line ends, read by splits.

A line begins inside a quoted value if an odd number of quotes stands before it in its file. Quotes
are counted per split, and the counts added up over the splits of a file: then each split knows how
it begins. Tasks join the lines of a record; what a record has in other splits is a fragment of its
own, and fragments, at most two per split, are put together by file and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
_RECORD = "file long, start long, place int, first boolean, record string"
# What a row of records is: a whole record, or the piece of one that a split begins with, consists of or ends with.
_WHOLE, _HEAD, _TAIL = 0, 1, 2


def _lines(spark: SparkSession, path: str, suffix: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    # A carriage return stays with its line, so that one inside a value is not lost.
    return reader.text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _splits(lines: DataFrame) -> DataFrame:
    """(file, start, opened, open_end): whether a split begins, and whether it ends, inside a quoted value."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    after = F.sum("odd").over(upto) % 2
    return odd.select("file", "start", ((after + F.col("odd")) % 2 == 1).alias("opened"), (after == 1).alias("open_end"))


def csv_records(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """(record, first): the records of the files, blank ones left out; ``first`` marks a file's first one."""
    lines = _lines(spark, path, suffix)
    # One row of a few bytes per split of the input.
    known = lines.join(F.broadcast(_splits(lines)), ["file", "start"])

    def joined(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        held, key, inside, number = [], None, False, 0

        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["file", "start", "place", "first", "record"]
            )

        for batch in batches:
            names = batch.schema.names
            value = batch.column(names.index("value"))
            files, starts = (batch.column(names.index(c)).to_numpy() for c in ("file", "start"))
            opened = batch.column(names.index("opened")).to_numpy(zero_copy_only=False)
            odd = (np.asarray(pc.count_substring(value, QUOTE)) % 2).astype(bool)
            texts, done = value.to_pylist(), []
            for i, text in enumerate(texts):
                own = (files[i], starts[i])
                if own != key:
                    if held:
                        done.append((*key, _TAIL if number else _HEAD, number == 1 and key[1] == 0, "\n".join(held)))
                    held, key, inside, number = [], own, opened[i], 0 if opened[i] else 1
                held.append(text)
                inside ^= odd[i]
                if not inside:
                    place = _WHOLE if number else _HEAD
                    done.append((*key, place, number == 1 and key[1] == 0, "\n".join(held)))
                    held, number = [], number + 1
            if done:
                yield rows(done)
        if held:
            yield rows([(*key, _TAIL if number else _HEAD, number == 1 and key[1] == 0, "\n".join(held))])

    whole = known.mapInArrow(joined, _RECORD).filter(F.col("place") == _WHOLE)
    cut = known.filter("opened OR open_end").mapInArrow(joined, _RECORD).filter(F.col("place") != _WHOLE)
    # A tail begins a record; the heads of the splits behind it go on with it.
    upto = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
    pieces = cut.withColumn("of", F.sum(F.when(F.col("place") == _TAIL, 1).otherwise(0)).over(upto))
    listed = F.array_sort(F.collect_list(F.struct("start", "place", "record")))
    mended = pieces.groupBy("file", "of").agg(
        F.array_join(F.transform(listed, lambda p: p["record"]), "\n").alias("record"), F.bool_or("first").alias("first")
    )
    records = whole.select("record", "first").unionByName(mended.select("record", "first"))
    return records.filter(~F.col("record").isin("", "\r"))


def read_csv_records(spark: SparkSession, path: str, schema, options: dict[str, str], suffix: str | None = None) -> DataFrame:
    """Rows of CSV files under a schema, as Spark's multi-line reader gives them, but read by splits.

    ``options`` are those of that reader; quotes inside values must be doubled.
    """
    records = csv_records(spark, path, suffix)
    if str(options.get("header", "false")).lower() == "true":
        records = records.filter(~F.col("first"))
    parsing = {k: v for k, v in options.items() if k != "header"}
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    row = F.from_csv("record", ddl, {**parsing, "multiLine": "true"})
    return records.select(row.alias("row")).select("row.*")
