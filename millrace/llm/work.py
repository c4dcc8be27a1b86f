"""Intermediate tables, splitting of Arrow batches and null handling shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.session import delete_path, fresh_dir

#: Text bytes that one step of a task holds as Python objects.
STEP_BYTES = 8 << 20


_WRITTEN: list[str] = []


def written() -> int:
    """How many tables :func:`stored` has written; a mark for :func:`forget`."""
    return len(_WRITTEN)


def forget(spark: SparkSession, mark: int, keep: int = 0) -> None:
    """Delete the tables written since the mark, but for the last ``keep``. Nothing may read them any more."""
    end = len(_WRITTEN) - keep
    for path in _WRITTEN[mark:end]:
        delete_path(spark, path)
    del _WRITTEN[mark:end]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: later plans start from the files.

    A lost executor then costs its tasks only, and nothing upstream runs twice.
    """
    path = fresh_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    _WRITTEN.append(path)
    # What lay upstream is not read again: let the driver notice, so that its shuffle files go now.
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def steps(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one piece holds about ``most`` bytes of text, or one row if that is longer."""
    for batch in batches:
        size = max(1, batch.column(batch.schema.get_field_index(column)).nbytes)
        rows = max(1, min(batch.num_rows, batch.num_rows * most // size))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts with null as the empty text."""
    return [text or "" for text in column(batch, name).to_pylist()]
