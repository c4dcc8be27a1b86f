"""Local data to frames and frames to local data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK, PANDAS, NUMPY, PYTHON = "spark", "pandas", "numpy", "python"


def as_spark(spark: SparkSession, data) -> DataFrame:
    """A frame from a frame, a pandas frame, a 2-D array or a list of rows.

    Arrays and lists carry no names: their columns are ``col_0``, ``col_1``, ...
    """
    if isinstance(data, DataFrame):
        return data
    if hasattr(data, "to_dict") and hasattr(data, "columns"):
        return spark.createDataFrame(data)
    if hasattr(data, "tolist"):
        if data.ndim != 2:
            raise ValueError(f"an array needs two dimensions, not {data.ndim}")
        data = data.tolist()
    rows = [list(row) for row in data]
    if not rows:
        raise ValueError("an empty list has no columns")
    if len({len(row) for row in rows}) != 1:
        raise ValueError("rows differ in length")
    return spark.createDataFrame(rows, [f"col_{i}" for i in range(len(rows[0]))])


def convert(df: DataFrame, dataframe_type: str = SPARK):
    """The frame itself, or all of it on the driver for small results a caller asks for."""
    if dataframe_type == SPARK:
        return df
    if dataframe_type == PANDAS:
        return df.toPandas()
    if dataframe_type == NUMPY:
        return df.toPandas().to_numpy()
    if dataframe_type == PYTHON:
        return [list(row) for row in df.collect()]
    raise ValueError(f"dataframe_type must be spark, pandas, numpy or python, not {dataframe_type!r}")
