"""Table-like files: CSV, Parquet, ORC, JSON, Excel, text."""

from __future__ import annotations

import io
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from millrace.sources.csv_records import read_csv_records


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    header: bool = True,
    names: Sequence[str] | None = None,
    usecols: Sequence[str] | None = None,
    na_values: str | None = None,
    comment: str | None = None,
    schema: T.StructType | str | None = None,
    infer_schema: bool = True,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """CSV files. With a schema they are read once; inferring one costs a pass over the data.

    ``multi_line`` is for quoted values that hold line ends. With a schema such files are read by
    splits, too; without one, or with comments, a file is one task's work.
    """
    if multi_line and schema is not None and comment is None and "quote" not in options and "escape" not in options:
        given = {"sep": sep, "header": str(header).lower(), "escape": '"', **options}
        if na_values is not None:
            given["nullValue"] = na_values
        df = read_csv_records(spark, path, schema, given)
        df = df.toDF(*names) if names is not None else df
        return df.select(*usecols) if usecols else df
    reader = spark.read.option("sep", sep).option("header", str(header).lower()).option("escape", '"').option(
        "multiLine", str(multi_line).lower()
    )
    if na_values is not None:
        reader = reader.option("nullValue", na_values)
    if comment is not None:
        reader = reader.option("comment", comment)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer_schema).lower())
    df = reader.options(**options).csv(path)
    if names is not None:
        df = df.toDF(*names)
    return df.select(*usecols) if usecols else df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_json(spark: SparkSession, path: str, orient: str = "lines", schema: T.StructType | str | None = None) -> DataFrame:
    """JSON files: ``lines`` (splittable), ``records`` (one array per file) or ``columns``.

    ``columns`` is one object per file that maps column to row label to value. Its cells are
    exploded and regrouped by file and row label, so a file's rows spread over tasks; it needs a
    schema for anything but text and adds the label as ``index``.
    """
    if orient in ("lines", "records"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("multiLine", str(orient == "records").lower()).json(path)
    if orient != "columns":
        raise ValueError(f"orient must be lines, records or columns, not {orient!r}")
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_file"),
        F.from_json("value", "map<string,map<string,string>>").alias("_columns"),
    )
    cells = files.select("_file", F.explode("_columns").alias("column", "_rows")).select(
        "_file", "column", F.explode("_rows").alias("index", "value")
    )
    if schema is None:
        names = [r["column"] for r in cells.select("column").distinct().orderBy("column").collect()]
        fields = T.StructType([T.StructField(n, T.StringType()) for n in names])
    else:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = cells.groupBy("_file", "index").pivot("column", fields.names).agg(F.first("value"))
    return wide.select("index", *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def read_excel(spark: SparkSession, path: str, schema: T.StructType | str, sheet: int | str = 0) -> DataFrame:
    """One sheet of each workbook, one file per task. Needs the openpyxl package."""
    try:
        import openpyxl  # noqa: F401
    except ImportError as error:
        raise RuntimeError("reading Excel files needs the openpyxl package") from error

    def load(batches):
        import pandas as pd

        for batch in batches:
            for content in batch["content"]:
                yield pd.read_excel(io.BytesIO(content), sheet_name=sheet)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(load, schema)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Images with origin, size, channels and pixels."""
    return spark.read.format("image").load(path).select("image.*")


def read_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`" if database else table)


def read_whole(spark: SparkSession, path: str, binary: bool = False) -> DataFrame:
    """Whole files as (path, content)."""
    if binary:
        return spark.read.format("binaryFile").load(path).select("path", "content")
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


# --- fixed values -------------------------------------------------------------------------------
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# ------------------------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("overwrite").options(**{**CSV_WRITE_OPTIONS, **options}).csv(path)


def write_parquet(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("overwrite").options(**options).parquet(path)


def write_json(df: DataFrame, path: str, **options: str) -> None:
    df.write.mode("overwrite").options(**options).json(path)


def write_text(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
