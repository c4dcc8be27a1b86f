"""Type maps between Spark, record files and row stores, and checks of declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
# Column types of the online row store, by Spark type name.
ROW_STORE_TYPES = {
    "bigint": "BIGINT(20)",
    "int": "INT(11)",
    "smallint": "SMALLINT(5)",
    "char": "CHAR",
    "string": "VARCHAR(1000)",
    "binary": "BLOB",
    "tinyint": "TINYINT(1)",
    "float": "FLOAT",
    "double": "DOUBLE",
    "boolean": "TINYINT(1)",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}
# Record-file element types.
RECORD_INT, RECORD_FLOAT, RECORD_STRING = "int64", "float32", "string"
DEFAULT_DESCRIPTION = "-"
# ------------------------------------------------------------------------------------------------

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType, T.DecimalType)
_TEXTS = (T.StringType, T.BinaryType)


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns for statistics: the listed ones, else every numeric one."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if columns is None:
        return numeric
    unknown = [c for c in columns if c not in numeric]
    if unknown:
        raise ValueError(f"not numeric columns of the data: {unknown}")
    return list(columns)


def record_type(data_type: T.DataType) -> tuple[str, bool]:
    """(element type, is an array) of a column in a record file."""
    if isinstance(data_type, T.ArrayType):
        return record_type(data_type.elementType)[0], True
    if data_type.typeName() == "vectorudt" or type(data_type).__name__ == "VectorUDT":
        return RECORD_FLOAT, True
    if isinstance(data_type, _INTS):
        return RECORD_INT, False
    if isinstance(data_type, _FLOATS):
        return RECORD_FLOAT, False
    if isinstance(data_type, _TEXTS):
        return RECORD_STRING, False
    raise ValueError(f"type {data_type.simpleString()} cannot be kept in a record file")


def record_schema(df: DataFrame) -> dict[str, dict]:
    """Feature description of a data set: scalars and arrays of one length are fixed, others variable.

    Only frames with array columns need a job, a min/max of the sizes.
    """
    kinds = {f.name: record_type(f.dataType) for f in df.schema}
    arrays = [name for name, (_, is_array) in kinds.items() if is_array]
    sizes = {}
    if arrays:
        row = df.agg(
            *[F.min(F.size(F.col(a))).alias(f"lo_{i}") for i, a in enumerate(arrays)],
            *[F.max(F.size(F.col(a))).alias(f"hi_{i}") for i, a in enumerate(arrays)],
        ).first()
        sizes = {a: (row[f"lo_{i}"], row[f"hi_{i}"]) for i, a in enumerate(arrays)}
    schema = {}
    for name, (element, is_array) in kinds.items():
        if not is_array:
            schema[name] = {"feature": "fixed_len", "shape": [], "type": element}
        elif sizes[name][0] is not None and sizes[name][0] == sizes[name][1]:
            schema[name] = {"feature": "fixed_len", "shape": [sizes[name][0]], "type": element}
        else:
            schema[name] = {"feature": "var_len", "shape": None, "type": element}
    return schema


def row_store_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    if isinstance(data_type, T.VarcharType):
        return f"VARCHAR({data_type.length})"
    if isinstance(data_type, T.CharType):
        return f"CHAR({data_type.length})"
    name = data_type.simpleString()
    if name not in ROW_STORE_TYPES:
        raise ValueError(f"type {name} has no row-store type")
    return ROW_STORE_TYPES[name]


def online_schema(features: Sequence[dict]) -> T.StructType:
    """Checked schema of an online group from ``{"name", "type", "primary", ...}`` entries.

    An empty list, an entry without name or type and a list without primary key are errors;
    description and partition get defaults.
    """
    if not features:
        raise ValueError("the schema has no features")
    fields = []
    for feature in features:
        missing = [k for k in ("name", "type") if not feature.get(k)]
        if missing:
            raise ValueError(f"feature {feature!r} lacks {missing}")
        metadata = {
            "comment": feature.get("description", DEFAULT_DESCRIPTION),
            "primary": bool(feature.get("primary", False)),
            "partition": bool(feature.get("partition", False)),
        }
        data_type = T.StructType.fromDDL(f"c {feature['type']}")[0].dataType
        fields.append(T.StructField(feature["name"], data_type, not metadata["primary"], metadata))
    if not any(f.metadata["primary"] for f in fields):
        raise ValueError("the schema has no primary key")
    return T.StructType(fields)


def primary_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are null or occur more than once. Counts combine before the shuffle."""
    null_key = F.lit(False)
    for column in key:
        null_key = null_key | F.col(column).isNull()
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter((F.col("rows") > 1) | null_key)
