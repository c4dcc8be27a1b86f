"""Training datasets: versioned file sets in one format, replaced as a whole.

Each write goes to a folder of its own and the catalog entry then points to it, so a reader sees
the old or the new rows and the input may read the dataset it replaces. The entry is an empty
catalog table ``td_<name>_<version>`` that keeps the schema, format, path and description.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import record_schema
from millrace.session import delete_path
from millrace.sources.csv_records import read_csv_records
from millrace.sources.tables import CSV_WRITE_OPTIONS

# --- fixed values -------------------------------------------------------------------------------
DEFAULT_FORMAT = "tfrecords"
NATIVE_OPTIONS = {
    # A marker for null, so that an empty text stays one.
    "csv": {**CSV_WRITE_OPTIONS, "nullValue": "\\N"},
    "tsv": {**CSV_WRITE_OPTIONS, "nullValue": "\\N", "sep": "\t"},
    "json": {},
    "parquet": {},
    "orc": {},
    "avro": {},
    "petastorm": {},
}
RECORD_FORMATS = ("tfrecords", "tfrecord")
# ------------------------------------------------------------------------------------------------

_SPARK_FORMAT = {"tsv": "csv", "petastorm": "parquet"}
_ENTRY = "zz_td_"


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() == "string"]


def _guarded(df: DataFrame) -> DataFrame:
    """Texts that look like the null marker get one more backslash in front."""
    marked = {c: F.when(F.col(f"`{c}`").rlike(r"^\\+N$"), F.concat(F.lit("\\"), F.col(f"`{c}`"))) for c in _texts(df)}
    return df.withColumns({c: m.otherwise(F.col(f"`{c}`")) for c, m in marked.items()})


def _unguarded(df: DataFrame) -> DataFrame:
    plain = {c: F.when(F.col(f"`{c}`").rlike(r"^\\\\+N$"), F.expr(f"substring(`{c}`, 2)")) for c in _texts(df)}
    return df.withColumns({c: m.otherwise(F.col(f"`{c}`")) for c, m in plain.items()})


class TrainingDatasets:
    def __init__(self, store):
        self.store = store
        self.spark = store.spark
        self.root = f"{store.location.rstrip('/')}/{store.project}_Training_Datasets"

    def _entry(self, name: str, version: int) -> str:
        return f"`{self.store.database}`.`{_ENTRY}{name}_{version}`"

    def names(self) -> list[str]:
        return [t[len(_ENTRY):] for t in self.store._tables() if t.startswith(_ENTRY)]

    def _properties(self, name: str, version: int) -> dict[str, str]:
        if not self.spark.catalog.tableExists(self._entry(name, version)):
            raise ValueError(f"no training dataset {name}_{version}")
        return self.store._properties(self._entry(name, version))

    def path(self, name: str, version: int = 1) -> str:
        return self._properties(name, version)["millrace.path"]

    def record_schema(self, name: str, version: int = 1) -> dict:
        return json.loads(self._properties(name, version)["millrace.record_schema"])

    def create(
        self,
        df: DataFrame,
        name: str,
        description: str = "",
        data_format: str = DEFAULT_FORMAT,
        training_dataset_version: int = 1,
        descriptive_statistics: bool = False,
        feature_correlation: bool = False,
        feature_histograms: bool = False,
        cluster_analysis: bool = False,
        stat_columns: Sequence[str] | None = None,
        path: str | None = None,
    ) -> None:
        """Write a dataset. ``path`` puts it outside the store, for instance below ``s3a://``."""
        self._check_format(data_format)
        version = training_dataset_version
        base = f"{(path or self.root).rstrip('/')}/{name}_{version}"
        entry = self._entry(name, version)
        before = self.store._properties(entry) if self.spark.catalog.tableExists(entry) else {}
        target = f"{base}/{uuid.uuid4().hex}"
        self._write(df, data_format, target)
        self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
        self.spark.createDataFrame([], df.schema).write.format("parquet").saveAsTable(entry)
        described = record_schema(self._scan(data_format, target, df.schema)) if self._recordable(df) else {}
        self.store._set_properties(entry, {
            "millrace.path": target,
            "millrace.base": base,
            "millrace.format": data_format,
            "millrace.record_schema": json.dumps(described),
            "comment": description,
        })
        if before.get("millrace.path"):
            delete_path(self.spark, before["millrace.path"])
        if descriptive_statistics or feature_correlation or feature_histograms or cluster_analysis:
            self.update_stats(
                name, version, descriptive_statistics=descriptive_statistics,
                feature_correlation=feature_correlation, feature_histograms=feature_histograms,
                cluster_analysis=cluster_analysis, stat_columns=stat_columns,
            )

    def insert(self, df: DataFrame, name: str, version: int = 1, **stats) -> None:
        """Replace the rows of a dataset; datasets know no other insert."""
        properties = self._properties(name, version)
        wanted = self.spark.table(self._entry(name, version)).columns
        if set(df.columns) != set(wanted):
            raise ValueError(f"columns do not match: {df.columns} instead of {wanted}")
        target = f"{properties['millrace.base']}/{uuid.uuid4().hex}"
        self._write(df.select(*wanted), properties["millrace.format"], target)
        self.store._set_properties(self._entry(name, version), {"millrace.path": target})
        delete_path(self.spark, properties["millrace.path"])
        if any(stats.values()):
            self.update_stats(name, version, **stats)

    def read(self, name: str, version: int = 1) -> DataFrame:
        properties = self._properties(name, version)
        schema = self.spark.table(self._entry(name, version)).schema
        return self._scan(properties["millrace.format"], properties["millrace.path"], schema)

    def drop(self, name: str, version: int = 1) -> None:
        properties = self._properties(name, version)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(name, version)}")
        delete_path(self.spark, properties["millrace.path"])
        self.store.statistics.drop(f"dataset:{name}_{version}")

    def update_stats(self, name: str, version: int = 1, stat_columns: Sequence[str] | None = None, **options) -> None:
        self.store.statistics.update(f"dataset:{name}_{version}", self.read(name, version), stat_columns, **options)

    # Formats ------------------------------------------------------------------------------------

    @staticmethod
    def _recordable(df: DataFrame) -> bool:
        from millrace.functions.types import record_type

        try:
            return all(record_type(f.dataType) for f in df.schema)
        except ValueError:
            return False

    def _check_format(self, data_format: str) -> None:
        if data_format in ("hdf5", "image"):
            raise ValueError(f"format {data_format} cannot be written by Spark tasks")
        if data_format not in NATIVE_OPTIONS and data_format not in (*RECORD_FORMATS, "npy"):
            raise ValueError(f"unknown format {data_format!r}")
        if data_format == "avro":
            from millrace.sources.connectors import require_format

            require_format(self.spark, "avro")

    def _write(self, df: DataFrame, data_format: str, target: str) -> None:
        from millrace.sources import arrays, records

        if data_format in NATIVE_OPTIONS:
            if data_format == "petastorm":
                df = df.select(*[
                    F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, "nullable": f.nullable})
                    for f in df.schema
                ])
            if data_format in ("csv", "tsv"):
                df = _guarded(df)
            df.write.format(_SPARK_FORMAT.get(data_format, data_format)).options(
                **NATIVE_OPTIONS[data_format]
            ).mode("overwrite").save(target)
        elif data_format in RECORD_FORMATS:
            records.write_tfrecord(df, target)
        else:
            arrays.write_npy(df, target)

    def _scan(self, data_format: str, path: str, schema) -> DataFrame:
        from millrace.sources import arrays, records

        if data_format in NATIVE_OPTIONS:
            reader = self.spark.read.format(_SPARK_FORMAT.get(data_format, data_format)).options(
                **NATIVE_OPTIONS[data_format]
            )
            if data_format in ("csv", "tsv") and any(f.dataType.typeName() == "string" for f in schema):
                # Texts may hold line ends.
                rows = read_csv_records(self.spark, path, schema, NATIVE_OPTIONS[data_format], ".csv")
            else:
                rows = reader.schema(schema).load(path)
            return _unguarded(rows) if data_format in ("csv", "tsv") else rows
        if data_format in RECORD_FORMATS:
            return records.read_tfrecord(self.spark, path, schema)
        return arrays.read_npy_table(self.spark, path, schema)
