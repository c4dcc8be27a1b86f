"""Online copies of feature groups: one row per key, changed bucket by bucket.

A copy is a folder of parquet files partitioned by a hash bucket of the primary key. A batch of
changes is reduced to one row per key and written once, as a delta dealt over the same buckets. Only
the buckets that the delta touches are read, merged and replaced, by dynamic partition overwrite, so
a batch costs what its buckets hold and all other files stay as they are. With an order column each
row keeps the order of its last change, and changes that come late lose.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from millrace.functions.types import online_schema
from millrace.operators.upsert import merge_changes, single_changes
from millrace.session import delete_path, fresh_dir
from millrace.sources.files import list_files

BUCKETS = 64
_PROPERTY = "millrace.online"
_BUCKET, _ORDER = "zz_bucket", "zz_order"


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int")


class OnlineGroups:
    def __init__(self, store):
        self.store = store
        self.spark = store.spark

    # Catalog ------------------------------------------------------------------------------------

    def is_enabled(self, name: str, version: int = 1) -> bool:
        table = self.store.table_name(name, version)
        return self.spark.catalog.tableExists(table) and _PROPERTY in self.store._properties(table)

    def _entry(self, name: str, version: int) -> dict:
        found = self.store._properties(self.store.table_name(name, version)).get(_PROPERTY)
        if found is None:
            raise ValueError(f"feature group {name}_{version} has no online copy")
        return json.loads(found)

    def enable(
        self, name: str, version: int = 1, key: Sequence[str] = (), order: str | None = None,
        order_type: str | None = None, buckets: int = BUCKETS, features: Sequence[Mapping] = (),
    ) -> None:
        """Copy the group's rows, whose key must be unique and not null.

        ``features`` chooses the features of the copy, their types and, by ``primary``, its key; see
        :func:`millrace.functions.types.online_schema`.

        ``order`` names the column that tells which of two changes of a key is newer. A group that
        lacks it needs its type, and rows copied now are older than any change.
        """
        table = self.store.table_name(name, version)
        rows = self.spark.table(table)
        chosen = online_schema(features) if features else None
        if chosen is not None and (unknown := [f.name for f in chosen if f.name not in rows.columns]):
            raise ValueError(f"not features of the group: {unknown}")
        keys = list(key) or [f.name for f in chosen or () if f.metadata["primary"]] or self.store._primary_key(table)
        if not keys:
            raise ValueError(f"feature group {name}_{version} has no primary key")
        kind = None
        if order is not None:
            kind = order_type or (rows.schema[order].dataType.simpleString() if order in rows.columns else None)
            if kind is None:
                raise ValueError(f"{order} is no column of the group: give its type")
            rows = rows.withColumn(_ORDER, F.col(f"`{order}`").cast(kind) if order in rows.columns else F.lit(None).cast(kind))
        if chosen is not None:
            kept = [] if order is None else [F.col(_ORDER)]
            rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in chosen], *kept)
        path = f"{self.store.location.rstrip('/')}/zz_online/{name}_{version}/{uuid.uuid4().hex}"
        entry = {"path": path, "key": keys, "order": order, "order_type": kind, "buckets": buckets, "schema": rows.schema.json()}
        self._put(single_changes(rows, keys, None), entry)
        before = json.loads(self.store._properties(table).get(_PROPERTY, "{}"))
        self.store._set_properties(table, {_PROPERTY: json.dumps(entry)})
        if before:
            delete_path(self.spark, before["path"])

    def disable(self, name: str, version: int = 1) -> None:
        entry = self._entry(name, version)
        table = self.store.table_name(name, version)
        kind = "VIEW" if self.store._is_view(table) else "TABLE"
        self.spark.sql(f"ALTER {kind} {table} UNSET TBLPROPERTIES IF EXISTS ('{_PROPERTY}')")
        delete_path(self.spark, entry["path"])

    def info(self, name: str, version: int = 1) -> dict:
        """Where the copy is, its buckets, rows and bytes."""
        entry = self._entry(name, version)
        listed = list_files(self.spark, entry["path"], recursive=True, pattern="*.parquet", include_empty=False)
        files = listed.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()
        return {
            "path": entry["path"], "buckets": entry["buckets"], "key": entry["key"], "order": entry["order"],
            "rows": self._rows(entry).count(), "size": files["size"],
        }

    # Rows ---------------------------------------------------------------------------------------

    def _rows(self, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"])).add(_BUCKET, T.IntegerType())
        return self.spark.read.schema(schema).parquet(entry["path"])

    def _put(self, rows: DataFrame, entry: dict) -> None:
        """Replace the buckets that ``rows`` has, and leave the others."""
        if _BUCKET not in rows.columns:
            rows = rows.withColumn(_BUCKET, bucket_of(entry["key"], entry["buckets"]))
        # A bucket's rows come together; one larger than a file of usual size gets several.
        rows.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(entry["path"])

    def read(self, name: str, version: int = 1) -> DataFrame:
        return self._rows(self._entry(name, version)).drop(_BUCKET, _ORDER)

    def lookup(self, keys: DataFrame, name: str, version: int = 1) -> DataFrame:
        """Rows of the given keys; only their buckets are read. Keys without a row are left out."""
        entry = self._entry(name, version)
        wanted = keys.select(*entry["key"]).distinct().withColumn(_BUCKET, bucket_of(entry["key"], entry["buckets"]))
        rows = self._rows(entry).filter(F.col(_BUCKET).isin(self._touched(wanted)))
        return rows.join(wanted, [_BUCKET, *entry["key"]], "left_semi").drop(_BUCKET, _ORDER)

    @staticmethod
    def _touched(rows: DataFrame) -> list[int]:
        """The buckets that rows lie in: at most as many as the copy has."""
        return [r[0] for r in rows.select(_BUCKET).distinct().collect()]

    def upsert(self, changes: DataFrame, name: str, version: int = 1, order: str | None = None) -> None:
        """Merge changes into their buckets. A null key fails the job, and so does a repeated one without an order."""
        entry = self._entry(name, version)
        if order is not None and order != entry["order"]:
            raise ValueError(f"the copy is ordered by {entry['order']!r}, not by {order!r}")
        order, keys = entry["order"], entry["key"]
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        fields = [f for f in schema if f.name != _ORDER]
        wanted = {f.name for f in fields} | ({order} if order else set())
        if missing := wanted - set(changes.columns):
            raise ValueError(f"the changes lack {sorted(missing)}")
        rows = changes.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields],
            *([F.col(f"`{order}`").cast(entry["order_type"]).alias(_ORDER)] if order else []),
        )
        delta = {**entry, "path": fresh_dir(self.spark, "online-delta")}
        try:
            self._put(single_changes(rows, keys, _ORDER if order else None), delta)
            changed = self._rows(delta)
            base = self._rows(entry).filter(F.col(_BUCKET).isin(self._touched(changed)))
            self._put(merge_changes(base, changed, [_BUCKET, *keys], _ORDER if order else None), entry)
        finally:
            delete_path(self.spark, delta["path"])
