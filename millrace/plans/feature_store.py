"""Versioned feature groups as catalog tables, and reads of features by name.

The store is one database in the Spark catalog. A cached group is a columnar table
``<name>_<version>``, an on-demand group is a view of that name, so every read is an ordinary scan
that Catalyst prunes, filters and joins. Descriptions, keys and tags are table properties.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.types import numeric_columns, primary_key_violations
from millrace.operators.statistics import check_matrix
from millrace.operators.upsert import upsert
from millrace.plans.online_groups import BUCKETS, OnlineGroups
from millrace.plans.statistics_store import StatisticsStore
from millrace.plans.training_datasets import TrainingDatasets
from millrace.session import delete_path, fresh_dir, shared_dir
from millrace.sources.local import as_spark, convert

_VERSIONED = re.compile(r"^(?P<name>.+)_(?P<version>\d+)$")
_TAG = "tag."
_PRIMARY = "millrace.primary"
_PARTITION = "millrace.partition"
_HIDDEN = "zz_"  # tables of the store itself
_CONNECTOR_SCHEMA = "name string, settings string, seq long"


def quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class FeatureStore:
    """A feature store of one project.

    ``location`` is where its tables live; by default below the shared folder of the session.
    """

    def __init__(self, spark: SparkSession, project: str = "demo", location: str | None = None):
        self.spark = spark
        self.project = project
        self.database = f"{project}_featurestore"
        if location is None:
            # An in-memory catalog ends with its session, and so do the tables it alone knows.
            in_memory = spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory"
            session = (spark.sparkContext.applicationId,) if in_memory else ()
            location = shared_dir(spark, *session, self.database)
        self.location = location
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(self.database)} LOCATION {literal(self.location)}")
        self.training = TrainingDatasets(self)
        self.statistics = StatisticsStore(self)
        self.online = OnlineGroups(self)
        #: Connectors that every store has; further ones are rows of a table of the store.
        self._own_connectors: dict[str, dict] = {
            self.database: {"type": "JDBC", "arguments": ""},
            f"{project}_Training_Datasets": {"type": "FILESYSTEM", "path": self.training.root},
            f"{project}_shared": {"type": "FILESYSTEM", "path": self.location},
        }

    # Catalog ------------------------------------------------------------------------------------

    def project_featurestore(self) -> str:
        return self.database

    def get_project_featurestores(self) -> list[str]:
        return [self.database]

    def table_name(self, name: str, version: int = 1, featurestore: str | None = None) -> str:
        return quoted(featurestore or self.database, f"{name}_{version}")

    def _tables(self, featurestore: str | None = None) -> list[str]:
        rows = self.spark.sql(f"SHOW TABLES IN {quoted(featurestore or self.database)}").collect()
        return sorted(r.tableName for r in rows if not r.isTemporary)

    def get_featuregroups(self, featurestore: str | None = None) -> list[str]:
        """``<name>_<version>`` of every group, on-demand ones included."""
        return [t for t in self._tables(featurestore) if _VERSIONED.match(t) and not t.startswith(_HIDDEN)]

    def get_features_list(self, featurestore: str | None = None) -> list[str]:
        return [c for columns in self._columns(featurestore).values() for c in columns]

    def get_training_datasets(self) -> list[str]:
        return self.training.names()

    def get_featuregroup_features(self, name: str, featuregroup_version: int = 1, featurestore: str | None = None) -> list[dict]:
        """Name, type, description and role of each feature of a group."""
        table = self.table_name(name, featuregroup_version, featurestore)
        properties = self._properties(table)
        primary, partition = (set(filter(None, properties.get(p, "").split(","))) for p in (_PRIMARY, _PARTITION))
        return [
            {
                "name": f.name, "type": f.dataType.simpleString(), "description": f.metadata.get("comment", ""),
                "primary": f.name in primary, "partition": f.name in partition,
            }
            for f in self.spark.table(table).schema
        ]

    def get_latest_featuregroup_version(self, name: str) -> int:
        """Highest version, 0 when the name is unknown."""
        return latest_version(self.get_featuregroups(), name)

    def get_latest_training_dataset_version(self, name: str) -> int:
        return latest_version(self.get_training_datasets(), name)

    def get_featurestore_metadata(self, update_cache: bool = False) -> dict:
        if update_cache:
            for group in self.get_featuregroups():
                self.spark.catalog.refreshTable(quoted(self.database, group))
        return {
            "featurestore": self.database,
            "featuregroups": self._columns(),
            "training_datasets": self.get_training_datasets(),
            "storage_connectors": self.get_storage_connectors(),
        }

    def add_storage_connector(self, name: str, kind: str, **settings: str) -> None:
        """Keep a connector in the store; one of the same name is replaced. Settings are kept as they are given."""
        table = self._connector_table()
        row = (name, json.dumps({"type": kind, **settings}), time.time_ns())
        self.spark.createDataFrame([row], _CONNECTOR_SCHEMA).coalesce(1).write.insertInto(table)

    def remove_storage_connector(self, name: str) -> None:
        """Forget a connector; the three that every store has stay."""
        row = (name, None, time.time_ns())
        self.spark.createDataFrame([row], _CONNECTOR_SCHEMA).coalesce(1).write.insertInto(self._connector_table())

    def _connector_table(self) -> str:
        table = quoted(self.database, f"{_HIDDEN}connectors")
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_CONNECTOR_SCHEMA}) USING parquet")
        return table

    def _connectors(self) -> dict[str, dict]:
        """All connectors: the newest row of each name counts."""
        newest = self.spark.table(self._connector_table()).groupBy("name").agg(F.max_by("settings", "seq").alias("settings"))
        added = {r["name"]: json.loads(r["settings"]) for r in newest.filter("settings IS NOT NULL").collect()}
        return {**self._own_connectors, **added}

    def get_storage_connectors(self) -> list[tuple[str, str]]:
        return [(name, c["type"]) for name, c in sorted(self._connectors().items())]

    def get_storage_connector(self, name: str) -> dict:
        found = self._connectors()
        if name not in found:
            raise ValueError(f"no storage connector {name}")
        return found[name]

    def _columns(self, featurestore: str | None = None) -> dict[str, list[str]]:
        store = featurestore or self.database
        return {g: self.spark.table(quoted(store, g)).columns for g in self.get_featuregroups(store)}

    def _properties(self, table: str) -> dict[str, str]:
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}

    def _primary_key(self, table: str) -> list[str]:
        return list(filter(None, self._properties(table).get(_PRIMARY, "").split(",")))

    def _is_view(self, table: str) -> bool:
        return self.spark.catalog.getTable(table).tableType == "VIEW"

    # Writes -------------------------------------------------------------------------------------

    def create_featuregroup(
        self,
        df,
        name: str,
        description: str = "",
        featurestore: str | None = None,
        featuregroup_version: int = 1,
        primary_key: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        buckets: int | None = None,
        data_format: str = "parquet",
        check_primary_key: bool = False,
        descriptive_statistics: bool = True,
        feature_correlation: bool = True,
        feature_histograms: bool = True,
        cluster_analysis: bool = True,
        stat_columns: Sequence[str] | None = None,
        online: bool = False,
        feature_descriptions: Mapping[str, str] | None = None,
    ) -> None:
        """Write a group; one of the same name and version is replaced, and so is its online copy.

        ``feature_descriptions`` become comments of the columns.

        With ``buckets`` the table is bucketed and sorted by its primary key, and joins of groups
        bucketed alike need no shuffle. With ``online`` the group gets an online copy.
        """
        df = as_spark(self.spark, df)
        described = feature_descriptions or {}
        unknown = [c for c in (*primary_key, *partition_by, *described) if c not in df.columns]
        if unknown:
            raise ValueError(f"not columns of the data: {unknown}")
        if feature_correlation:
            check_matrix(numeric_columns(df, stat_columns))
        if check_primary_key and primary_key and not primary_key_violations(df, primary_key).isEmpty():
            raise ValueError(f"primary key {list(primary_key)} is null or repeated in the data")
        if described:
            df = df.select(*[
                F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, "comment": described[f.name]})
                if f.name in described else F.col(f"`{f.name}`") for f in df.schema
            ])
        if buckets:
            if not primary_key:
                raise ValueError("buckets need a primary key")
            # One task per bucket, and so one file.
            writer = df.repartition(buckets, *primary_key).write.bucketBy(buckets, *primary_key).sortBy(*primary_key)
        elif partition_by:
            # Rows of a partition come together, but a large partition still gets several tasks.
            writer = df.hint("rebalance", *partition_by).write
        else:
            writer = df.write
        writer = writer.format(data_format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        store = featurestore or self.database
        table = self.table_name(name, featuregroup_version, store)
        if store == self.database and self.online.is_enabled(name, featuregroup_version):
            self.online.disable(name, featuregroup_version)
        self._write_and_swap(writer, store, f"{name}_{featuregroup_version}")
        properties = {"comment": description, _PRIMARY: ",".join(primary_key), _PARTITION: ",".join(partition_by)}
        self._set_properties(table, {k: v for k, v in properties.items() if v})
        if online:
            self.online.enable(name, featuregroup_version)
        if descriptive_statistics or feature_correlation or feature_histograms or cluster_analysis:
            self.update_featuregroup_stats(
                name, featuregroup_version, featurestore, descriptive_statistics, feature_correlation,
                feature_histograms, cluster_analysis, stat_columns,
            )

    def _write_and_swap(self, writer, store: str, table: str) -> None:
        """Write beside the present table, then take its name.

        The input may read the table that is replaced, and a job that fails leaves it as it was.
        """
        target = quoted(store, table)
        if not self.spark.catalog.tableExists(target):
            writer.mode("overwrite").saveAsTable(target)
            return
        staged = quoted(store, f"{_HIDDEN}stage_{uuid.uuid4().hex}")
        try:
            writer.mode("overwrite").saveAsTable(staged)
            self._swap(staged, target, store)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {staged}")

    def _swap(self, staged: str, target: str, store: str) -> None:
        """Give the staged table the target's name; the old table goes last and comes back on a failure."""
        kind = "VIEW" if self._is_view(target) else "TABLE"
        old = quoted(store, f"{_HIDDEN}old_{uuid.uuid4().hex}")
        self.spark.sql(f"ALTER {kind} {target} RENAME TO {old}")
        try:
            self.spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
        except Exception:
            self.spark.sql(f"ALTER {kind} {old} RENAME TO {target}")
            raise
        self.spark.sql(f"DROP {kind} {old}")

    def create_on_demand_featuregroup(
        self,
        query: str,
        name: str,
        connector: str | None = None,
        featuregroup_version: int = 1,
        description: str = "",
        primary_key: Sequence[str] = (),
        feature_descriptions: Mapping[str, str] | None = None,
    ) -> None:
        """A group that is a stored query; it runs whenever it is read.

        With a JDBC connector that names a ``url`` the query is sent to that database.
        """
        table = self.table_name(name, featuregroup_version)
        settings = self.get_storage_connector(connector or self.database)
        if settings.get("url"):
            from millrace.sources.connectors import jdbc_options

            options = {**jdbc_options(settings["url"], settings.get("arguments", "")), "query": query}
            listed = ", ".join(f"{literal(k)} {literal(v)}" for k, v in options.items())
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(f"CREATE TABLE {table} USING jdbc OPTIONS ({listed})")
        else:
            comment = f"COMMENT {literal(description)} " if description else ""
            columns = ""
            if feature_descriptions:
                names = self._in_store(query).columns
                if unknown := [c for c in feature_descriptions if c not in names]:
                    raise ValueError(f"not columns of the query: {unknown}")
                listed = [
                    quoted(c) + (f" COMMENT {literal(feature_descriptions[c])}" if c in feature_descriptions else "")
                    for c in names
                ]
                columns = f"({', '.join(listed)}) "
            self._in_store(f"CREATE OR REPLACE VIEW {table} {columns}{comment}AS {query}")
        if primary_key:
            self._set_properties(table, {_PRIMARY: ",".join(primary_key)})

    def insert_into_featuregroup(
        self,
        df,
        name: str,
        featurestore: str | None = None,
        featuregroup_version: int = 1,
        mode: str = "append",
        online: bool = False,
        update_statistics: bool = True,
    ) -> None:
        """Append rows (duplicates stay) or replace all rows. Columns are matched by name.

        With ``online`` the rows are merged into the online copy, too, by their key. Statistics that
        the group has are brought up to date; an append adds those of its own rows.
        """
        if mode not in ("append", "overwrite"):
            raise ValueError(f"mode must be append or overwrite, not {mode!r}")
        df = as_spark(self.spark, df)
        store = featurestore or self.database
        table = self.table_name(name, featuregroup_version, store)
        present = self.spark.table(table)
        missing, extra = set(present.columns) - set(df.columns), set(df.columns) - set(present.columns)
        if missing or extra:
            raise ValueError(f"columns do not match: missing {sorted(missing)}, unknown {sorted(extra)}")
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in present.schema])
        if mode == "append":
            self._append(rows, table, f"{name}_{featuregroup_version}" if update_statistics and store == self.database else None)
            if online:
                self.online.upsert(df, name, featuregroup_version)
            return
        # The job that can fail writes beside the present rows; only its finished result replaces
        # them. Should that copy fail, the staged table is kept and named.
        staged = quoted(store, f"{_HIDDEN}stage_{uuid.uuid4().hex}")
        try:
            rows.write.saveAsTable(staged)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {staged}")
            raise
        try:
            self.spark.table(staged).write.insertInto(table, overwrite=True)
        except Exception as error:
            raise RuntimeError(f"the new rows of {table} are complete in {staged}; copying them failed") from error
        self.spark.sql(f"DROP TABLE {staged}")
        if update_statistics and store == self.database:
            self._restate(name, featuregroup_version)
        if online:
            entry = self.online._entry(name, featuregroup_version)
            self.online.enable(
                name, featuregroup_version, entry["key"], entry["order"], entry["order_type"], entry["buckets"]
            )

    def _append(self, rows: DataFrame, table: str, entity: str | None) -> None:
        """Add rows to a group, and to its statistics if it has any."""
        staged = None
        if entity and self.statistics.settings(entity).get("statistic_columns"):
            # Read twice, and may come from the group itself.
            staged = fresh_dir(self.spark, "append")
            rows.write.parquet(staged)
            rows = self.spark.read.schema(rows.schema).parquet(staged)
        parts = list(filter(None, self._properties(table).get(_PARTITION, "").split(",")))
        # As on creation: a partition's rows come together instead of one file from every task.
        (rows.hint("rebalance", *parts) if parts else rows).write.insertInto(table)
        if staged:
            self.statistics.append(entity, rows, self.spark.table(table))
            delete_path(self.spark, staged)

    def enable_featuregroup_online(
        self, name: str, featuregroup_version: int = 1, order: str | None = None, order_type: str | None = None,
        buckets: int = BUCKETS, features: Sequence[Mapping] = (),
    ) -> None:
        """Keep an online copy of the group's rows by its primary key, see :class:`OnlineGroups`."""
        self.online.enable(name, featuregroup_version, (), order, order_type, buckets, features)

    def disable_featuregroup_online(self, name: str, featuregroup_version: int = 1) -> None:
        self.online.disable(name, featuregroup_version)

    def upsert_into_featuregroup(
        self, df, name: str, featuregroup_version: int = 1, key: Sequence[str] | None = None, order: str | None = None
    ) -> None:
        """Replace the rows of changed keys and add new ones.

        The key is the declared primary key. With ``order`` the newest of several changes of a key
        counts, otherwise keys must not repeat. Fits ``foreachBatch`` of a stream of changes. A group
        with an online copy takes the changes there, bucket by bucket; another is written anew.
        """
        df = as_spark(self.spark, df)
        if key is None and self.online.is_enabled(name, featuregroup_version):
            self.online.upsert(df, name, featuregroup_version, order)
            return
        table = self.table_name(name, featuregroup_version)
        keys = list(key or self._primary_key(table))
        if not keys:
            raise ValueError(f"feature group {name}_{featuregroup_version} has no primary key")
        merged = upsert(self.spark.table(table), df, keys, order)
        self.insert_into_featuregroup(merged, name, featuregroup_version=featuregroup_version, mode="overwrite")

    def drop_featuregroup(self, name: str, featuregroup_version: int = 1) -> None:
        table = self.table_name(name, featuregroup_version)
        if self.spark.catalog.tableExists(table):
            if self.online.is_enabled(name, featuregroup_version):
                self.online.disable(name, featuregroup_version)
            self.spark.sql(f"DROP {'VIEW' if self._is_view(table) else 'TABLE'} {table}")
        self.statistics.drop(f"{name}_{featuregroup_version}")

    # Reads --------------------------------------------------------------------------------------

    def get_featuregroup(
        self,
        name: str,
        featurestore: str | None = None,
        featuregroup_version: int = 1,
        dataframe_type: str = "spark",
        online: bool = False,
    ):
        """All rows of a group, or of its online copy."""
        if online:
            return convert(self.online.read(name, featuregroup_version), dataframe_type)
        return convert(self.spark.table(self.table_name(name, featuregroup_version, featurestore)), dataframe_type)

    def get_online_features(self, keys, name: str, featuregroup_version: int = 1, dataframe_type: str = "spark"):
        """Rows of the online copy whose key is among ``keys``; only their buckets are read."""
        return convert(self.online.lookup(as_spark(self.spark, keys), name, featuregroup_version), dataframe_type)

    def get_feature(
        self,
        feature: str,
        featurestore: str | None = None,
        featuregroup: str | None = None,
        featuregroup_version: int = 1,
        dataframe_type: str = "spark",
    ):
        """One column, all its rows. Without a group the one group that has it is read."""
        store = featurestore or self.database
        if featuregroup:
            group, column = f"{featuregroup}_{featuregroup_version}", feature
        else:
            group, column = self._owner(feature, self._columns(store))
        return convert(self.spark.table(quoted(store, group)).select(column), dataframe_type)

    def get_features(
        self,
        features: Sequence[str],
        featurestore: str | None = None,
        featuregroups_version_dict: Mapping[str, int] | None = None,
        join_key: str | Sequence[str] | None = None,
        how: str = "inner",
        dataframe_type: str = "spark",
    ):
        """Features of any number of groups, joined on their common column.

        ``featuregroups_version_dict`` restricts the search to those groups. The result has the
        asked-for columns, under their bare names, and no others.
        """
        store = featurestore or self.database
        if featuregroups_version_dict:
            groups = [f"{g}_{v}" for g, v in featuregroups_version_dict.items()]
            columns = {g: self.spark.table(quoted(store, g)).columns for g in groups}
        else:
            columns = self._columns(store)
        chosen, names = self._place(features, columns, join_key)
        if len(chosen) == 1:
            (group, _), = chosen.items()
            return convert(self.spark.table(quoted(store, group)).select(*names), dataframe_type)
        keys = self._join_columns(store, chosen, columns, join_key)
        # Only keys and asked-for columns of each group enter the join.
        frames = [
            self.spark.table(quoted(store, g)).select(*keys, *[c for c in wanted if c not in keys])
            for g, wanted in chosen.items()
        ]
        joined = reduce(lambda left, right: left.join(right, on=keys, how=how), frames)
        return convert(joined.select(*names), dataframe_type)

    def sql(self, query: str, featurestore: str | None = None, dataframe_type: str = "spark"):
        """Spark SQL with the store as the current database."""
        return convert(self._in_store(query, featurestore), dataframe_type)

    def _in_store(self, query: str, featurestore: str | None = None) -> DataFrame:
        before = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(featurestore or self.database)
        try:
            return self.spark.sql(query)
        finally:
            self.spark.catalog.setCurrentDatabase(before)

    @staticmethod
    def _split(feature: str, columns: Mapping[str, Sequence[str]]) -> tuple[str | None, str]:
        """A qualified name is ``<group>_<version>.<feature>``."""
        prefix, _, column = feature.rpartition(".")
        if not prefix:
            return None, feature
        if prefix not in columns:
            raise ValueError(f"no feature group {prefix} for feature {feature}")
        return prefix, column

    def _owner(self, feature: str, columns: Mapping[str, Sequence[str]]) -> tuple[str, str]:
        group, column = self._split(feature, columns)
        owners = [group] if group else [g for g, cs in columns.items() if column in cs]
        if not owners or (group and column not in columns[group]):
            raise ValueError(f"no feature group has feature {feature}")
        if len(owners) > 1:
            raise ValueError(f"feature {feature} is in several groups, name one: {owners}")
        return owners[0], column

    def _place(self, features, columns, join_key) -> tuple[dict[str, list[str]], list[str]]:
        """Group -> wanted columns, and the output columns in the order asked for.

        A bare name that several groups have is placed once the other features have fixed the
        groups: a column of exactly one of these, or the column they all share.
        """
        chosen: dict[str, list[str]] = {}
        open_names, names = [], []
        fixed = [join_key] if isinstance(join_key, str) else list(join_key or ())
        for feature in features:
            group, column = self._split(feature, columns)
            names.append(column)
            owners = [group] if group else [g for g, cs in columns.items() if column in cs]
            if len(owners) == 1 and column not in fixed:
                owner, _ = self._owner(feature, columns)
                chosen.setdefault(owner, []).append(column)
            elif not owners:
                raise ValueError(f"no feature group has feature {feature}")
            else:
                open_names.append((feature, column, owners))
        for feature, column, owners in open_names:
            inside = [g for g in owners if g in chosen]
            if not chosen:
                owner, _ = self._owner(feature, columns)
                chosen[owner] = [column]
            elif len(inside) == 1 or (inside and len(inside) == len(chosen)):
                chosen[inside[0]].append(column)
            else:
                raise ValueError(f"feature {feature} is in several groups, name one: {inside or owners}")
        if len(set(names)) != len(names):
            raise ValueError(f"features repeat a column name: {names}")
        return chosen, names

    def _join_columns(self, store, chosen, columns, join_key) -> list[str]:
        if join_key:
            keys = [join_key] if isinstance(join_key, str) else list(join_key)
            lacking = {g: [k for k in keys if k not in columns[g]] for g in chosen}
            if any(lacking.values()):
                raise ValueError(f"join key {keys} is not in every group: {lacking}")
            return keys
        common = set.intersection(*[set(columns[g]) for g in chosen])
        if len(common) != 1:
            declared = [
                set(self._primary_key(quoted(store, g)))
                for g in chosen
            ]
            agreed = [d for d in declared if d and d <= common]
            if not agreed or any(d != agreed[0] for d in agreed):
                raise ValueError(
                    f"groups {list(chosen)} share the columns {sorted(common)}: name one as join_key"
                )
            common = agreed[0]
        return sorted(common)

    # Tags ---------------------------------------------------------------------------------------

    def _set_properties(self, table: str, properties: Mapping[str, str]) -> None:
        if not properties:
            return
        kind = "VIEW" if self._is_view(table) else "TABLE"
        listed = ", ".join(f"{literal(k)} = {literal(str(v))}" for k, v in properties.items())
        self.spark.sql(f"ALTER {kind} {table} SET TBLPROPERTIES ({listed})")

    def add_metadata(self, name: str, tags: Mapping[str, str], featuregroup_version: int = 1) -> None:
        table = self.table_name(name, featuregroup_version)
        self._set_properties(table, {f"{_TAG}{k}": v for k, v in tags.items()})

    def get_metadata(self, name: str, keys: Sequence[str] | None = None, featuregroup_version: int = 1) -> dict[str, str]:
        """All tags of a group, or the listed ones that exist."""
        properties = self._properties(self.table_name(name, featuregroup_version))
        tags = {k[len(_TAG):]: v for k, v in properties.items() if k.startswith(_TAG)}
        return tags if keys is None else {k: tags[k] for k in keys if k in tags}

    def remove_metadata(self, name: str, keys: Sequence[str], featuregroup_version: int = 1) -> None:
        table = self.table_name(name, featuregroup_version)
        kind = "VIEW" if self._is_view(table) else "TABLE"
        listed = ", ".join(literal(f"{_TAG}{k}") for k in keys)
        self.spark.sql(f"ALTER {kind} {table} UNSET TBLPROPERTIES IF EXISTS ({listed})")

    # Statistics and training data: the parts live in their own modules --------------------------

    def update_featuregroup_stats(
        self,
        name: str,
        featuregroup_version: int = 1,
        featurestore: str | None = None,
        descriptive_statistics: bool = True,
        feature_correlation: bool = True,
        feature_histograms: bool = True,
        cluster_analysis: bool = True,
        stat_columns: Sequence[str] | None = None,
        **settings,
    ) -> None:
        table = self.table_name(name, featuregroup_version, featurestore)
        self.statistics.update(
            f"{name}_{featuregroup_version}", self.spark.table(table), stat_columns, descriptive_statistics,
            feature_correlation, feature_histograms, cluster_analysis, point_id=self._primary_key(table), **settings,
        )

    def _restate(self, name: str, version: int) -> None:
        """Compute the statistics that a group has once more, with the same settings."""
        kept = self.statistics.settings(f"{name}_{version}")
        if kept.get("statistic_columns"):
            self.update_featuregroup_stats(
                name, version, None, kept["desc_stats_enabled"], kept["feat_corr_enabled"], kept["feat_hist_enabled"],
                kept["cluster_analysis_enabled"], kept["statistic_columns"],
                **{k: kept[k] for k in ("num_bins", "num_clusters", "corr_method", "cluster_points", "seed")},
            )

    def get_featuregroup_statistics(self, name: str, featuregroup_version: int = 1):
        return self.statistics.get(f"{name}_{featuregroup_version}")

    def create_training_dataset(self, df, name: str, **options) -> None:
        self.training.create(as_spark(self.spark, df), name, **options)

    def insert_into_training_dataset(self, df, name: str, training_dataset_version: int = 1, **options) -> None:
        self.training.insert(as_spark(self.spark, df), name, training_dataset_version, **options)

    def get_training_dataset(self, name: str, training_dataset_version: int = 1, dataframe_type: str = "spark"):
        return convert(self.training.read(name, training_dataset_version), dataframe_type)

    def get_training_dataset_path(self, name: str, training_dataset_version: int = 1) -> str:
        return self.training.path(name, training_dataset_version)

    def get_training_dataset_tf_record_schema(self, name: str, training_dataset_version: int = 1) -> dict:
        return self.training.record_schema(name, training_dataset_version)

    @staticmethod
    def get_dataframe_tf_record_schema(df: DataFrame) -> dict:
        from millrace.functions.types import record_schema

        return record_schema(df)

    def drop_training_dataset(self, name: str, training_dataset_version: int = 1) -> None:
        self.training.drop(name, training_dataset_version)

    def update_training_dataset_stats(self, name: str, training_dataset_version: int = 1, **options) -> None:
        self.training.update_stats(name, training_dataset_version, **options)

    def get_training_dataset_statistics(self, name: str, training_dataset_version: int = 1):
        return self.statistics.get(f"dataset:{name}_{training_dataset_version}")


def latest_version(versioned: Sequence[str], name: str) -> int:
    found = [_VERSIONED.match(v) for v in versioned]
    return max((int(m["version"]) for m in found if m and m["name"] == name), default=0)
