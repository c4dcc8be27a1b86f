"""Statistics of groups and training datasets, kept as tables of the store.

Descriptive measures, Pearson correlations and histograms are kept as states that add up: moments of
pairs of columns, and counts of bins. An append adds the states of its own rows; reads merge them.
Only what does not add up is computed from all rows again: bins of a column whose range has grown,
rank correlations and clusters.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import numeric_columns
from millrace.operators import statistics as S

_STATE = ", ".join(f"{m} double" for m in (*S._MEASURES, *S._RANGE))
_SCHEMAS = {
    "moments": f"feature string, other string, {_STATE}, batch string",
    "bins": "feature string, low double, high double, bin int, frequency long, batch string",
    "ranks": "feature string, other string, correlation double",
    "cluster": "datapoint string, cluster int, first_dimension double, second_dimension double",
    "settings": "settings string",
}
FAMILIES = ("descriptive", "correlation", "histogram", "cluster")
#: States of so many appends are merged to one.
BATCHES = 16


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class StatisticsStore:
    """One table per kind of state, partitioned by entity: a re-run replaces one partition."""

    def __init__(self, store):
        self.store = store
        self.spark = store.spark

    def _name(self, kind: str) -> str:
        return f"`{self.store.database}`.`zz_stats_{kind}`"

    def _table(self, kind: str) -> str:
        name = self._name(kind)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({_SCHEMAS[kind]}, entity string) "
                "USING parquet PARTITIONED BY (entity)"
            )
        return name

    def _write(self, kind: str, entity: str, rows: DataFrame, append: bool = False) -> None:
        """Replace the partition of one entity, or add to it."""
        view = f"millrace_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            self.spark.sql(
                f"INSERT {'INTO' if append else 'OVERWRITE'} TABLE {self._table(kind)} "
                f"PARTITION (entity = {_literal(entity)}) SELECT * FROM {view}"
            )
        finally:
            self.spark.catalog.dropTempView(view)

    def _clear(self, kind: str, entity: str) -> None:
        if self.spark.catalog.tableExists(self._name(kind)):
            self.spark.sql(f"ALTER TABLE {self._name(kind)} DROP IF EXISTS PARTITION (entity = {_literal(entity)})")

    def _rows(self, kind: str, entity: str) -> DataFrame:
        """Rows of one entity; the filter prunes to its partition."""
        return self.spark.table(self._table(kind)).filter(F.col("entity") == entity).drop("entity")

    # Computing ----------------------------------------------------------------------------------

    def update(
        self,
        entity: str,
        df: DataFrame,
        stat_columns: Sequence[str] | None = None,
        descriptive_statistics: bool = True,
        feature_correlation: bool = True,
        feature_histograms: bool = True,
        cluster_analysis: bool = True,
        num_bins: int = S.HISTOGRAM_BINS,
        num_clusters: int = S.CLUSTERS,
        corr_method: str = "pearson",
        cluster_points: int | None = None,
        seed: int = 42,
        point_id: Sequence[str] = (),
    ) -> None:
        """Compute the switched-on families of all rows and keep them with the settings used.

        ``point_id`` names the columns that name a point of the cluster family.
        """
        columns = numeric_columns(df, stat_columns)
        if feature_correlation:
            S.check_matrix(columns)
        settings = {
            "desc_stats_enabled": descriptive_statistics,
            "feat_corr_enabled": feature_correlation,
            "feat_hist_enabled": feature_histograms,
            "cluster_analysis_enabled": cluster_analysis,
            "statistic_columns": columns,
            "num_bins": num_bins,
            "num_clusters": num_clusters,
            "corr_method": corr_method,
            "cluster_points": cluster_points,
            "seed": seed,
            "point_id": list(point_id),
        }
        for kind in _SCHEMAS:
            self._clear(kind, entity)
        if columns and self._adds_up(settings):
            self._add(entity, df, df, settings)
        if columns:
            self._from_all_rows(entity, df, settings)
        self._write("settings", entity, self.spark.createDataFrame([(json.dumps(settings),)], _SCHEMAS["settings"]))

    def append(self, entity: str, rows: DataFrame, all_rows: DataFrame) -> None:
        """Bring the kept families up to date after ``rows`` were appended, which made ``all_rows``."""
        settings = self.settings(entity)
        columns = settings.get("statistic_columns")
        if not columns:
            return
        if self._adds_up(settings):
            self._add(entity, rows, all_rows, settings)
        self._from_all_rows(entity, all_rows, settings)

    @staticmethod
    def _adds_up(settings: dict) -> bool:
        return (
            settings["desc_stats_enabled"] or settings["feat_hist_enabled"]
            or settings["feat_corr_enabled"] and settings["corr_method"] == "pearson"
        )

    def _add(self, entity: str, rows: DataFrame, all_rows: DataFrame, settings: dict) -> None:
        """Add the states of ``rows``; bins of columns whose range they widen are counted in ``all_rows``."""
        columns, bins = settings["statistic_columns"], settings["num_bins"]
        pairs = settings["feat_corr_enabled"] and settings["corr_method"] == "pearson"
        # At most a row per pair of columns: kept on the driver, as it is needed twice.
        state = S.merged(S.moments(rows, columns, pairs))
        state = self.spark.createDataFrame(state.collect(), state.schema)
        batch = uuid.uuid4().hex
        self._write("moments", entity, state.withColumn("batch", F.lit(batch)), append=True)
        if settings["feat_hist_enabled"]:
            known, limits = self._limits(entity), self._extent(entity)
            same = {c: limit for c, limit in limits.items() if known.get(c) == limit}
            grown = {c: limit for c, limit in limits.items() if c not in same}
            found = [S.bin_counts(part, some, bins) for part, some in ((rows, same), (all_rows, grown)) if some]
            kept = self._rows("bins", entity).filter(F.col("feature").isin(list(same)))
            # Counts by feature and bin, few whatever the rows.
            kept = self.spark.createDataFrame(kept.collect(), _SCHEMAS["bins"])
            for counts in found:
                counts = counts.groupBy("feature", "bin").agg(F.sum("frequency").alias("frequency"))
                edges = self.spark.createDataFrame([(c, float(a), float(b)) for c, (a, b) in limits.items()], "feature string, low double, high double")
                # A column without a finite value in these rows still has its limits.
                counts = edges.join(counts, "feature").select("feature", "low", "high", "bin", "frequency", F.lit(batch).alias("batch"))
                kept = kept.unionByName(counts)
            self._write("bins", entity, kept)
        self._compact(entity)

    def _from_all_rows(self, entity: str, df: DataFrame, settings: dict) -> None:
        columns = settings["statistic_columns"]
        if settings["feat_corr_enabled"] and settings["corr_method"] != "pearson":
            self._write("ranks", entity, S.correlation_matrix(df, columns, settings["corr_method"]))
        if settings["cluster_analysis_enabled"]:
            points = S.cluster_analysis(
                df, columns, settings["num_clusters"], settings["seed"], settings["point_id"] or None, settings["cluster_points"]
            )
            self._write("cluster", entity, points)

    def _compact(self, entity: str) -> None:
        """Merge the states of many appends to one."""
        states = self._rows("moments", entity)
        if states.select("batch").distinct().count() >= BATCHES:
            one = S.merged(states)
            one = self.spark.createDataFrame(one.collect(), one.schema).withColumn("batch", F.lit(uuid.uuid4().hex))
            self._write("moments", entity, one)

    def _extent(self, entity: str) -> dict[str, tuple[float, float]]:
        """Finite range of each column that has one."""
        own = self._rows("moments", entity).filter(F.col("feature") == F.col("other"))
        rows = own.groupBy("feature").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo IS NOT NULL").collect()
        return {r.feature: (r.lo, r.hi) for r in rows}

    def _limits(self, entity: str) -> dict[str, tuple[float, float]]:
        """Limits that the kept bins were counted with."""
        rows = self._rows("bins", entity).select("feature", "low", "high").distinct().collect()
        return {r.feature: (r.low, r.high) for r in rows}

    # Reading ------------------------------------------------------------------------------------

    def frame(self, family: str, entity: str) -> DataFrame:
        """One family of one entity, merged from the kept states; no rows if it was switched off."""
        if family not in FAMILIES:
            raise ValueError(f"no statistics family {family!r}, only {FAMILIES}")
        settings = self.settings(entity)
        columns = settings.get("statistic_columns", [])
        switched_on = {
            "descriptive": "desc_stats_enabled", "correlation": "feat_corr_enabled", "histogram": "feat_hist_enabled",
            "cluster": "cluster_analysis_enabled",
        }
        on = bool(columns) and settings.get(switched_on[family], False)
        if family == "cluster":
            found = self._rows("cluster", entity)
        elif family == "histogram":
            found = S.binned(self._rows("bins", entity), self._limits(entity), settings.get("num_bins", S.HISTOGRAM_BINS))
        elif family == "correlation" and settings.get("corr_method") == "spearman":
            found = self._rows("ranks", entity)
        else:
            state = S.merged(self._rows("moments", entity))
            found = S.measures_of(state, columns) if family == "descriptive" else S.correlations_of(state)
        return found if on else found.limit(0)

    def settings(self, entity: str) -> dict:
        """Settings of the last computation; empty if there was none."""
        if not self.spark.catalog.tableExists(self._name("settings")):
            return {}
        row = self._rows("settings", entity).first()
        return json.loads(row.settings) if row else {}

    def get(self, entity: str, points: int = 1000) -> SimpleNamespace:
        """Nested statistics for a chart: lists bounded by columns, bins and ``points``.

        The lists of clusters have at most so many points, chosen by hash; ``cluster_analysis.frame``
        has all of them.
        """
        descriptive = (
            self.frame("descriptive", entity).groupBy(F.col("feature").alias("feature_name"))
            .agg(F.collect_list(F.struct(F.col("metric").alias("metric_name"), "value")).alias("metric_values"))
            .orderBy("feature_name").collect()
        )
        correlation = (
            self.frame("correlation", entity).groupBy(F.col("feature").alias("feature_name"))
            .agg(F.collect_list(F.struct(F.col("other").alias("feature_name"), "correlation"))
                 .alias("correlation_values"))
            .orderBy("feature_name").collect()
        )
        histogram = (
            self.frame("histogram", entity).groupBy(F.col("feature").alias("feature_name"))
            .agg(F.array_sort(F.collect_list(F.struct("bin", "bin_label", "frequency"))).alias("bins"))
            .select("feature_name", F.transform(
                "bins", lambda b: F.struct(b.bin_label.cast("string").alias("bin"), b.frequency.alias("frequency"))
            ).alias("frequency_distribution"))
            .orderBy("feature_name").collect()
        )
        frame = self.frame("cluster", entity)
        shown = frame.orderBy(F.xxhash64("datapoint"), "datapoint").limit(points).collect()
        shown.sort(key=lambda p: p.datapoint)
        return SimpleNamespace(
            descriptive_stats=SimpleNamespace(descriptive_stats=descriptive),
            correlation_matrix=SimpleNamespace(feature_correlations=correlation),
            feature_histograms=SimpleNamespace(feature_distributions=histogram),
            cluster_analysis=SimpleNamespace(
                clusters=[SimpleNamespace(datapoint_name=p.datapoint, cluster=p.cluster) for p in shown],
                datapoints=[
                    SimpleNamespace(datapoint_name=p.datapoint, first_dimension=p.first_dimension,
                                    second_dimension=p.second_dimension)
                    for p in shown
                ],
                frame=frame,
            ),
            settings=self.settings(entity),
        )

    def drop(self, entity: str) -> None:
        for kind in _SCHEMAS:
            self._clear(kind, entity)
