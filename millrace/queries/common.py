"""Helpers of the registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.feature_store import FeatureStore

NO_STATS = {
    "descriptive_statistics": False,
    "feature_correlation": False,
    "feature_histograms": False,
    "cluster_analysis": False,
}

# Customer spending as a feature group; sums of cents are exact.
SPEND = (
    "SELECT o_custkey AS c_custkey, count(*) AS order_count, "
    "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_total FROM {orders} GROUP BY o_custkey"
)
URGENT = (
    "SELECT o_custkey AS c_custkey, count(*) AS urgent_count, max(o_totalprice) AS urgent_max FROM {orders} "
    "WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(sf_dir: str, name: str) -> str:
    """A table for SQL text."""
    return f"parquet.`{sf_dir}/{name}.parquet`"


def new_store(spark: SparkSession) -> FeatureStore:
    """A store of its own, so that queries of one session do not meet."""
    return FeatureStore(spark, f"q{uuid.uuid4().hex[:12]}")


def customer_store(spark: SparkSession, sf_dir: str) -> FeatureStore:
    """Views over the given tables: reads go to the files, nothing is copied."""
    store = new_store(spark)
    store.create_on_demand_featuregroup(
        f"SELECT * FROM {source(sf_dir, 'customer')}", "customer", primary_key=["c_custkey"]
    )
    store.create_on_demand_featuregroup(SPEND.format(orders=source(sf_dir, "orders")), "spend",
                                        primary_key=["c_custkey"])
    store.create_on_demand_featuregroup(URGENT.format(orders=source(sf_dir, "orders")), "urgent",
                                        primary_key=["c_custkey"])
    return store
