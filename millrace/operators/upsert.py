"""Keyed upsert for online copies of feature groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Newest row per key, as an aggregate: a key with most of the rows is reduced before the shuffle.

    A row without an order is older than any other.
    """
    payload = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in key])
    return rows.groupBy(*key).agg(F.max_by(payload, F.struct(F.col(f"`{order}`").alias("order"))).alias("_row")).select(*key, "_row.*").select(*rows.columns)


def single_changes(changes: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """One change per key: the newest by ``order``; without it a repeated key fails the job, as a null key always does."""
    keys = list(key)
    no_null = F.raise_error(F.lit(f"null in the key {keys} of a change"))
    changes = changes.withColumns({k: F.when(F.col(f"`{k}`").isNotNull(), F.col(f"`{k}`")).otherwise(no_null) for k in keys})
    return _single_by_key(changes, keys) if order is None else latest_by_key(changes, keys, order)


def merge_changes(base: DataFrame, changes: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """Base rows whose key did not change, and the changes, of which each key has one.

    A base that keeps the order column also keeps its row when that is newer than the change.
    """
    keys = list(key)
    if order is not None and order in base.columns:
        # Only base rows of changed keys are looked at, so few changes do not shuffle the base.
        present = base.join(changes.select(*keys), keys, "left_semi").select(*keys, F.col(f"`{order}`").alias("_present"))
        late = F.coalesce(F.col("_present") > F.col(f"`{order}`"), F.col(f"`{order}`").isNull())
        changes = changes.join(present, keys, "left").filter(F.col("_present").isNull() | ~late).drop("_present")
    kept = base.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.select(*base.columns))


def upsert(base: DataFrame, changes: DataFrame, key: Sequence[str], order: str | None = None) -> DataFrame:
    """Base rows whose key did not change, and the changes. A null key fails the job.

    With ``order`` the newest change of a key is taken, without it a repeated key fails the job. A
    base that keeps the order column also keeps its row when that is newer than the change; a base
    without it takes every change, so late batches need the column.
    """
    return merge_changes(base, single_changes(changes, key, order), key, order)


def _single_by_key(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows as they are; the job fails when a key has several. The shuffle is the one a join on the key needs."""
    repeated = F.raise_error(F.lit(f"several changes of one key {list(key)} and no order among them"))
    payload = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    one = F.when(F.count(F.lit(1)) == 1, F.first(payload)).otherwise(repeated)
    return rows.groupBy(*key).agg(one.alias("_row")).select("_row.*")
