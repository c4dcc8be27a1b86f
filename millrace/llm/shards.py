"""Shards of near-equal size by a minimax contiguous partition of atomic groups.

Rows of one group (equal texts) stay together. Groups are ordered by their smallest id; a boundary
is the sum of sizes up to the end of a group. A group larger than an equal share of what is left has
a shard of its own. For the others the smallest capacity is searched by bisection: a capacity is
feasible if shards filled greedily, each up to the last boundary that fits, hold everything. The
order is then cut there: no shard exceeds that capacity, and among such cuts each takes the boundary
nearest to an equal share of the rest.

The boundaries, one per group, stay in a table. The driver sees cells of them: a grid over the sums,
with the smallest and largest boundary of each cell, at most ``CELLS`` of them. A search that needs
to look inside a cell gets it in 64 finer cells and starts again, until all it met is exact. So a
table of any size costs a few passes over its narrow rows and a bounded number of cells each time.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.work import partitions, stored

#: Cells of the first grid at most; each look inside a cell makes it ``2 ** _FINER``.
CELLS = 1 << 15
_FINER = 6


class Boundaries:
    """What is known of an increasing list of sums: cells with their smallest and largest member.

    ``before`` and ``after`` answer exactly, or by the nearest known member; in that case the cell is
    put on the list ``open``.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, level: np.ndarray):
        order = np.argsort(low)
        self.low, self.high, self.level = low[order], high[order], level[order]
        self.open: set[int] = set()

    def before(self, x: int) -> int:
        """The largest sum up to ``x``; 0 if there is none."""
        at = int(np.searchsorted(self.low, x, "right")) - 1
        if at < 0:
            return 0
        if self.high[at] <= x:
            return int(self.high[at])
        if self.low[at] < self.high[at]:
            self.open.add(at)
        return int(self.low[at])

    def after(self, x: int) -> int:
        """The smallest sum from ``x`` on; 0 for the start."""
        if x <= 0:
            return 0
        at = int(np.searchsorted(self.high, x))
        if self.low[at] >= x:
            return int(self.low[at])
        if self.low[at] < self.high[at]:
            self.open.add(at)
        return int(self.high[at])


def minimax_cuts(sums: Boundaries, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity, and the sums at which all shards but the last end."""

    def fits(capacity: int) -> bool:
        end = 0
        for _ in range(shards):
            end = sums.before(end + capacity)
            if end >= total:
                return True
        return False

    low, high = max(largest, -(-total // shards)), total
    while low < high:
        middle = (low + high) // 2
        if fits(middle):
            high = middle
        else:
            low = middle + 1
    # From behind: where a shard must end at the earliest, so that the rest still fits.
    least = [total]
    for _ in range(shards - 1):
        least.append(sums.after(least[-1] - low))
    cuts, end = [], 0
    for left, need in zip(range(shards, 1, -1), least[:0:-1]):
        share = end + (total - end) // left
        below, above = sums.before(share), sums.after(share)
        best = below if share - below <= above - share else above
        end = max(need, end, min(best, sums.before(end + low)))
        cuts.append(end)
    return low, cuts


def _cells(ends: DataFrame, level: int):
    """Smallest and largest sum of each cell of 2 ** level."""
    found = ends.groupBy(F.shiftright("end", level).alias("cell")).agg(F.min("end").alias("low"), F.max("end").alias("high"))
    rows = found.select("low", "high").collect()
    return np.array([r.low for r in rows], np.int64), np.array([r.high for r in rows], np.int64), np.full(len(rows), level)


def find_cuts(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """:func:`minimax_cuts` of a table of sums (``end`` long), looking only into the cells it needs."""
    level = max(0, (total // CELLS).bit_length())
    sums = Boundaries(*_cells(ends, level))
    while True:
        answer = minimax_cuts(sums, total, largest, shards)
        if not sums.open:
            return answer
        opened = np.array(sorted(sums.open))
        kept = np.ones(len(sums.low), bool)
        kept[opened] = False
        parts = [(sums.low[kept], sums.high[kept], sums.level[kept])]
        for one in np.unique(sums.level[opened]).tolist():
            cells = [(int(x) >> one,) for x in sums.low[opened[sums.level[opened] == one]]]
            wanted = ends.sparkSession.createDataFrame(cells, "cell long")
            inside = ends.join(F.broadcast(wanted), F.shiftright("end", one) == F.col("cell"), "left_semi")
            parts.append(_cells(inside, max(0, one - _FINER)))
        sums = Boundaries(*map(np.concatenate, zip(*parts)))


def _running(table: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``table`` with the sum of ``value`` up to each row in ``order``, by sorted ranges and their totals."""
    ranged = table.repartitionByRange(partitions(table.sparkSession), *order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    totals = ranged.groupBy("part").agg(F.sum(value).alias("all"))
    # One row per range and task.
    base = totals.withColumn("base", F.sum("all").over(Window.orderBy("part")) - F.col("all")).select("part", "base")
    inner = F.sum(value).over(Window.partitionBy("part").orderBy(*order))
    return ranged.withColumn("inner", inner).join(base, "part").withColumn(name, F.col("inner") + F.col("base")).drop("part", "inner", "base")


def shard(
    docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row, rows of equal texts in one shard.

    A row's size is its text's UTF-8 bytes and ``overhead``; a null text is empty. ``slot`` numbers
    the rows of a shard from 0. Null ids come first in the order; repeated rows are kept. With fewer
    groups than shards some shards have no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
    )
    rows = stored(rows, "sized")
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.min("id").alias("first")), "groups")
    # Groups larger than an equal share of the rest: fewer than there are shards.
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone, rest = [], total
    for group in groups.orderBy(F.desc("bytes"), "group").limit(shards - 1).collect():
        if group["bytes"] * (shards - len(alone)) <= rest:
            break
        alone.append(bytes(group["group"]))
        rest -= group["bytes"]
    own = F.coalesce(*[F.when(F.col("group") == F.lit(key), F.lit(i)) for i, key in enumerate(alone)], F.lit(None).cast("int"))
    others = groups.where(own.isNull())
    largest = others.agg(F.max("bytes")).first()[0] or 0
    ends = stored(_running(others, ["first", "group"], "bytes", "end").select("group", "end"), "ends")
    _, cuts = find_cuts(ends.select("end"), rest, largest, shards - len(alone))
    place = sum([(F.col("end") > cut).cast("int") for cut in cuts], F.lit(len(alone)))
    placed = rows.withColumn("own", own)
    # Rows of the large groups know their shard; the others look it up by group.
    placed = placed.where("own IS NOT NULL").withColumnRenamed("own", "shard").unionByName(
        placed.where("own IS NULL").drop("own").join(ends.select("group", place.alias("shard")), "group")
    )
    placed = stored(placed.drop("group").withColumn("part", F.shiftright("row", 33)), "placed")
    # Slots: the rows of the shard in earlier parts of the input, and the place in the own part.
    counts = placed.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inner = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return placed.withColumn("inner", inner).join(base, ["shard", "part"]).select(
        "id", "size", "text_crc32", "shard", (F.col("base") + F.col("inner")).alias("slot")
    )
