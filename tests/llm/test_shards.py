"""Minimax partitions against all partitions, and shards of whole tables."""

import collections
import itertools
import random
import zlib

import numpy as np
import pytest

from conftest import SF
from llm.test_operators import ODD, documents, frame
from millrace.llm import queries, shards


def plain_capacity(sizes, parts):
    """The smallest largest part of all ways to cut the list."""
    ends = [0, *itertools.accumulate(sizes)]
    best = [ends[k] for k in range(len(ends))]
    for _ in range(parts - 1):
        best = [min(max(best[j], ends[k] - ends[j]) for j in range(k + 1)) for k in range(len(ends))]
    return best[-1]


@pytest.mark.parametrize("cells", [1 << 15, 4])
def test_cuts(spark, monkeypatch, cells):
    random.seed(31)
    monkeypatch.setattr(shards, "CELLS", cells)
    monkeypatch.setattr(shards, "_FINER", 2)
    for n in (0, 1, 5, 40, 300):
        sizes = [random.choice([16, random.randint(16, 90), random.randint(16, 3000)]) for _ in range(n)]
        ends = list(itertools.accumulate(sizes))
        table = spark.createDataFrame([(e,) for e in ends], "end long").coalesce(2)
        for parts in (1, 2, 7):
            capacity, cuts = shards.find_cuts(table, sum(sizes), max(sizes, default=0), parts)
            assert capacity == plain_capacity(sizes, parts) and len(cuts) == parts - 1
            assert set(cuts) <= {0, *ends} and cuts == sorted(cuts)
            assert all(b - a <= capacity for a, b in itertools.pairwise([0, *cuts, sum(sizes)]))


def test_boundaries_remember_what_they_guessed():
    sums = shards.Boundaries(np.array([5, 20]), np.array([9, 20]), np.array([3, 3]))
    assert [sums.before(x) for x in (4, 9, 19, 20)] == [0, 9, 9, 20] and not sums.open
    assert sums.before(7) == 5 and sums.open == {0} and sums.after(7) == 9 and sums.after(10) == 20


def check(found, rows, parts):
    size = lambda text: len((text or "").encode()) + 16
    assert collections.Counter((r.id, r.size, r.text_crc32) for r in found) == collections.Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(some) == list(range(len(some))) for some in slots.values()) and set(slots) <= set(range(parts))
    of = collections.defaultdict(set)
    for r in found:
        of[r.size, r.text_crc32].add(r.shard)
    assert all(len(some) == 1 for some in of.values())
    sums = collections.Counter()
    for r in found:
        sums[r.shard] += r.size
    return sums


def test_groups_stay_whole(spark):
    random.seed(32)
    rows = [(i, "x" * random.randint(0, 400)) for i in range(400)]
    rows += [(1000 + i, "the same text again and again " * 10) for i in range(300)] + [(None, "no id"), (5, None), (5, None)]
    sums = check(shards.shard(frame(spark, rows), 8).collect(), rows, 8)
    large = 300 * 316
    rest = sorted(v for v in sums.values() if v != large)
    assert sums[0] == large and rest[-1] - rest[0] < 2000
    check(shards.shard(frame(spark, ODD).repartition(3), 40).collect(), ODD, 40)
    assert shards.shard(frame(spark, []), 4).count() == 0


def test_query(spark):
    found = queries.op13_sharding(spark, SF).withColumnRenamed("doc_id", "id").collect()
    sums = check(found, documents(), 40)
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    assert max(sums.values()) <= max(max(r.size for r in found), 1.5 * sum(sums.values()) / 40)
