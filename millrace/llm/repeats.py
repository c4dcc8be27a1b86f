"""Repeated byte strings of 200 bytes and more, by hashes of windows at synchronised positions.

Doubling the ranks of every byte position would sort the corpus once per byte and round. Here only
*anchors* are ranked: of every window of ``size`` bytes, the k-gram with the smallest hash. Equal
windows have the same anchor at the same offset, so comparing anchors compares all windows, and
about one position in 85 is an anchor. The windows of one anchor are a run of starts.

This replaces prefix doubling: a "rank" below is a hash of the bytes, made anew in each round, not a
number from the ranks before. What is unique leaves:

1. rank by the k-gram at the anchor (32 bytes): anchors that no other shares are done;
2. rank by everything its windows cover: anchors that agree in it repeat in all their windows;
3. one of each such class and the rest are ranked by 96 bytes to the right and to the left of the
   anchor, which leaves the offsets at which a window could still be repeated;
4. blocks of eight windows at those offsets are ranked by the bytes that all eight share: if those
   are unique, so is every window; then by the bytes that they cover together: if those are not
   unique, no window is;
5. the windows of the other blocks are ranked by all their ``size`` bytes.

Ranks are keys of 128 bits where they decide (the anchor's k-gram is a half of them). Each is counted
inside the tasks before it is shuffled, so a string in a third of all documents is one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import column, steps, stored

GRAM, CONTEXT = 32, 96
#: Window starts that are hashed at once; longer texts are taken in such segments.
_SEGMENT = 1 << 17
_PLACE = (1 << 24) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TABLES: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        draw = np.random.default_rng(20)
        for i, base in enumerate(_BASES):
            powers = np.empty(_SEGMENT + 1024, np.uint64)
            inverse = np.empty_like(powers)
            for table, factor in ((powers, base), (inverse, pow(base, -1, 1 << 64))):
                value = 1
                for j in range(len(table)):
                    table[j] = value
                    value = value * factor & (1 << 64) - 1
            _TABLES[f"byte{i}"] = draw.integers(1, 1 << 63, 256, dtype=np.uint64)
            _TABLES[f"power{i}"], _TABLES[f"inverse{i}"] = powers, inverse
    return _TABLES


class Hashes:
    """Hashes of any substring of one segment, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int = 0):
        tables = _tables()
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(tables[f"byte{which}"][data] * tables[f"power{which}"][: len(data)], out=self._sum[1:])
        self._inverse = tables[f"inverse{which}"]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self._sum[end] - self._sum[start]) * self._inverse[start]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(29))


def _segments(data: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first window start, bytes) with all windows of ``size`` bytes in exactly one segment."""
    for start in range(0, len(data) - size + 1, _SEGMENT):
        yield start, data[start : start + _SEGMENT + size - 1]


def _anchors(data: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(anchor, first start, last start) of each run of windows with one anchor, and the hashes."""
    hashes, n = Hashes(data), len(data) - GRAM + 1
    start = np.arange(n)
    gram = hashes.of(start, start + GRAM)
    least = gram & ~np.uint64(_PLACE) | start.astype(np.uint64)
    width, span = size - GRAM + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        rest = width - span
        least = np.minimum(least[:-rest], least[rest:])
    anchor = (least & np.uint64(_PLACE)).astype(np.int64)
    turn = np.flatnonzero(np.diff(anchor)) + 1
    first, last = np.concatenate(([0], turn)), np.append(turn - 1, len(anchor) - 1)
    return anchor[first], first, last, gram[anchor[first]], hashes


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _bytes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for text in column(batch, "text").to_pylist():
        yield np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


#: place: anchor, and how far the first and the last window start before it; sides: 32 bits each.
_ANCHOR = "did long, tid long, place long, gram long, all long, sides long"
_BITS, _BLOCK = 12, 8


def _anchor_rows(rows: DataFrame, size: int) -> DataFrame:
    """A row per anchor. A half of ``sides`` is 0 where the text ends before the context does."""

    def made(batches):
        for batch in steps(batches, most=1 << 20):
            parts = []
            ids = zip(column(batch, "did").to_pylist(), column(batch, "tid").to_pylist())
            for (did, tid), data in zip(ids, _bytes_of(batch)):
                for at, part in _segments(data, size):
                    anchor, low, high, gram, one = _anchors(part, size)
                    right, left = anchor + CONTEXT, anchor - CONTEXT
                    after = one.of(anchor, np.minimum(right, len(part))) >> np.uint64(32)
                    before = one.of(np.maximum(left, 0), anchor) >> np.uint64(32)
                    after[right > len(part)] = 0
                    before[left < 0] = 0
                    parts.append((
                        np.full(len(anchor), did), np.full(len(anchor), tid),
                        (anchor + at) << 2 * _BITS | (anchor - low) << _BITS | (anchor - high),
                        gram.view(np.int64), Hashes(part, 1).of(low, high + size).view(np.int64),
                        (after << np.uint64(32) | before).view(np.int64),
                    ))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*parts)],
                    [field.split()[0] for field in _ANCHOR.split(", ")],
                )

    return rows.mapInArrow(made, _ANCHOR)


def _runs(batch: pa.RecordBatch, size: int):
    """(did, tid, segment's first start, bytes, runs that have starts in the segment) of each text."""
    ids = zip(column(batch, "did").to_pylist(), column(batch, "tid").to_pylist(), column(batch, "runs").to_pylist())
    for (did, tid, runs), data in zip(ids, _bytes_of(batch)):
        runs = np.array([tuple(r.values()) for r in runs], np.int64)  # low, high, anchor, gram, mark
        for at, part in _segments(data, size):
            own = runs[(runs[:, 0] >= at) & (runs[:, 0] < at + _SEGMENT)]
            if len(own):
                yield did, tid, at, part, own


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every integer from each low to its high, and the number of its pair."""
    count = high - low + 1
    pair = np.repeat(np.arange(len(low)), count)
    return np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + low[pair], pair


def _block_rows(rows: DataFrame, size: int) -> DataFrame:
    """A row per block of window starts, aligned by their distance from the anchor."""

    def made(batches):
        for batch in steps(batches, most=1 << 20):
            for did, tid, at, part, own in _runs(batch, size):
                low, high, anchor = own[:, 0] - at, own[:, 1] - at, own[:, 2] - at
                block, run = _spread((anchor - high) // _BLOCK, (anchor - low) // _BLOCK)
                first = np.maximum(low[run], anchor[run] - block * _BLOCK - _BLOCK + 1)
                last = np.minimum(high[run], anchor[run] - block * _BLOCK)
                # All windows of the block, also those beyond this run, hold these bytes.
                core = anchor[run] - block * _BLOCK
                one, two, n = Hashes(part), Hashes(part, 1), len(run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, did)), pa.array(np.full(n, tid)), pa.array(own[run, 3]), pa.array(own[run, 4] > 0),
                     pa.array(first + at), pa.array(last + at), pa.array(own[run, 2]), pa.array(block),
                     _signed(one.of(core, core - _BLOCK + 1 + size)), _signed(two.of(first, last + size))],
                    ["did", "tid", "gram", "mark", "low", "high", "anchor", "block", "core", "all"],
                )

    return rows.mapInArrow(
        made, "did long, tid long, gram long, mark boolean, low long, high long, anchor long, block long, core long, all long"
    )


def _window_rows(rows: DataFrame, size: int) -> DataFrame:
    """A row per window start in the runs of each text."""

    def made(batches):
        for batch in steps(batches, most=1 << 20):
            for did, tid, at, part, own in _runs(batch, size):
                start, run = _spread(own[:, 0] - at, own[:, 1] - at)
                n = len(run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, did)), pa.array(np.full(n, tid)), pa.array(own[run, 3]), pa.array(own[run, 4] > 0),
                     pa.array(start + at), _signed(Hashes(part, 1).of(start, start + size))],
                    ["did", "tid", "gram", "mark", "start", "all"],
                )

    return rows.mapInArrow(made, "did long, tid long, gram long, mark boolean, start long, all long")


def _with_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """One row of each id and text that has runs, with all of them; repeated rows have the same runs."""
    run = F.struct("low", "high", "anchor", "gram", F.col("mark").cast("long").alias("mark"))
    listed = runs.distinct().groupBy("did", "tid").agg(F.collect_list(run).alias("runs"))
    return rows.join(listed, ["did", "tid"]).dropDuplicates(["did", "tid"])


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).count().where("count > 1").drop("count")


def repeated_spans(docs: DataFrame, size: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, tid, low, high): starts ``low`` to ``high`` of windows that also start elsewhere.

    ``did`` is the id (null as the smallest long) and ``tid`` the hash of the text.
    """
    if not GRAM + CONTEXT <= size < 1 << _BITS:
        raise ValueError(f"strings must have {GRAM + CONTEXT} to {(1 << _BITS) - 1} bytes")
    rows = _keyed(docs, id_col, text_col)
    # Round 1: k-grams. The first scan sends keys only.
    grams = _repeated(_anchor_rows(rows, size), "gram")
    shared = stored(_anchor_rows(rows, size).join(grams, "gram"), "anchors")
    # Round 2: all that the windows of an anchor cover.
    classes = stored(
        shared.groupBy("gram", "all").agg(F.count("*").alias("n"), F.min(F.struct("did", "tid", "place", "sides")).alias("at")),
        "classes",
    )
    place, mask = F.col("place"), (1 << _BITS) - 1
    anchor = F.shiftright(place, 2 * _BITS)
    low, high = anchor - F.shiftright(place, _BITS).bitwiseAND(mask), anchor - place.bitwiseAND(mask)
    whole = shared.join(classes.where("n > 1").select("gram", "all"), ["gram", "all"], "left_semi")
    whole = stored(whole.select("did", "tid", low.alias("low"), high.alias("high")), "whole-runs")
    # Round 3: contexts of one of each class, where a k-gram has several classes.
    several = _repeated(classes, "gram")
    apart = classes.join(several, "gram").select(
        "gram", "at.*", (F.col("n") == 1).alias("mark"),
    ).select(
        "gram", "did", "tid", "mark", anchor.alias("anchor"), low.alias("low"), high.alias("high"),
        F.shiftrightunsigned("sides", 32).alias("right"), F.col("sides").bitwiseAND((1 << 32) - 1).alias("left"),
    )
    right = _repeated(apart.where("right != 0"), "gram", "right").withColumn("more_right", F.lit(True))
    left = _repeated(apart.where("left != 0"), "gram", "left").withColumn("more_left", F.lit(True))
    apart = apart.join(right, ["gram", "right"], "left").join(left, ["gram", "left"], "left")
    # A window reaches anchor - start bytes to the left; the rest of it lies to the right.
    most_left = F.when(F.col("more_left"), size).otherwise(CONTEXT - 1)
    most_right = F.when(F.col("more_right"), size).otherwise(CONTEXT - 1)
    apart = apart.select(
        "did", "tid", "gram", "mark", "anchor", F.greatest("low", F.col("anchor") - most_left).alias("low"),
        F.least("high", F.col("anchor") + most_right - size).alias("high"),
    ).where("low <= high")
    # Round 4: blocks of windows. A class that repeats anyway is there to be compared with.
    blocks = stored(_block_rows(_with_runs(rows, apart), size), "blocks")
    cores = _repeated(blocks, "gram", "block", "core")
    blocks = stored(blocks.join(cores, ["gram", "block", "core"], "left_semi"), "open-blocks")
    same = _repeated(blocks, "gram", "all").withColumn("same", F.lit(True))
    blocks = stored(blocks.join(same, ["gram", "all"], "left"), "judged-blocks")
    several = blocks.where("same AND mark").select("did", "tid", "low", "high")
    # Round 5: single windows. Blocks that repeat are still what others may partly repeat.
    windows = stored(_window_rows(_with_runs(rows, _open(blocks)), size), "windows")
    twice = windows.groupBy("gram", "all").agg(F.count("*").alias("n"), F.max("mark").alias("mark"))
    single = windows.where("mark").join(twice.where("n > 1 AND mark"), ["gram", "all"], "left_semi")
    single = stored(single.select("did", "tid", F.col("start").alias("low"), F.col("start").alias("high")), "single-runs")
    return whole.unionByName(several).unionByName(single)


def _open(blocks: DataFrame) -> DataFrame:
    """Blocks that are not judged, and one of each repeated kind that shares their common bytes."""
    key = ["gram", "block", "core"]
    todo = blocks.where("mark AND same IS NULL").select(*key).distinct()
    rest = blocks.where("NOT mark OR same").groupBy(*key, "all").agg(
        F.min(F.struct("did", "tid", "low", "high", "anchor")).alias("at")
    )
    rest = rest.join(todo, key, "left_semi").select("gram", "at.*", F.lit(False).alias("mark"))
    return blocks.where("mark AND same IS NULL").select(*rest.columns).unionByName(rest)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("did"), F.xxhash64(text).alias("tid"),
        F.col(id_col).cast("long").alias("id"), text.alias("text"),
    )


def merged(runs: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal byte spans covered by windows that start in the runs."""
    out: list[list[int]] = []
    for low, high in sorted((r["low"], r["high"] + size) for r in runs or ()):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, size: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row.

    Texts are UTF-8 bytes, null as empty. Every byte is removed that a string of ``size`` bytes
    covers which also starts anywhere else, in the same text too; ``spans`` lists the removed
    (start, end). Repeated rows of one id and text repeat each other.
    """
    runs = repeated_spans(docs, size, id_col, text_col).distinct().groupBy("did", "tid").agg(
        F.collect_list(F.struct("low", "high")).alias("runs")
    )
    rows = _keyed(docs, id_col, text_col).join(runs, ["did", "tid"], "left")

    def cut(batches):
        for batch in steps(batches):
            out = []
            for doc, text, found in zip(*(column(batch, c).to_pylist() for c in ("id", "text", "runs"))):
                data, kept, at = text.encode("utf-8", "surrogatepass"), hashlib.sha256(), 0
                spans = merged(found, size)
                for start, end in spans:
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                out.append((
                    doc, len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest(),
                    [{"start": a, "end": b} for a, b in spans],
                ))
            if out:
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                kinds = [pa.int64()] * 4 + [pa.string(), span]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
                )

    return rows.select("id", "text", "runs").mapInArrow(
        cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start: long, end: long>>",
    )
