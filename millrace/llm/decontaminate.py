"""Benchmark items in documents: SimHash of item-sized windows, then the exact similarity.

Words are lower-cased and stripped of ASCII punctuation. An item of n words is compared with windows
of n words: the SimHash of a window's shingles must lie within the radius of the item's, and then
the weighted Jaccard similarity of both shingle multisets decides. Item fingerprints are indexed by
radius + 1 blocks of bits, of which at least one agrees whole within the radius, so the index loses
none. Windows without any shingle of an item have similarity zero; no fingerprint is made of them.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import column, steps, texts_of

_TO_SPACE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22


class _WordHashes(dict):
    """Hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = out * _FACTOR + hashes[i : i + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _fingerprints(ones: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


class ItemIndex:
    """Benchmark items with their shingle multisets and fingerprints, in Hamming blocks."""

    def __init__(self, items: list[tuple[int | None, str]], words: int, radius: int):
        self.radius, hashes = radius, _WordHashes()
        self.ids, self.size, self.width, self.weights = [], [], [], []
        prints, members, owners = [], [], []
        for item_id, text in items:
            own = np.array([hashes[w] for w in words_of(text or "")], np.uint64)
            if not len(own):
                continue
            size = min(words, len(own))
            made = shingles(own, size)
            self.ids.append(item_id)
            self.size.append(size)
            self.width.append(len(made))
            self.weights.append(Counter(made.tolist()))
            prints.append(int(_fingerprints(_bits(made).sum(axis=0, dtype=np.int64)[None], np.array([len(made)]))[0]))
            distinct = np.unique(made)
            members.append(distinct)
            owners.append(np.full(len(distinct), len(self.ids) - 1))
        self.prints = np.array(prints, np.uint64)
        shingle = np.concatenate(members) if members else np.zeros(0, np.uint64)
        order = np.argsort(shingle, kind="stable")
        self.shingle = shingle[order]
        self.owner = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.shingle >> np.uint64(64 - _FILTER_BITS)] = True
        edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
        self.blocks = [(low, (1 << (high - low)) - 1) for low, high in zip(edges, edges[1:])]
        keys = np.concatenate([self._keys(self.prints, i) for i in range(len(self.blocks))])
        order = np.argsort(keys, kind="stable")
        self.keys, self.listed = keys[order], order % max(1, len(self.prints))

    def _keys(self, prints: np.ndarray, block: int) -> np.ndarray:
        low, mask = self.blocks[block]
        return np.int64(block) << 56 | (prints >> np.uint64(low) & np.uint64(mask)).astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item) within the radius."""
        pairs = []
        for block in range(len(self.blocks)):
            key = self._keys(prints, block)
            low, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, "right")
            count = high - low
            window = np.repeat(np.arange(len(prints)), count)
            place = np.arange(len(window)) + np.repeat(low - (np.cumsum(count) - count), count)
            item = self.listed[place]
            close = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
            pairs.append(window[close] * len(self.prints) + item[close])
        both = np.unique(np.concatenate(pairs))
        return both // len(self.prints), both % len(self.prints)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) wherever a shingle is one of an item's."""
        position = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.shingle, hashes[position])
        count = np.searchsorted(self.shingle, hashes[position], "right") - low
        place = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
        return np.repeat(position, count), self.owner[place]

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Sum of the smaller over sum of the larger multiplicities."""
        own, other = self.weights[item], Counter(window.tolist())
        shared = sum(min(n, own[h]) for h, n in other.items() if h in own)
        return shared / (self.width[item] + len(window) - shared)


def _windows(position: np.ndarray, width: int, n: int) -> np.ndarray:
    """Starts of the windows of ``width`` shingles, of ``n``, that hold one of the positions."""
    if n <= width:
        return np.zeros(1, np.int64)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.maximum(position - width + 1, 0), 1)
    np.add.at(change, position + 1, -1)
    return np.flatnonzero(np.cumsum(change)[: n - width + 1])


def find(index: ItemIndex, hashes: np.ndarray, similarity: float) -> dict[int, tuple[float, int, int]]:
    """item number -> (similarity, first word, end word) of its best window in a text, if good enough."""
    best: dict[int, tuple[float, int, int]] = {}
    for size in set(index.size):
        made = shingles(hashes, size)
        position, item = index.hits(made) if len(made) else (np.zeros(0, np.int64),) * 2
        sizes = {index.width[i] for i in set(item.tolist()) if index.size[i] == size}
        for width in sizes:
            own = position[[index.width[i] == width and index.size[i] == size for i in item]]
            starts = _windows(own, width, len(made))
            shown = min(width, len(made))
            for at in range(0, len(starts), 4096):
                some = starts[at : at + 4096]
                # Shingles between two far windows are skipped: places count only what is covered.
                covered = np.unique((some[:, None] + np.arange(shown)[None]).ravel()) if len(some) < some[-1] - some[0] else np.arange(some[0], some[-1] + shown)
                sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(_bits(made[covered]), axis=0, dtype=np.int32)])
                low = np.searchsorted(covered, some)
                prints = _fingerprints(sums[low + shown] - sums[low], np.full(len(some), shown))
                for window, number in zip(*index.near(prints)):
                    if index.width[number] != width or index.size[number] != size:
                        continue
                    start = int(some[window])
                    found = index.similarity(number, made[start : start + shown])
                    if found >= similarity and found > best.get(number, (0.0,))[0]:
                        best[number] = (found, start, start + shown + size - 1)
    return best


def _indexes(benchmark: DataFrame, words: int, radius: int, block_items: int, item_col: str, text_col: str):
    """Indexes of the benchmark's blocks that have words; a block has about ``block_items`` items."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    blocks = max(1, -(-benchmark.count() // block_items))
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        index = ItemIndex([(r["item"], r["text"]) for r in chosen.toLocalIterator()], words, radius)
        if index.ids:
            yield index


def contaminated(
    docs: DataFrame, benchmark: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 16,
    block_items: int = 10_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item_id, similarity, start_word, end_word): the best window of each item found in a document.

    Items are sent to the tasks in blocks of about ``block_items`` by hash, one pass over the
    documents per block, so that a broadcast has a bound. Items with fewer than ``words`` words are
    one shingle and are found whole; items and texts without words or null match nothing. A window of
    similarity 0.8 lies beyond 16 bits with probability below 0.01, and shifted windows of the same
    passage have further chances. Repeated rows are reported as often as given.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, item_id long, similarity double, start_word long, end_word long"
    found = []
    for index in _indexes(benchmark, words, radius, block_items, item_col, item_text_col):

        def searched(batches, index=index):
            known = _WordHashes()
            for batch in steps(batches):
                out = []
                for doc, text in zip(column(batch, "id").to_pylist(), texts_of(batch)):
                    cut = words_of(text)
                    hashes = np.fromiter(map(known.__getitem__, cut), np.uint64, len(cut))
                    for number, (score, start, end) in find(index, hashes, similarity).items():
                        out.append((doc, index.ids[number], score, start, end))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)],
                        ["id", "item_id", "similarity", "start_word", "end_word"],
                    )

        found.append(rows.mapInArrow(searched, schema))
    out = found[0] if found else rows.sparkSession.createDataFrame([], schema)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 16,
    block_items: int = 10_000, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; each row is judged by its text alone."""
    for index in _indexes(benchmark, words, radius, block_items, item_col, item_text_col):

        def clean(texts, index=index):
            known = _WordHashes()
            hashed = (np.array([known[w] for w in words_of(text or "")], np.uint64) for text in texts)
            return texts.__class__([not find(index, hashes, similarity) for hashes in hashed], dtype=bool)

        docs = docs.where(F.pandas_udf(clean, "boolean")(F.col(text_col)))
    return docs
