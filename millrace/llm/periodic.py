"""Periodic runs of words, found by longest common extensions on suffix trees.

A run is a stretch of words with a smallest period that no neighbour extends. Every run has a Lyndon
root: the longest Lyndon word that starts there, in the order of the words or in its reverse. It ends
before the next smaller (or greater) suffix, so each position has two candidate periods. A candidate
is extended to the right on the suffix tree of the document and to the left on that of its reversal.
Both trees are built by Ukkonen's algorithm; two suffixes agree as far as the least string depth on
the Euler tour between their leaves, which a table of ranges answers in constant time.

Before trees are made, whole batches drop the words that no run can hold: a run of exponent four has
each of its words four times. Documents are cut at rarer words, and the pieces again, until nothing
changes; a run always lies in one piece, so none is lost, and prose leaves next to nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import column, steps

#: A run is at least so many words and so many periods long.
LEAST_WORDS, LEAST_PERIODS = 6, 4


class SuffixTree:
    """Suffix tree of a sequence of numbers; the end counts as smaller than all of them."""

    def __init__(self, symbols: list[int]):
        size = self.size = len(symbols)
        text = [*symbols, -1]
        width = max(symbols, default=0) + 2
        # Node 0 is the root, inner nodes follow; leaves are negative: ~k is that of suffix k.
        edge: dict[int, int] = {}  # node * width + first symbol + 1 -> node below
        start, stop, link, depth = [0], [0], [0], [0]
        leaf_start: list[int] = []
        find = edge.get
        node = length = at = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            made = 0
            while waiting:
                if not length:
                    at = i
                key = node * width + text[at] + 1
                below = find(key)
                if below is None:
                    edge[key] = ~len(leaf_start)
                    leaf_start.append(i)
                    if made:
                        link[made] = node
                        made = 0
                else:
                    if below >= 0:
                        first = start[below]
                        known = stop[below] - first
                        if length >= known:
                            at += known
                            length -= known
                            node = below
                            continue
                    else:
                        first = leaf_start[~below]
                    other = text[first + length]
                    if other == symbol:
                        length += 1
                        if made:
                            link[made] = node
                        break
                    fresh = len(start)
                    start.append(first)
                    stop.append(first + length)
                    link.append(0)
                    depth.append(waiting - 1)
                    edge[key] = fresh
                    edge[fresh * width + symbol + 1] = ~len(leaf_start)
                    leaf_start.append(i)
                    edge[fresh * width + other + 1] = below
                    if below >= 0:
                        start[below] = first + length
                    else:
                        leaf_start[~below] = first + length
                    if made:
                        link[made] = fresh
                    made = fresh
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - waiting + 1
        self._tour(edge, width, depth)

    def _tour(self, edge: dict[int, int], width: int, depth: list[int]) -> None:
        """Leaves in the order of an Euler tour, and the depth where it turns between neighbours."""
        keys = np.fromiter(edge.keys(), np.int64, len(edge))
        order = np.argsort(keys)
        below = np.fromiter(edge.values(), np.int64, len(edge))[order]
        first = np.searchsorted(keys[order] // width, np.arange(len(depth) + 1)).tolist()
        below = below.tolist()
        leaves, turns = [], [0]
        waiting = [(0, 0)]
        while waiting:
            node, turn = waiting.pop()
            turns[-1] = turn
            while node >= 0:
                low, high = first[node], first[node + 1]
                turn = depth[node]
                for child in below[high - 1 : low : -1]:
                    waiting.append((child, turn))
                node = below[low]
            leaves.append(~node)
            turns.append(0)
        #: Place of each suffix in their order; the empty suffix has the last entry.
        self.rank = np.empty(self.size + 1, np.int64)
        self.rank[leaves] = np.arange(self.size + 1)
        least = np.array(turns[:-1], np.int32)
        self._least = [least]
        step = 1
        while 2 * step <= self.size + 1:
            least = np.minimum(least[:-step], least[step:])
            self._least.append(least)
            step *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes ``a`` and ``b`` share; places may be ``size``, and a pair must differ."""
        low, high = self.rank[a], self.rank[b]
        low, high = np.minimum(low, high) + 1, np.maximum(low, high) + 1  # turns between the two leaves
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for one in np.unique(level):
            at = np.flatnonzero(level == one)
            row = self._least[one]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << one)])
        return out


def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller value, or the end."""
    out = [len(rank)] * len(rank)
    open_places: list[int] = []
    for i, value in enumerate(rank):
        while open_places and rank[open_places[-1]] > value:
            out[open_places.pop()] = i
        open_places.append(i)
    return out


def runs_of(symbols: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """Runs (start, length, period) of a sequence of numbers from 0, by start, then period.

    Only those with ``least`` places and ``periods`` (two or more) periods at least.
    """
    size = len(symbols)
    if size < max(least, periods, 2):
        return np.empty((0, 3), np.int64)
    listed = symbols.tolist()
    ahead, back = SuffixTree(listed), SuffixTree(listed[::-1])
    rank = ahead.rank[:size]
    begin = np.tile(np.arange(size), 2)
    # Lyndon roots end before the next smaller suffix; in the reverse order before the next greater.
    end = np.array(_next_smaller(rank.tolist()) + _next_smaller((-rank).tolist()))
    period = end - begin
    # In the reverse order nothing ends a root at the end of the text; runs up to there have the other one.
    short = (period * periods <= size) & ((end < size) | (np.arange(2 * size) < size))
    begin, end, period = begin[short], end[short], period[short]
    right = ahead.common(begin, end)
    left = back.common(size - begin, size - end)
    length = left + period + right
    kept = length >= np.maximum(least, periods * period)
    found = np.stack([begin - left, length, period], axis=1)[kept]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    return found[np.append(True, (np.diff(found, axis=0) != 0).any(axis=1))] if len(found) else found


def _pieces(owner: np.ndarray, word: np.ndarray, least: int, periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that a run may hold, and the piece of each: its words occur ``periods`` times in the piece."""
    place = np.arange(len(word))
    piece = owner
    wide = int(word.max(initial=0)) + 1
    while len(place):
        _, group, count = np.unique(piece * wide + word[place], return_inverse=True, return_counts=True)
        kept = count[group] >= periods
        before = len(place)
        place, piece = place[kept], piece[kept]
        turn = np.ones(len(place), bool)
        turn[1:] = (np.diff(place) > 1) | (np.diff(piece) > 0)
        piece = np.cumsum(turn) - 1
        large = np.bincount(piece)[piece] >= least if len(piece) else np.zeros(0, bool)
        place, piece = place[large], piece[large]
        if len(place) == before:
            break
    return place, piece


def _batch_runs(owner: np.ndarray, word: np.ndarray, least: int, periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs (owner, place, length, period) of all documents of a batch."""
    place, piece = _pieces(owner, word, least, periods)
    found = [np.empty((0, 4), np.int64)]
    if len(place):
        of = owner[place]
        for part in np.split(np.arange(len(place)), np.flatnonzero(np.diff(of)) + 1):
            # Pieces of a document stand side by side, with a symbol of its own after each.
            own, at = piece[part] - piece[part[0]], place[part]
            shift = np.arange(len(part)) + own
            _, number = np.unique(word[at], return_inverse=True)
            symbols = np.full(shift[-1] + 1, -1)
            symbols[shift] = number
            gaps = np.flatnonzero(symbols < 0)
            symbols[gaps] = number.max() + 1 + np.arange(len(gaps))
            runs = runs_of(symbols, least, periods)
            if len(runs):
                origin = np.zeros(len(symbols), np.int64)
                origin[shift] = at
                runs[:, 0] = origin[runs[:, 0]]
                found.append(np.column_stack([np.full(len(runs), of[part[0]]), runs]))
    return np.concatenate(found)


def periodic_runs(
    docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, runs, collapsed) of every row.

    ``runs`` has (start, length, period) in words from 0, by start, then period, of all runs with at
    least ``least`` words and ``periods`` periods. ``collapsed`` is the text with one space between
    words and without those that a run holds after its first period. Words are what lies between
    ASCII white space; null and empty texts have none, and an empty ``collapsed``. Repeated rows and
    rows without id are returned as often as given. Memory grows with the longest document only.
    """

    def found(batches):
        for batch in steps(batches):
            texts = pc.fill_null(column(batch, "text"), "").cast(pa.large_string())
            split = pc.ascii_split_whitespace(texts)
            owner = np.asarray(pc.list_parent_indices(split), np.int64)
            words = split.flatten()
            full = np.asarray(pc.not_equal(words, ""))
            owner, words = owner[full], words.filter(pa.array(full))
            word = np.asarray(words.dictionary_encode().indices, np.int64)
            runs = _batch_runs(owner, word, least, periods)
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            # A run's words after its first period go: +1 where such a stretch begins, -1 where it ends.
            change = np.zeros(len(word) + 1, np.int64)
            np.add.at(change, runs[:, 1] + runs[:, 3], 1)
            np.add.at(change, runs[:, 1] + runs[:, 2], -1)
            kept = np.cumsum(change[:-1]) == 0
            held = np.concatenate([[0], np.cumsum(kept)])[first]
            joined = pc.binary_join(
                pa.LargeListArray.from_arrays(pa.array(held), words.filter(pa.array(kept))), pa.scalar(" ", pa.large_string())
            )
            of = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1))
            start = runs[:, 1] - first[runs[:, 0]]
            listed = pa.ListArray.from_arrays(
                pa.array(of, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(runs[:, 2]), pa.array(runs[:, 3])], ["start", "length", "period"]
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), listed, joined.cast(pa.string())], ["id", "runs", "collapsed"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        found, "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
