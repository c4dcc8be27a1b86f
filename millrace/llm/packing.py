"""Packing of tokenised documents into sequences by shortest-pack-first over a length histogram.

Only the histogram, at most one count per length, is packed on the driver: lengths are placed
longest first into the packs that are filled least, and packs alike are one pattern with a count.
Patterns then meet their pieces by rank: pieces of a length are numbered, without ordering them all
in one task, and slice by slice take the places that the patterns have for that length.
"""

from __future__ import annotations

import heapq
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.token_counts import chunks
from millrace.llm.work import column, partitions, steps, stored

#: Remembered parts of a task; a full memory is emptied.
_MEMORY = 1_200_000
#: Text bytes whose words are made distinct at once.
_STEP = 16 << 20
#: Stands between parts that the library sees as one text; parts that hold it are encoded alone.
_MARK = "|"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class _Slots:
    """Lists of ids under numbers, in one growing array. Number 0 is the empty list."""

    def __init__(self):
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first, self.many = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.lists, self.used = 1, 0

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, len(array)), array.dtype)])

    def add(self, ids: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Numbers of new lists, whose ids follow each other."""
        end, lists = self.used + len(ids), self.lists + len(many)
        self.ids = self._room(self.ids, end)
        self.first, self.many = self._room(self.first, lists), self._room(self.many, lists)
        self.ids[self.used : end] = ids
        self.many[self.lists : lists] = many
        self.first[self.lists : lists] = self.used + np.cumsum(many) - many
        out = np.arange(self.lists, lists)
        self.lists, self.used = lists, end
        return out


def _gather(ids: np.ndarray, first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The ids of slices, one slice after the other."""
    before = np.cumsum(many) - many
    return ids[np.repeat(first - before, many) + np.arange(int(many.sum()))]


class ChunkTokens:
    """Ids of texts through the library of the file; what stands between white space is remembered.

    The tokenizer must lower-case texts, drop white space and cut there and between letters or digits
    and marks, so that a text's ids are those of its parts. Texts are split, and their words made
    distinct, in Arrow; only words not seen before reach the library, in lower case and without a
    mark at the end, and ids are gathered by arrays.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        self._encode = whole.encode_batch_fast
        self._forget()
        mark = self._of([_MARK])[0]
        if len(mark) != 1:
            raise ValueError(f"the tokenizer must have one id for {_MARK!r}")
        self._mark = int(mark[0])
        # Words of letters a to z only are neither changed nor cut: the model alone gives their ids.
        words = Tokenizer(whole.model)
        words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        probe = [f" {_MARK} ".join(["abcdefghijklmnopqrstuvwxyz", *"abcdefghijklmnopqrstuvwxyz", "the", "zqxj"])]
        same = np.array_equal(self._of(probe)[0], self._of(probe, words.encode_batch_fast)[0])
        self._encode_words = words.encode_batch_fast if same else self._encode

    def _forget(self) -> None:
        self._known: dict[str, int] = {"": 0}
        self._slots = _Slots()

    def _of(self, texts: list[str], encode=None) -> list[np.ndarray]:
        found = (encode or self._encode)(texts, add_special_tokens=False)
        return [np.array(encoding.ids, dtype=np.uint32) for encoding in found]

    def _learn(self, parts: list[str]) -> None:
        """Ids of new parts; those without a mark are encoded as one text with marks between them."""
        alone = [part for part in parts if _MARK in part]
        words = [part for part in parts if part.isascii() and part.isalpha()]
        rest = [part for part in parts if _MARK not in part and not (part.isascii() and part.isalpha())]
        for encode, listed in ((self._encode_words, words), (self._encode, rest)):
            for at in range(0, len(listed), 4096):
                some = listed[at : at + 4096]
                joined = self._of([f" {_MARK} ".join(some)], encode)[0]
                ends = np.flatnonzero(joined == self._mark)
                if len(ends) != len(some) - 1:
                    alone += some
                    continue
                many = np.diff(np.concatenate([[-1], ends, [len(joined)]])) - 1
                self._known.update(zip(some, self._slots.add(np.delete(joined, ends), many).tolist()))
        if alone:
            found = self._of(alone)
            numbers = self._slots.add(np.concatenate(found), np.array([len(ids) for ids in found]))
            self._known.update(zip(alone, numbers.tolist()))

    def _numbers(self, parts: pa.Array) -> np.ndarray:
        """Numbers of the id lists of parts, which may repeat."""
        distinct = parts.dictionary_encode()
        listed = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._known.get, listed))
        if None in found:
            new = [i for i, number in enumerate(found) if number is None]
            self._learn([listed[i] for i in new])
            for i in new:
                found[i] = self._known[listed[i]]
        return np.array(found, np.int64)[distinct.indices.to_numpy()]

    @staticmethod
    def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(text of each word, words): what lies between white space."""
        split = pc.utf8_split_whitespace(texts)
        odd = np.flatnonzero(np.asarray(pc.match_substring_regex(texts, "[\x1c-\x1f]")))
        if len(odd):
            # Separators that Arrow takes for white space and the library does not.
            listed = split.to_pylist()
            for row in odd:
                listed[row] = chunks(texts[int(row)].as_py())
            split = pa.array(listed, pa.list_(pa.large_string()))
        owner, words = np.asarray(pc.list_parent_indices(split), np.int64), split.flatten()
        full = np.asarray(pc.not_equal(words, ""))
        return owner[full], words.filter(pa.array(full))

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, ids): the ids of text i are those from bounds[i] to bounds[i + 1]; null is empty."""
        if len(self._known) > _MEMORY:
            self._forget()
        owner, words = self._words(pc.fill_null(texts, "").cast(pa.large_string()))
        distinct = words.dictionary_encode()
        plain = distinct.dictionary
        ascii_only = pc.and_(pc.string_is_ascii(plain), pc.invert(pc.match_substring(plain, _MARK)))
        lower = pc.if_else(ascii_only, pc.ascii_lower(plain), plain)
        marked = pc.and_(ascii_only, pc.match_substring_regex(lower, "[0-9a-z][.,;:!?]$"))
        # A word is a part and the mark at its end, or nothing.
        core = self._numbers(pc.if_else(marked, pc.utf8_slice_codeunits(lower, 0, -1), lower))
        tail = self._numbers(pc.if_else(marked, pc.utf8_slice_codeunits(lower, -1), ""))
        slots = self._slots
        parts = np.stack([core, tail], axis=1).ravel()
        own = _gather(slots.ids, slots.first[parts], slots.many[parts])
        many = slots.many[core] + slots.many[tail]
        first, index = np.cumsum(many) - many, distinct.indices.to_numpy()
        ids = _gather(own, first[index], many[index])
        sizes = np.bincount(owner, many[index], minlength=len(texts)).astype(np.int64)
        return np.concatenate([[0], np.cumsum(sizes)]), ids

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian bytes, text by text."""
        bounds, ids = self.ids_of(pa.array(texts, pa.large_string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


_TOKENS: dict[str, ChunkTokens] = {}


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document cut after each ``size`` ids."""

    def cut(batches):
        tokens = _TOKENS.setdefault(tokenizer, None) or ChunkTokens(tokenizer)
        _TOKENS[tokenizer] = tokens
        end = int(end_id).to_bytes(4, "little")
        for batch in steps(batches, most=_STEP):
            rows = []
            bounds, ids = tokens.ids_of(column(batch, "text"))
            ids, bounds = ids.astype("<u4", copy=False), bounds.tolist()
            for doc, low, high in zip(column(batch, "id").to_pylist(), bounds, bounds[1:]):
                total = high - low + 1
                for start in range(0, total, size):
                    stop = min(start + size, total)
                    crc = zlib.crc32(ids[low + start : min(low + stop, high)])
                    if stop == total:
                        crc = zlib.crc32(end, crc)
                    rows.append((doc, start, stop - start, crc, total))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(values), pa.int64()) for values in zip(*rows)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, _PIECES)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths longest first, number of packs) that place ``histogram[length]`` pieces each.

    Of the packs with the most room as many as needed take a piece; without room new packs open.
    """
    groups: dict[int, list[tuple[tuple, int]]] = {}  # room left -> patterns (lengths as linked pairs, packs)
    rooms: list[int] = []  # heap of rooms, largest first

    def put(room: int, lengths: tuple, packs: int) -> None:
        if room not in groups:
            groups[room] = []
            heapq.heappush(rooms, -room)
        groups[room].append((lengths, packs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or -rooms[0] < length:
                put(size - length, (length, None), left)
                break
            room = -rooms[0]
            lengths, packs = groups[room].pop()
            used = min(packs, left)
            if packs > used:
                groups[room].append((lengths, packs - used))
            if not groups[room]:
                del groups[room]
                heapq.heappop(rooms)
            put(room - length, (length, lengths), used)
            left -= used
    out = []
    for room in sorted(groups):
        for lengths, packs in groups[room]:
            shown = []
            while lengths:
                shown.append(lengths[0])
                lengths = lengths[1]
            out.append((shown[::-1], packs))
    return out


def _places(patterns: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Slices of ranks per length: which pattern, how many of that length in it, and from which offset."""
    rows, rank, first = [], {}, 0
    for lengths, packs in patterns:
        at, offset, fill = 0, 0, sum(lengths)
        while at < len(lengths):
            length = lengths[at]
            many = 1
            while at + many < len(lengths) and lengths[at + many] == length:
                many += 1
            low = rank.get(length, 0)
            rows.append((length, low, first, many, offset, fill))
            rank[length] = low + packs * many
            offset += many * length
            at += many
        first += packs
    names = ("length", "low", "first", "many", "offset", "fill")
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, len(names))
    return dict(zip(names, table.T))


def pack(
    docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece with its sequence and offset.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length): a sequence
    is padded to ``size`` (its sequence_length) unless its ids number a power of two. A null text is
    empty and has its end id only; repeated rows are packed as often as given; a null id stays null.
    """
    spark = docs.sparkSession
    rows = stored(pieces(docs, tokenizer, end_id, size, id_col, text_col), "pieces")
    slot = F.pmod(F.xxhash64("doc_id", "start"), F.lit(partitions(spark))).cast("int")
    rows = rows.withColumn("slot", slot)
    counts = stored(rows.groupBy("length", "slot").count(), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    place = _places(shortest_pack_first(histogram, size))
    # Ranks: the number of pieces of that length in earlier slots, and the place in the own slot.
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "slot").orderBy("doc_id", "start")
    ranked = (
        rows.withColumn("own", F.row_number().over(own) - 1).join(base, ["length", "slot"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("own")).alias("rank"))
    )

    def placed(batches):
        key = place["length"] << 48 | place["low"]
        for batch in batches:
            length, rank = column(batch, "length").to_numpy(), column(batch, "rank").to_numpy()
            at = np.searchsorted(key, length << 48 | rank, "right") - 1
            turn, fill = rank - place["low"][at], place["fill"][at]
            many = place["many"][at]
            found = (
                place["first"][at] + turn // many, place["offset"][at] + turn % many * length,
                np.where(fill & (fill - 1) == 0, fill, size),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *map(pa.array, found)],
                [*batch.schema.names[:5], "sequence_id", "offset", "sequence_length"],
            )

    return ranked.mapInArrow(placed, f"{_PIECES}, sequence_id long, offset long, sequence_length long")
