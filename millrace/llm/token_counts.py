"""Token counts of byte-pair tokenizers without making tokens.

Texts are normalised and cut into pieces as the tokenizer's file says; a piece starts as one symbol
per byte, and its adjacent pairs wait in a heap by merge rank. Symbols form a doubly linked list.
Merging pops the lowest rank, leftmost on ties, until no known pair is left: the count of a piece is
its initial symbols minus its merges. Counts of pieces are remembered in each task.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import column, steps

#: Separators that ``str.split`` takes for white space and Unicode's property does not.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
_SPACES = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Remembered pieces of a task; a full memory is emptied.
_MEMORY = 400_000


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def chunks(text: str) -> list[str]:
    """What lies between white space."""
    if any(c in text for c in _NOT_SPACE):
        return [chunk for chunk in _SPACES.split(text) if chunk]
    return text.split()


class PairMerges:
    """Merge ranks over symbol numbers; ``count`` merges one piece."""

    def __init__(self, merges: list, end_of_word: str = ""):
        self._number: dict[str, int] = {}
        self._pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self._end = end_of_word
        self._letters = _byte_letters()
        number = self._number.setdefault
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = number(left, len(self._number)), number(right, len(self._number))
            self._pairs.setdefault((a, b), (rank, number(left + right, len(self._number))))

    def count(self, piece: str) -> int:
        letters = [self._letters[b] for b in piece.encode("utf-8", "surrogatepass")]
        if not letters:
            return 0
        letters[-1] += self._end
        # Letters in no merge get numbers of no pair.
        symbol = [self._number.get(letter, -1) for letter in letters]
        known, n = self._pairs, len(symbol)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if found := known.get((symbol[i], symbol[i + 1])):
                heap.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # an entry of symbols that have been merged since
            merges += 1
            symbol[i], symbol[j] = made, -2
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := known.get((made, symbol[k])):
                    heapq.heappush(heap, (found[0], i, made, symbol[k], found[1]))
            if (h := before[i]) >= 0 and (found := known.get((symbol[h], made))):
                heapq.heappush(heap, (found[0], h, symbol[h], made, found[1]))
        return n - merges


class TokenCounter:
    """Counts as the tokenizer of a ``tokenizers`` file gives them, without added special tokens.

    Files with a Split pattern over byte-level pieces and these normalisers are read: NFC, Lowercase
    and white space as one space. Special strings in a text are one token each, as is the default.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = self._kinds(spec.get("normalizer"))
        if unknown := [k for k in kinds if k not in ("NFC", "Lowercase", "Replace")]:
            raise ValueError(f"normalisers that are not supported: {unknown}")
        self._nfc, self._lower = "NFC" in kinds, "Lowercase" in kinds
        splits = [p["pattern"]["Regex"] for p in self._all(spec["pre_tokenizer"]) if p["type"] == "Split"]
        if len(splits) != 1:
            raise ValueError("the file must cut texts by one pattern")
        self._pieces = regex.compile(splits[0]).findall
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self._special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._marks = special
        self._merges = PairMerges(spec["model"]["merges"], spec["model"].get("end_of_word_suffix") or "")
        self._chunk: dict[str, int] = {}
        self._piece: dict[str, int] = {}

    @staticmethod
    def _all(part: dict | None) -> list[dict]:
        if not part:
            return []
        return part.get("normalizers") or part.get("pretokenizers") or [part]

    def _kinds(self, part):
        return [p["type"] for p in self._all(part)]

    def _count_chunk(self, chunk: str) -> int:
        """White space ends pieces and is dropped, so a text is counted by what lies between."""
        shown = unicodedata.normalize("NFC", chunk) if self._nfc and not chunk.isascii() else chunk
        if self._lower:
            shown = "".join(c.lower() for c in shown) if not shown.isascii() else shown.lower()
        total, known = 0, self._piece
        for piece in self._pieces(shown):
            if (count := known.get(piece)) is None:
                count = self._merges.count(piece)
                if len(piece) < 64:
                    if len(known) >= _MEMORY:
                        known.clear()
                    known[piece] = count
            total += count
        if len(chunk) < 64:
            if len(self._chunk) >= _MEMORY:
                self._chunk.clear()
            self._chunk[chunk] = total
        return total

    def count(self, text: str) -> int:
        if self._special and any(mark in text for mark in self._marks):
            return len(self._special.findall(text)) + sum(map(self._count_plain, self._special.split(text)))
        return self._count_plain(text)

    def _count_plain(self, text: str) -> int:
        known, slow, total = self._chunk.get, self._count_chunk, 0
        for chunk in chunks(text):
            count = known(chunk)
            total += slow(chunk) if count is None else count
        return total


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The counter of a file, kept for the life of a Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; a null text is empty and has no tokens."""

    def counted(batches):
        count = counter(tokenizer).count
        for batch in steps(batches):
            texts = column(batch, "text").to_pylist()
            sizes = [len(text.encode("utf-8", "surrogatepass")) if text else 0 for text in texts]
            tokens = [count(text) if text else 0 for text in texts]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(counted, "id long, n_bytes long, n_tokens long, over_limit boolean")
