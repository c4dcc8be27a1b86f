"""Language identification by n-gram filters that answer with a bitmask of languages.

Each language keeps the character n-grams that are typical of it in a Bloom filter. The filters of
all languages are bit-sliced: a slot is one machine word (several beyond 64 languages) with a bit
per language, so one look-up per hash function returns, by AND, all languages that contain an
n-gram. The hits of a language over the n-grams of a text are corrected for its filter's share of
false positives, which its fill gives; the highest share decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.work import column, steps, stored, texts_of

NO_LANGUAGE = "und"
_SIZES = (2, 3, 4)
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _letter_table() -> np.ndarray:
    """The lower-case form of every letter, zero for all other code points."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (letter := chr(code)).isalpha():
            table[code] = ord(letter.lower()[0])
    return table


_LETTERS: list[np.ndarray] = []


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, with zeros for what stands between them, and their text numbers."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    sizes = np.array([len(text) + 2 for text in texts])
    joined = "".join(f" {text} " for text in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _LETTERS[0][codes]
    owner = np.repeat(np.arange(len(texts)), sizes)
    # Runs of other characters become a single gap.
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] > 0) | (letters[:-1] > 0) | (owner[1:] != owner[:-1])
    return letters[keep].astype(np.uint64), owner[keep]


def ngrams(letters: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of 2 to 4 characters with at most one gap at either end, and their texts."""
    grams, owners = [], []
    gap = letters == 0
    for size in _SIZES:
        n = len(letters) - size + 1
        if n <= 0:
            continue
        value = np.full(n, size, np.uint64)
        good = owner[:n] == owner[size - 1 :]
        for i in range(size):
            value = value * _MULTIPLIERS[0] + letters[i : i + n]
            if 0 < i < size - 1:
                good &= ~gap[i : i + n]
        if size == 2:
            good &= ~(gap[:n] & gap[1:])
        value ^= value >> np.uint64(29)
        grams.append(value[good])
        owners.append(owner[:n][good])
    if not grams:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(grams), np.concatenate(owners)


def _pieces(texts: list[str | None], most: int = 1 << 19):
    """Texts, cut where one is longer than ``most`` characters, in groups of about that length with their numbers."""
    some, numbers, size = [], [], 0
    for number, text in enumerate(texts):
        for start in range(0, len(text or ""), most):
            some.append(text[start : start + most])
            numbers.append(number)
            size += len(some[-1])
            if size >= most:
                yield some, np.array(numbers)
                some, numbers, size = [], [], 0
    if some:
        yield some, np.array(numbers)


@dataclass
class LanguageFilters:
    """Bit-sliced Bloom filters: ``slots`` is (size, words) of language bits."""

    languages: list[str]
    slots: np.ndarray
    hashes: int
    false: np.ndarray  # share of unknown n-grams that each language's filter takes for its own

    @classmethod
    def build(cls, languages: list[str], grams: list[np.ndarray], bits_per_gram: int = 12, hashes: int = 4):
        """The size fits the largest language, so smaller ones have fewer false positives."""
        most = max((len(g) for g in grams), default=1)
        size = 1 << max(10, int(np.ceil(np.log2(max(1, most) * bits_per_gram))))
        slots = np.zeros((size, (len(languages) + 63) // 64), np.uint64)
        for i, gram in enumerate(grams):
            for k in range(hashes):
                slots[cls._place(gram, k, size), i // 64] |= np.uint64(1) << np.uint64(i % 64)
        fill = np.array([
            np.count_nonzero(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / size for i in range(len(languages))
        ])
        return cls(languages, slots, hashes, fill**hashes)

    @staticmethod
    def _place(grams: np.ndarray, k: int, size: int) -> np.ndarray:
        mixed = (grams ^ (grams >> np.uint64(31))) * _MULTIPLIERS[k]
        return (mixed >> np.uint64(64 - int(size).bit_length() + 1)).astype(np.int64)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """(n-gram, word) bitmasks of the languages whose filters hold each n-gram."""
        found = self.slots[self._place(grams, 0, len(self.slots))]
        for k in range(1, self.hashes):
            found = found & self.slots[self._place(grams, k, len(self.slots))]
        return found

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score from 0 to 1 for each text.

        The score is the corrected share of n-grams that the language knows. Ties go to the language
        that comes first in ``languages``; a null text or one without a letter is ``und``, score 0.
        """
        hits = np.zeros((len(self.languages), len(texts)))
        total, letter_count = np.zeros(len(texts)), np.zeros(len(texts))
        for some, numbers in _pieces(texts):
            letters, owner = letters_of(some)
            letter_count += np.bincount(numbers[owner[letters > 0]], minlength=len(texts))
            grams, owner = ngrams(letters, owner)
            owner = numbers[owner]
            total += np.bincount(owner, minlength=len(texts))
            masks = self.masks(grams)
            for i in range(len(self.languages)):
                bit = masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)
                hits[i] += np.bincount(owner[bit == 1], minlength=len(texts))
        has_letter = letter_count > 0
        false = self.false[:, None]
        share = (hits / np.maximum(total, 1) - false) / np.maximum(1e-9, 1 - false)
        share = np.clip(share, 0, 1)
        if not self.languages:
            return [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
        best = share.argmax(axis=0)
        names = [self.languages[b] if ok else NO_LANGUAGE for b, ok in zip(best, has_letter)]
        return names, np.where(has_letter, share[best, np.arange(len(texts))], 0.0)


def learn(
    docs: DataFrame, documents: int = 3000, grams: int = 20_000, dominance: float = 0.3, few: int = 2000,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> LanguageFilters:
    """Filters from the rows of ``docs`` with a language and a text.

    About ``documents`` rows of each language are learned from: those whose id has a hash below a
    bound that follows from the language's number of rows. An n-gram belongs to a language if its
    share among the language's n-grams is at least ``dominance`` times its highest share in any
    language; the ``grams`` most frequent of each language are kept. Those that occur once count
    only in a language with less than ``few`` others, so that no language is lost.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 32).alias("draw"),
    )
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageFilters.build([], [])
    bound = F.lit(0).cast("long")
    for lang, n in sizes.items():
        bound = F.when(F.col("lang") == lang, F.lit(int(min(1.0, documents / n) * 2**32))).otherwise(bound)
    sample = rows.where(F.col("draw") < bound)

    def counted(batches):
        counts: dict[str, dict[int, int]] = {}
        for batch in steps(batches):
            langs, texts = np.array(column(batch, "lang").to_pylist(), object), texts_of(batch)
            for lang in set(langs):
                own = counts.setdefault(lang, {})
                for some, _ in _pieces([t for t, ln in zip(texts, langs) if ln == lang]):
                    found, n = np.unique(ngrams(*letters_of(some))[0], return_counts=True)
                    for gram, many in zip(found.tolist(), n.tolist()):
                        own[gram] = own.get(gram, 0) + many
            if sum(map(len, counts.values())) > 200_000:
                yield from _count_rows(counts)
                counts = {}
        yield from _count_rows(counts)

    table = (
        sample.select("lang", "text").mapInArrow(counted, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    table = stored(table, "ngrams")
    repeated = {r["lang"]: r["n"] for r in table.groupBy("lang").agg(F.count_if(F.col("n") > 1).alias("n")).collect()}
    small = [lang for lang, n in repeated.items() if n < few]
    table = table.where((F.col("n") > 1) | F.col("lang").isin(small))
    total = {r["lang"]: r["n"] for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    weight = F.lit(0.0)
    for lang, n in total.items():
        weight = F.when(F.col("lang") == lang, F.col("n") / F.lit(float(n))).otherwise(weight)
    shared = table.withColumn("share", weight)
    highest = shared.groupBy("gram").agg(F.max("share").alias("highest"))
    own = shared.join(highest, "gram").where(F.col("share") >= dominance * F.col("highest"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    own = own.withColumn("place", F.row_number().over(first)).where(F.col("place") <= grams).select("lang", "gram")
    found: dict[str, list[int]] = {}
    for row in own.toLocalIterator():
        found.setdefault(row["lang"], []).append(row["gram"])
    # A language whose texts have no n-gram, or only ones that others own, has an empty filter.
    languages = sorted(sizes, key=lambda lang: (-sizes[lang], lang))
    found = {lang: found.get(lang, []) for lang in languages}
    return LanguageFilters.build(languages, [np.array(found[lang], np.int64).view(np.uint64) for lang in languages])


def _count_rows(counts):
    for lang, own in counts.items():
        if own:
            grams = np.fromiter(own.keys(), np.uint64, len(own)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own)), pa.array(grams), pa.array(list(own.values()), pa.int64())],
                ["lang", "gram", "n"],
            )


def identify(docs: DataFrame, filters: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row; ``und`` and 0 for a null text or one without letters."""

    def decided(batches):
        for batch in steps(batches):
            langs, score = filters.decide(column(batch, "text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), pa.array(langs, pa.string()), pa.array(score)], ["id", "lang_pred", "score"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(decided, "id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, filters: LanguageFilters, score: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs`` whose language is known with at least ``score``."""

    @F.pandas_udf("double")
    def known(texts):
        langs, found = filters.decide([text for text in texts])
        return texts.__class__(np.where(np.array(langs, object) == NO_LANGUAGE, -1.0, found))

    return docs.where(known(F.col(text_col)) >= score)
