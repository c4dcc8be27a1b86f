"""Quality of documents by a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: the damped, normalised counts of its words in hashed places, and
buckets of statistics about its structure and size. The machine adds to a linear score all pairwise
products of features, weighted by the inner products of their low-rank factors. The pairs are never
formed: half of (square of sums minus sum of squares), per factor, takes linear time.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import column, steps, stored, texts_of

_BUCKETS = 12
#: Byte classes that are counted.
_SPACES, _UPPER, _DIGITS, _MARKS, _CALLS, _STOPS = (
    list(members) for members in (b" \t\n\r", range(65, 91), range(48, 58), b"#$%&*|<>{}[]=~^_\\", b"!?", b".,;:")
)


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure and metadata between 0 and 1; an empty text gives zeros."""
    n, w = len(text), len(words)
    if not n:
        return [0.0] * 12
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    found = np.bincount(raw, minlength=256)
    lines = text.split("\n")
    often = [c for c in counts.values() if c > 1]
    return [
        min(1.0, np.log2(n + 1) / 20),
        min(1.0, w / (n / 4)),
        min(1.0, (n - found[_SPACES].sum()) / max(w, 1) / 16),
        found[_UPPER].sum() / len(raw),
        min(1.0, 4 * found[_DIGITS].sum() / len(raw)),
        min(1.0, 4 * found[_MARKS].sum() / len(raw)),
        min(1.0, 4 * found[_CALLS].sum() / len(raw)),
        min(1.0, 4 * found[_STOPS].sum() / len(raw)),
        len(counts) / max(w, 1),
        sum(often) / max(w, 1),
        max(often, default=1) / max(w, 1),
        len(set(lines)) / len(lines),
    ]


def features(text: str, places: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a text's vector; hashed words have unit length together."""
    words = text.split()
    counts = Counter(words)
    spread = np.zeros(places)
    if counts:
        at = np.fromiter((xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) for word in counts), np.int64, len(counts)) % places
        np.add.at(spread, at, np.fromiter(counts.values(), np.float64, len(counts)))
    index = np.flatnonzero(spread)
    value = np.log1p(spread[index])
    value /= max(1e-9, float(np.sqrt(value @ value)))
    stats = np.array(statistics(text, words, counts))
    bucket = np.minimum((stats * _BUCKETS).astype(np.int64), _BUCKETS - 1)
    base = places + np.arange(len(stats)) * (_BUCKETS + 1)
    index = np.concatenate([index, base + bucket, base + _BUCKETS])
    return index, np.concatenate([value, np.full(len(stats), 0.5), stats])


def n_features(places: int) -> int:
    return places + 12 * (_BUCKETS + 1)


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray  # (features, rank)
    places: int

    @classmethod
    def start(cls, places: int, rank: int, seed: int = 5):
        size = n_features(places)
        return cls(0.0, np.zeros(size), np.random.default_rng(seed).normal(0, 0.05, (size, rank)), places)

    def logits(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        index, value, start = _flat(rows)
        return self._forward(index, value, start)[0]

    def _forward(self, index, value, start):
        weighed = self.factors[index] * value[:, None]
        sums = np.add.reduceat(weighed, start, axis=0)
        pairs = 0.5 * (sums**2 - np.add.reduceat(weighed**2, start, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.linear[index] * value, start) + pairs, sums

    def score(self, texts: list[str]) -> np.ndarray:
        out = [
            self.logits([features(text, self.places) for text in texts[at : at + 64]]) for at in range(0, len(texts), 64)
        ]
        logit = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def fit(self, rows, label, epochs: int = 6, rate: float = 0.05, decay: float = 1e-4, seed: int = 5) -> None:
        """AdaGrad on the logistic loss over mini-batches."""
        draw = np.random.default_rng(seed)
        squares = [np.full_like(self.linear, 1e-6), np.full_like(self.factors, 1e-6), 1e-6]
        for _ in range(epochs):
            order = draw.permutation(len(rows))
            for at in range(0, len(order), 32):
                some = order[at : at + 32]
                index, value, start = _flat([rows[i] for i in some])
                logit, sums = self._forward(index, value, start)
                error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[some]
                owner = np.repeat(np.arange(len(some)), np.diff(np.append(start, len(index))))
                used, place = np.unique(index, return_inverse=True)
                linear = np.bincount(place, error[owner] * value) / len(some) + decay * self.linear[used]
                each = (error[owner] * value)[:, None] * (sums[owner] - self.factors[index] * value[:, None])
                turn = np.argsort(place, kind="stable")
                first = np.searchsorted(place[turn], np.arange(len(used)))
                factors = np.add.reduceat(each[turn], first, axis=0) / len(some) + decay * self.factors[used]
                squares[0][used] += linear**2
                squares[1][used] += factors**2
                squares[2] += error.mean() ** 2
                self.linear[used] -= rate * linear / np.sqrt(squares[0][used])
                self.factors[used] -= 0.4 * rate * factors / np.sqrt(squares[1][used])
                self.bias -= rate * error.mean() / np.sqrt(squares[2])


def _flat(rows):
    start = np.cumsum([0, *(len(index) for index, _ in rows[:-1])])
    return np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), start


def train(
    labelled: DataFrame, sample: int = 8000, places: int = 4096, rank: int = 8, text_col: str = "text",
    label_col: str = "label", id_col: str = "doc_id",
) -> FactorisationMachine:
    """Fit on at most ``sample`` rows with text and a label of 0 or 1: those with the smallest id hashes.

    Features are made by Spark; a row brings at most ``places`` word places to the driver. Without
    any row every score is 0.5.
    """
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(
        F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.xxhash64(F.col(id_col)).alias("draw")
    )
    n = rows.count()
    # A generous bound first, so that only about the sample's texts are turned into features.
    if n > 2 * sample:
        rows = rows.where(F.shiftrightunsigned("draw", 32) < int(1.2 * sample / n * 2**32))

    def turned(batches):
        for batch in steps(batches):
            found = [features(text, places) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "draw"), column(batch, "label"),
                 pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())],
                ["draw", "label", "index", "value"],
            )

    made = stored(rows.mapInArrow(turned, "draw long, label int, index binary, value binary"), "quality-features")
    machine = FactorisationMachine.start(places, rank)
    vectors, labels = [], []
    for row in made.orderBy("draw", "label", "index").limit(sample).toLocalIterator():
        vectors.append((np.frombuffer(row["index"], np.int32).astype(np.int64), np.frombuffer(row["value"], np.float32).astype(np.float64)))
        labels.append(row["label"])
    if vectors:
        machine.fit(vectors, np.array(labels, float))
    return machine


def score(docs: DataFrame, machine: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, 0 to 1; a null text is scored as the empty text."""

    def scored(batches):
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), pa.array(machine.score(texts_of(batch)))], ["id", "score"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scored, "id long, score double")
