"""Secrets in texts: three fixed patterns, and a character network over every other candidate.

The patterns give spans that always stay. Further candidates are long runs of code-like characters
with a digit; a small convolutional network sees each with its surroundings. It is trained in numpy
on the findings of the patterns (candidates inside a pattern's span against those outside), with
the surroundings swapped in half of the examples, so that it also has to know a secret by itself.
Its scores are calibrated on all windows it has not been fitted on, and the threshold is the highest
one that still finds the asked share of them.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import column, steps, stored, texts_of

#: Kinds in the order that breaks ties of a common start.
KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a whole run, so short runs need not be matched and dropped
_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"[A-Za-z0-9+/_-]{12,}")

LEFT, HEAD, TAIL, RIGHT = 32, 32, 16, 16
WIDTH = LEFT + HEAD + TAIL + RIGHT
#: Steps of the score histogram in one unit of the network's output; outputs beyond 30 count as 30.
SCORE_STEPS = 256
_PARTS = ((0, LEFT), (LEFT - 2, LEFT + HEAD + TAIL), (LEFT + HEAD + TAIL - 2, WIDTH))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns, by start and then kind; code points, end exclusive."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(start, KINDS[kind], end) for start, kind, end in sorted(found)]


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of 12 or more code-like characters with at least one digit."""
    if not _DIGIT.search(text):
        return []
    return [m.span() for m in _RUN.finditer(text) if _DIGIT.search(m[0])]


def window(text: str, start: int, end: int) -> bytes:
    """A candidate with its surroundings in WIDTH codes: ASCII, 127 for other letters, 0 for nothing.

    Of a candidate that is longer than its field the head and the tail are shown.
    """
    inside = text[start:end] if end - start <= HEAD + TAIL else text[start : start + HEAD] + text[end - TAIL : end]
    shown = text[max(0, start - LEFT) : start].rjust(LEFT, "\0") + inside.ljust(HEAD + TAIL, "\0")
    shown += text[end : end + RIGHT].ljust(RIGHT, "\0")
    return bytes(min(ord(c), 127) for c in shown)


def _inside(runs: list[tuple[int, int]], spans: list[tuple[int, str, int]]) -> list[bool]:
    """Whether each run overlaps a span; both are sorted by start, and runs do not overlap each other."""
    out, at, reach = [], 0, 0
    for start, end in runs:
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][2])
            at += 1
        out.append(reach > start)
    return out


class CharacterNetwork:
    """Embedding, one convolution, the maximum of each filter per part, and a logistic output."""

    width, size, filters = 5, 8, 24

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        n = self.filters * len(_PARTS)
        self.p = {
            "emb": draw.normal(0, 0.5, (128, self.size)),
            "conv": draw.normal(0, (2 / (self.width * self.size)) ** 0.5, (self.width * self.size, self.filters)),
            "bias": np.zeros(self.filters),
            "out": draw.normal(0, n**-0.5, n),
            "off": np.zeros(1),
        }

    def _forward(self, codes: np.ndarray):
        emb = self.p["emb"][codes]
        columns = np.lib.stride_tricks.sliding_window_view(emb, self.width, axis=1)  # n, positions, size, width
        columns = columns.transpose(0, 1, 3, 2).reshape(len(codes), -1, self.width * self.size)
        maps = np.maximum(columns @ self.p["conv"] + self.p["bias"], 0)
        best = [maps[:, a : b - self.width + 1].argmax(axis=1) + a for a, b in _PARTS]
        top = np.concatenate([np.take_along_axis(maps, i[:, None, :], 1)[:, 0] for i in best], axis=1)
        return columns, best, top, top @ self.p["out"] + self.p["off"]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[at : at + 256])[3] for at in range(0, len(codes), 256)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _gradient(self, codes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        columns, best, top, logit = self._forward(codes)
        error = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) / len(label)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["out"], grad["off"] = top.T @ error, np.array([error.sum()])
        back = (error[:, None] * self.p["out"]) * (top > 0)
        row = np.arange(len(codes))[:, None]
        for k, place in enumerate(best):
            part = back[:, k * self.filters : (k + 1) * self.filters]
            seen = columns[row, place]  # n, filters, width * size
            grad["bias"] += part.sum(axis=0)
            grad["conv"] += np.einsum("nf,nfc->cf", part, seen)
            emb = (part[:, :, None] * self.p["conv"].T[None]).reshape(-1, self.width, self.size)
            for j in range(self.width):
                np.add.at(grad["emb"], codes[row, place + j].ravel(), emb[:, j])
        return grad

    def fit(self, codes: np.ndarray, label: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 7) -> None:
        """Adam over mini-batches; both labels weigh the same."""
        draw = np.random.default_rng(seed)
        share = label.mean()
        weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(codes))
            for at in range(0, len(order), 64):
                some = order[at : at + 64]
                step += 1
                for k, g in self._gradient(codes[some], label[some], weight[some]).items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    self.p[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)


@dataclass
class SecretModel:
    network: CharacterNetwork
    scale: float
    shift: float
    threshold: float

    def probability(self, windows: list[bytes]) -> np.ndarray:
        codes = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH)
        return 1 / (1 + np.exp(-np.clip(self.scale * self.network.logits(codes) + self.shift, -30, 30)))


def _calibrate(logit: np.ndarray, hit: np.ndarray, miss: np.ndarray) -> tuple[float, float]:
    """Platt scaling by Newton steps of scores with counts of both labels, with targets drawn in a little."""
    high, low = (hit.sum() + 1) / (hit.sum() + 2), 1 / (miss.sum() + 2)
    x, w = np.stack([logit, np.ones_like(logit)], 1), np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * ((hit + miss) * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(hessian, x.T @ ((hit + miss) * p - hit * high - miss * low))
    return float(max(w[0], 1e-3)), float(w[1])


def train(
    docs: DataFrame, recall: float = 0.98, sample: int = 3000, id_col: str = "doc_id", text_col: str = "text"
) -> SecretModel | None:
    """Fit on at most ``sample`` candidates inside and as many outside the patterns' spans.

    The sample is the smallest hashes of the distinct windows, so it does not depend on partitioning.
    Calibration and threshold come from all distinct windows the network was not fitted on, scored
    in the tasks and counted in a histogram of SCORE_STEPS steps a unit.
    None is returned if one kind has no example at all: then only the patterns find secrets.
    """

    def labelled(batches):
        for batch in steps(batches):
            shown, inside = [], []
            for text in texts_of(batch):
                if runs := candidates(text):
                    spans = base_spans(text)
                    shown += [window(text, a, b) for a, b in runs]
                    inside += _inside(runs, spans)
            yield pa.RecordBatch.from_arrays([pa.array(shown, pa.binary()), pa.array(inside, pa.bool_())], ["shown", "inside"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(labelled, "shown binary, inside boolean")
    rows = stored(rows.groupBy("shown").agg(F.max("inside").alias("inside")), "secret-candidates")
    hit, miss = (
        [bytes(r.shown) for r in rows.where(rows.inside == kind).orderBy(F.xxhash64("shown"), "shown").limit(sample).collect()]
        for kind in (True, False)
    )
    if not hit or not miss:
        return None
    codes = np.frombuffer(b"".join(hit + miss), np.uint8).reshape(-1, WIDTH)
    label = np.repeat([1.0, 0.0], [len(hit), len(miss)])
    draw = np.random.default_rng(11)
    held = draw.random(len(label)) < 0.3
    held[[0, len(hit)]] = False  # both kinds are there to be learned
    fit_codes, fit_label = codes[~held], label[~held]
    swapped = fit_codes.copy()
    swapped[:, :LEFT] = fit_codes[draw.permutation(len(fit_codes)), :LEFT]
    swapped[:, -RIGHT:] = fit_codes[draw.permutation(len(fit_codes)), -RIGHT:]
    network = CharacterNetwork()
    network.fit(np.concatenate([fit_codes, swapped]), np.tile(fit_label, 2))
    fitted = {shown for shown, out in zip(hit + miss, held) if not out}
    scores = _held_scores(rows, network, fitted)
    logit = (scores[:, 0] + 0.5) / SCORE_STEPS
    scale, shift = _calibrate(logit, scores[:, 1], scores[:, 2])
    model = SecretModel(network, scale, shift, 0.5)
    # The highest lower edge of a score step above which the asked share of all findings lies.
    found = np.cumsum(scores[::-1, 1])[::-1]
    if found.size and found[0]:
        lowest = scores[np.flatnonzero(found >= recall * found[0])[-1], 0] / SCORE_STEPS
        model.threshold = float(1 / (1 + np.exp(-np.clip(scale * lowest + shift, -30, 30))))
    return model


def _held_scores(rows: DataFrame, network: CharacterNetwork, fitted: set[bytes]) -> np.ndarray:
    """(score step, findings, others) by step, of all distinct windows but those the network was fitted on."""

    def scored(batches):
        for batch in batches:
            keep = [(s, i) for s, i in zip(column(batch, "shown").to_pylist(), column(batch, "inside").to_pylist()) if s not in fitted]
            codes = np.frombuffer(b"".join(s for s, _ in keep), np.uint8).reshape(-1, WIDTH)
            step = np.floor(np.clip(network.logits(codes), -30, 30) * SCORE_STEPS).astype(np.int64)
            inside = np.array([i for _, i in keep], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(step), pa.array(inside.astype(np.int64)), pa.array((~inside).astype(np.int64))], ["step", "hit", "miss"]
            )

    steps_of = rows.mapInArrow(scored, "step long, hit long, miss long").groupBy("step").agg(F.sum("hit"), F.sum("miss"))
    return np.array(sorted(map(tuple, steps_of.collect())), np.int64).reshape(-1, 3)


def spans_of(texts: list[str], model: SecretModel | None) -> list[list[tuple[int, str, int]]]:
    """All spans of each text by start, then kind: the patterns', and candidates the model accepts."""
    found = [base_spans(text) for text in texts]
    if model is None:
        return found
    extra = []
    for i, text in enumerate(texts):
        runs = candidates(text)
        extra += [(i, a, b) for (a, b), known in zip(runs, _inside(runs, found[i])) if not known]
    for at in range(0, len(extra), 4096):
        some = extra[at : at + 4096]
        for (i, a, b), p in zip(some, model.probability([window(texts[i], a, b) for i, a, b in some])):
            if p >= model.threshold:
                found[i].append((a, "model", b))
    return [sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]))) for spans in found]


def _written(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, model: SecretModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_model, base_sha256, spans) for every row; a null text is empty."""

    def scanned(batches):
        for batch in steps(batches):
            rows = []
            for spans in spans_of(texts_of(batch), model):
                kinds = [kind for _, kind, _ in spans]
                base = _written(s for s in spans if s[1] != "model")
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(base.encode()).hexdigest(), _written(spans)))
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()] * 2)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "id"), *columns],
                    ["id", "n_assign", "n_access", "n_hex", "n_model", "base_sha256", "spans"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        scanned, "id long, n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string"
    )


def redact(docs: DataFrame, model: SecretModel | None, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret, overlapping spans as one, replaced by ``mark``; null texts stay null."""

    @F.pandas_udf("string")
    def cleaned(texts):
        whole = [text or "" for text in texts]
        out = []
        for text, given, spans in zip(whole, texts, spans_of(whole, model)):
            pieces, at = [], 0
            for start, _, end in spans:
                if start >= at:
                    pieces += [text[at:start], mark]
                at = max(at, end)
            out.append("".join([*pieces, text[at:]]) if given is not None else None)
        return texts.__class__(out, dtype=object)

    return docs.withColumn(text_col, cleaned(F.col(text_col)))
