"""Quality: attention-based multiple-instance learning over the passages of a document, fitted in numpy.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is encoded as a vector: shares of kinds of
characters, word shapes, repetition inside the passage and of what the document said before, and a random projection of
its hashed words. A dense layer makes ``h`` of it, and gated attention weighs the passages of a document
by ``softmax(w . (tanh(V h) * sigmoid(U h)))``; the weighted sum of the ``h`` gives the score. Only documents
are labelled: which passages matter is learned.

Training takes at most ``PER_CLASS`` labelled rows of each class, as a whole. Scoring is a map over the documents.

Defined cases: a null text, or one without words, is one passage of zeros. Without labelled rows of both classes every score
is the share of class 1 among them (1 without any). Repeated labels count once, contradicting ones both. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.labelled import id_remainder, labelled_texts
from martlet.llm.text import FOLDED, mix, prepare, shingle_hashes, slices, span_hashes, tidied, word_spans

PER_CLASS = 2000
PASSAGE_WORDS, PROJECTED, HIDDEN, ATTENTION = 64, 16, 16, 8
CUT = 0.3
EPOCHS, BATCH, RATE, DECAY = 60, 64, 0.01, 1e-3

_KIND = np.full(256, 7, np.uint8)
for _at, _bytes in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".,;:!?", b" \t\n\r\x0b\x0c"]):
    _KIND[list(_bytes)] = _at
_KIND[128:] = 6
_KINDS = 8
_PROJECTION = np.random.RandomState(5).normal(0, 1, (1 << 12, PROJECTED)).astype(np.float32)


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row for each passage of each text, and the n + 1 passage offsets of the texts."""
    starts, ends, bounds = word_spans(data, offsets)
    counts = np.diff(bounds)
    per_text = np.maximum(1, -(-counts // PASSAGE_WORDS))
    out_bounds = np.concatenate([[0], np.cumsum(per_text)])
    rows = np.zeros((out_bounds[-1], _KINDS + 8 + PROJECTED), np.float32)
    if not len(starts):
        return rows, out_bounds
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(starts)) - bounds[text]
    passage = out_bounds[text] + place // PASSAGE_WORDS
    filled = np.unique(passage)
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    words = np.diff(np.append(first, len(starts))).astype(np.float32)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float32), first, axis=0) / (words if values.ndim == 1 else words[:, None])

    size = (ends - starts).astype(np.float32)
    kinds, total = _KIND[data], np.zeros(len(data) + 1, np.int32)
    inside = np.minimum(np.append(starts[first][1:], offsets[-1]), offsets[1:][text[first]])
    span = np.maximum(1, inside - starts[first])
    for kind in range(_KINDS):
        np.cumsum(kinds == kind, out=total[1:])
        rows[filled, kind] = (total[inside] - total[starts[first]]) / span
    np.cumsum(kinds == 3, out=total[1:])
    symbolic = total[ends] - total[starts]
    hashes = span_hashes(data, starts, ends, FOLDED)
    own = mix(hashes ^ mix(passage.astype(np.uint64)))
    fresh_word = np.zeros(len(own), bool)
    fresh_word[np.unique(own, return_index=True)[1]] = True
    shingles, at = shingle_hashes(hashes, bounds, 3)
    shingle_text = np.repeat(np.arange(len(counts)), np.diff(at))
    seen = np.ones(len(shingles), bool)
    seen[np.unique(mix(shingles ^ mix(shingle_text.astype(np.uint64))), return_index=True)[1]] = False
    repeated = np.zeros(len(starts), bool)
    repeated[bounds[shingle_text] + np.arange(len(shingles)) - at[shingle_text]] = seen
    base = _KINDS
    for k, values in enumerate(
        [np.minimum(size, 40) / 10, size > 20, ~fresh_word, repeated, kinds[starts] == 1, symbolic > 0, kinds[ends - 1] == 4]
    ):
        rows[filled, base + k] = mean(values)
    rows[filled, base + 7] = np.log1p(words) / 5
    vectors = _PROJECTION[hashes >> np.uint64(52)]
    rows[filled, base + 8 :] = np.add.reduceat(vectors, first, axis=0) / np.sqrt(words)[:, None]
    return rows, out_bounds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class QualityModel:
    center: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]  # dense W, b; attention V, U, w; output c, c0
    constant: float | None = None

    def forward(self, rows: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w, b, v, u, a, c, c0 = self.weights
        x = np.clip((rows - self.center) / self.scale, -8, 8)
        h = np.tanh(x @ w + b)
        content, gate = np.tanh(h @ v), _sigmoid(h @ u)
        raw = (content * gate) @ a
        counts = np.diff(bounds)
        raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, bounds[:-1]), counts))
        weight = raw / np.repeat(np.add.reduceat(raw, bounds[:-1]), counts)
        bag = np.add.reduceat(weight[:, None] * h, bounds[:-1], axis=0)
        return {"x": x, "h": h, "content": content, "gate": gate, "weight": weight, "bag": bag, "score": _sigmoid(bag @ c + c0[0])}

    def gradients(self, rows: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        w, b, v, u, a, c, c0 = self.weights
        at, counts = self.forward(rows, bounds), np.diff(bounds)
        miss = (at["score"] - y) / len(y)
        bag_down = np.repeat(miss[:, None] * c, counts, axis=0)
        weight_down = (bag_down * at["h"]).sum(axis=1)
        shared = np.repeat(np.add.reduceat(weight_down * at["weight"], bounds[:-1]), counts)
        raw_down = at["weight"] * (weight_down - shared)
        gated = raw_down[:, None] * a
        content_down = gated * at["gate"] * (1 - at["content"] ** 2)
        gate_down = gated * at["content"] * at["gate"] * (1 - at["gate"])
        h_down = bag_down * at["weight"][:, None] + content_down @ v.T + gate_down @ u.T
        dense = h_down * (1 - at["h"] ** 2)
        return [
            at["x"].T @ dense, dense.sum(axis=0), at["h"].T @ content_down, at["h"].T @ gate_down,
            (at["content"] * at["gate"]).T @ raw_down, at["bag"].T @ miss, miss.sum(keepdims=True),
        ]

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = [np.zeros(0)]
        for _, _, data, offsets in slices(texts):
            if self.constant is not None:
                found.append(np.full(len(offsets) - 1, self.constant))
            else:
                found.append(self.forward(*passages(data, offsets))["score"])
        return np.concatenate(found)


def train(texts: pa.Array, classes: list[int], seed: int = 9) -> QualityModel:
    y, random = np.array(classes, float), np.random.RandomState(seed)
    none = np.zeros(1)
    if not 0 < y.sum() < len(y):
        return QualityModel(none, none, [], constant=float(y.mean()) if len(y) else 1.0)
    bags = []
    for _, _, data, offsets in slices(texts):
        rows, bounds = passages(data, offsets)
        bags += [rows[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    whole = np.concatenate(bags).astype(float)
    shapes = [(whole.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, ATTENTION), (HIDDEN, ATTENTION), (ATTENTION,), (HIDDEN,), (1,)]
    weights = [random.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or s[0] > 1 else np.zeros(s) for s in shapes]
    model = QualityModel(whole.mean(axis=0), whole.std(axis=0) + 1e-3, weights)
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = random.permutation(len(y))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            bounds = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
            step += 1
            rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for w, g, m, s in zip(weights, model.gradients(np.concatenate([bags[i] for i in chosen]), bounds, y[chosen]), first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= rate * (m / (np.sqrt(s) + 1e-8) + DECAY * w)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from a score of ``CUT``) of every row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    training: Column = id_remainder("id", 5) != 0
    texts, classes, _ = labelled_texts(rows, labels, "quality", training, PER_CLASS)
    model = train(texts, classes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= CUT).astype(np.int32))],
                schema.names,
            )

    rows = rows.withColumn("held_out", F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False)))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return rows.select("doc_id", "held_out", "text").mapInArrow(tidied(score), schema)
