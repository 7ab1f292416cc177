"""Toxicity: a convolutional text classifier over hashed word embeddings, fitted in numpy.

A word is a run of letters and digits. Its embedding is the sum of a row for its hash and a row for the hash of its
first bytes. Filters of several widths run over the words, each filter's largest value in the text is kept, and a
linear layer makes one logit of them. All weights start at random and are trained by Adam; a pooled value passes its
gradient to the one window it came from. Words that next to no training text has are zero, so that they are no evidence.

Thresholds are calibrated by language on labelled texts that training has not seen: the language is the one whose
common words are most frequent in the text (no column tells it), and the logit is shifted so that the calibrated
threshold of its language meets the score ``CUT``.

Training takes at most ``PER_CLASS`` labelled rows of each class. Scoring is a map over the documents.

Defined cases: null or empty texts are scored as a text of no words, of no language. Without labelled rows of both
classes every score is 0. Repeated labels count once, contradicting ones both. Columns other than id and text are
passed through or ignored by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.labelled import id_remainder, labelled_texts
from martlet.llm.text import FOLDED, by_position, mix, prepare, slices, span_hashes, tidied, word_spans

#: Bound on labelled rows of each class that a model is fitted on.
PER_CLASS = 4000
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 16, (1, 2, 3), 12
PREFIX_BYTES = 5
CLEAN_DEVIATIONS = 1.5
CUT = 0.7
EPOCHS, LEAST_STEPS, BATCH, RATE = 4, 150, 32, 0.005
#: Deviation of the random weights, and training texts below which a row starts from zero.
SCALE, LEAST_TEXTS = 0.05, 2

#: Common words by which a text's language is told.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on are as with they be at this have from".split(),
    "fr": "le la les de des et un une que qui dans pour par sur au est ne pas plus ce".split(),
    "de": "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "es": "el la los las de que y en un una por con para del se no su al lo como".split(),
}
LANGUAGES = (*COMMON_WORDS, "")

_SEPARATOR = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def _hash_of(words: list[str]) -> np.ndarray:
    raw = "".join(words).encode()
    ends = np.cumsum([len(w.encode()) for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    return span_hashes(np.frombuffer(raw, np.uint8), starts, ends, FOLDED)


_COMMON = [np.sort(_hash_of(words)) for words in COMMON_WORDS.values()]


@dataclass
class Encoded:
    """Texts as rows of the embedding table: two rows for each word, ``gap`` empty words after each text."""

    word: np.ndarray
    prefix: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    language: np.ndarray

    gap = max(WIDTHS)


def encode(data: np.ndarray, offsets: np.ndarray) -> Encoded:
    starts, ends, bounds = word_spans(data, offsets, _SEPARATOR)
    hashes = span_hashes(data, starts, ends, FOLDED)
    heads = span_hashes(data, starts, np.minimum(ends, starts + PREFIX_BYTES), FOLDED)
    counts = np.diff(bounds)
    votes = np.zeros((len(counts), len(LANGUAGES)), np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    for at, common in enumerate(_COMMON):
        place = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        votes[:, at] = np.bincount(text[common[place] == hashes], minlength=len(counts))
    language = np.where(votes.any(axis=1), votes.argmax(axis=1), len(LANGUAGES) - 1)
    placed = bounds[:-1] + Encoded.gap * np.arange(len(counts))
    at = np.arange(len(hashes)) + Encoded.gap * text
    rows = np.full((2, len(hashes) + Encoded.gap * len(counts)), BUCKETS, np.int64)
    rows[0, at] = hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)
    rows[1, at] = mix(heads) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return Encoded(rows[0], rows[1], placed, counts, language)


@dataclass
class ToxicityModel:
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float = 0.0
    thresholds: list[float] = field(default_factory=lambda: [0.0] * len(LANGUAGES))
    fitted: bool = True

    def _windows(self, x: Encoded) -> tuple[np.ndarray, list[np.ndarray]]:
        vectors = self.embedding[x.word]
        vectors += self.embedding[x.prefix]
        n = len(vectors) - Encoded.gap + 1
        maps = []
        for width, weights in zip(WIDTHS, self.filters):
            one = vectors[:n] @ weights[0]
            for j in range(1, width):
                one += vectors[j : n + j] @ weights[j]
            maps.append(one)
        return vectors, maps

    def logits(self, x: Encoded) -> np.ndarray:
        if not len(x.starts):
            return np.zeros(0)
        _, maps = self._windows(x)
        pooled = []
        for one in maps:
            # Windows that start in the gap between two texts belong to none.
            edges = np.stack([x.starts, np.minimum(x.starts + np.maximum(x.counts, 1), len(one))], axis=1).ravel()
            if edges[-1] == len(one):
                edges = edges[:-1]
            pooled.append(np.maximum.reduceat(one, edges, axis=0)[::2])
        hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
        return hidden @ self.out + self.out_bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(offsets) - 1)
        x = encode(data, offsets)
        shifted = self.logits(x) - np.array(self.thresholds)[x.language] + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shifted, -30, 30)))


def _examples(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(data[a:b], np.array([0, b - a])) for _, _, data, o in slices(texts) for a, b in zip(o[:-1], o[1:])]


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> Encoded:
    sizes = np.concatenate([[0], np.cumsum([len(d) for d, _ in parts])])
    return encode(np.concatenate([d for d, _ in parts]), sizes)


class _Adam:
    def __init__(self, *weights: np.ndarray):
        self.weights, self.step = weights, 0
        self.first, self.second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]

    def update(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        rate = RATE * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for w, g, m, v in zip(self.weights, gradients, self.first, self.second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * m / (np.sqrt(v) + 1e-7)


def _start(examples: list, random: np.random.RandomState) -> ToxicityModel:
    """Random weights; rows of words that fewer than ``LEAST_TEXTS`` texts have are zero, as is that of an empty word."""
    texts = np.zeros(BUCKETS + 1, np.int64)
    for example in examples:
        x = encode(*example)
        for rows in (x.word, x.prefix):
            texts[np.unique(rows)] += 1
    embedding = random.normal(0, SCALE, (BUCKETS + 1, DIM)).astype(np.float32)
    embedding[texts < LEAST_TEXTS] = 0
    embedding[BUCKETS] = 0
    filters = [random.normal(0, SCALE, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    out = random.normal(0, 2 * SCALE, len(WIDTHS) * FILTERS).astype(np.float32)
    return ToxicityModel(embedding, filters, np.zeros(len(out), np.float32), out)


def _step(model: ToxicityModel, adam: _Adam, out_bias: np.ndarray, x: Encoded, y: np.ndarray, weight: np.ndarray) -> None:
    """One update by the gradient of the weighted log loss of a batch."""
    vectors, maps = model._windows(x)
    best = []
    for one in maps:
        spans = zip(x.starts, np.minimum(x.starts + np.maximum(x.counts, 1), len(one)))
        best.append(np.stack([a + one[a:b].argmax(axis=0) for a, b in spans]))
    pooled = np.concatenate([np.take_along_axis(one, b, axis=0) for one, b in zip(maps, best)], axis=1)
    active = pooled + model.bias > 0
    hidden = np.where(active, pooled + model.bias, 0)
    miss = 1 / (1 + np.exp(-np.clip(hidden @ model.out + out_bias[0], -30, 30))) - y
    miss = (miss * weight[y] / len(y)).astype(np.float32)
    down = (miss[:, None] * model.out) * active
    vector_down, filter_down = np.zeros_like(vectors), []
    for k, (width, weights) in enumerate(zip(WIDTHS, model.filters)):
        own, part = best[k], down[:, k * FILTERS : (k + 1) * FILTERS]
        found = np.zeros_like(weights)
        for j in range(width):
            for f in range(FILTERS):
                found[j, :, f] = part[:, f] @ vectors[own[:, f] + j]
                np.add.at(vector_down, own[:, f] + j, part[:, f, None] * weights[j, :, f])
        filter_down.append(found)
    table_down = np.zeros_like(model.embedding)
    touched = np.flatnonzero(vector_down.any(axis=1))
    np.add.at(table_down, x.word[touched], vector_down[touched])
    np.add.at(table_down, x.prefix[touched], vector_down[touched])
    table_down[BUCKETS] = 0
    adam.update([table_down, *filter_down, down.sum(axis=0), hidden.T @ miss, miss.sum(keepdims=True)])


def _fit(model: ToxicityModel, examples: list, classes: np.ndarray, random: np.random.RandomState) -> None:
    """``EPOCHS`` over the texts, or as many as make ``LEAST_STEPS`` updates."""
    out_bias = np.zeros(1, np.float32)
    adam = _Adam(model.embedding, *model.filters, model.bias, model.out, out_bias)
    weight = len(classes) / (2 * np.maximum(1, np.bincount(classes, minlength=2)))
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // len(examples)))):
        order = random.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            _step(model, adam, out_bias, _joined([examples[i] for i in chosen]), classes[chosen], weight)
    model.out_bias = float(out_bias[0])


def _threshold(logits: np.ndarray, classes: np.ndarray) -> float:
    """The middle of the best cut, where rejecting a share of the clean texts weighs twice as much as missing one of the toxic;
    not below ``CLEAN_DEVIATIONS`` over the mean of the clean texts, as a cut among few texts is a matter of chance."""
    clean = logits[classes == 0]
    order = np.argsort(logits, kind="stable")
    logits, classes = logits[order], classes[order]
    weight = np.where(classes == 1, 1 / max(1, classes.sum()), 2 / max(1, (1 - classes).sum()))
    right = np.concatenate([[0], np.cumsum(np.where(classes == 0, weight, -weight))])
    best = np.flatnonzero(right >= right.max() - 1e-9)
    cut = int(best[len(best) // 2])
    below = logits[cut - 1] if cut else logits[0] - 1
    above = logits[cut] if cut < len(logits) else logits[-1] + 1
    return max(float((below + above) / 2), float(clean.mean() + CLEAN_DEVIATIONS * clean.std()))


def train(texts: pa.Array, classes: list[int], seed: int = 3) -> ToxicityModel:
    """Fit on three quarters of the texts, calibrate the thresholds on the rest."""
    labels, random = np.array(classes, int), np.random.RandomState(seed)
    examples = _examples(texts)
    order = random.permutation(len(labels))
    # Every fourth of each class, in random order, calibrates.
    calibrate = np.zeros(len(labels), bool)
    for value in (0, 1):
        calibrate[order[labels[order] == value][3::4]] = True
    fit = ~calibrate
    if not (labels[fit] == 1).any() or not (labels[fit] == 0).any():
        none = np.zeros((1, 1), np.float32)
        return ToxicityModel(none, [], none[0], none[0], fitted=False)
    own = [e for e, f in zip(examples, fit) if f]
    model = _start(own, random)
    _fit(model, own, labels[fit], random)
    held = [e for e, c in zip(examples, calibrate) if c] or own
    truth = labels[calibrate] if calibrate.any() else labels[fit]
    logits, language = zip(*[(float(model.logits(x)[0]), int(x.language[0])) for x in (encode(*e) for e in held)])
    logits, language = np.array(logits), np.array(language)
    overall = _threshold(logits, truth) if 0 < truth.sum() < len(truth) else 0.0
    model.thresholds = [overall] * len(LANGUAGES)
    for at in range(len(LANGUAGES)):
        own_texts = language == at
        # A language needs some texts of both classes for a threshold of its own; it may be stricter
        # about rejecting than all texts together, which are many more, but not laxer.
        if 10 <= truth[own_texts].sum() <= own_texts.sum() - 10:
            model.thresholds[at] = max(overall, _threshold(logits[own_texts], truth[own_texts]))
    return model


def fitted_model(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic") -> ToxicityModel:
    texts, classes, _ = labelled_texts(docs, labels, label, usable, PER_CLASS)
    # Copies would pass their rare words off as evidence, and sit on both sides of the calibration.
    first = {}
    for at, text in enumerate(texts.to_pylist()):
        first.setdefault((text, classes[at]), at)
    return train(texts.take(pa.array(list(first.values()), pa.int64())), [classes[at] for at in first.values()])


def _scores(model: ToxicityModel, texts: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros(0), *[model.scores(data, offsets) for _, _, data, offsets in slices(texts)]])


def training_rows() -> Column:
    """Labelled rows that training may see."""
    return id_remainder("id", 3) != 1


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from a score of ``CUT``) of every row."""
    prepare(docs.sparkSession)
    model = fitted_model(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels, training_rows())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _scores(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= CUT).astype(np.int32))],
                schema.names,
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return rows.select("doc_id", "held_out", "text").mapInArrow(tidied(score), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; columns as they are, no row moves."""
    prepare(docs.sparkSession)
    model = fitted_model(docs, labels, training_rows())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, batch.column(own)) < CUT))

    own, rows = f"c{docs.columns.index('text')}", by_position(docs)
    return rows.mapInArrow(tidied(keep), rows.schema).toDF(*docs.columns)
