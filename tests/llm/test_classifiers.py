import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from helpers import awkward, make_docs  # noqa: F401
from pyspark.sql import functions as F

from martlet.llm import labelled, quality, toxicity

MEDIUM, LARGE = SMALL.replace("0.001", "0.01"), SMALL.replace("0.001", "0.1")


def tables(spark, folder):
    return [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]


@pytest.mark.parametrize("folder, least_area, least_recall, most_wrong", [(LARGE, 0.97, 0.85, 0.035), (MEDIUM, 0.85, 0.4, 0.06)])
def test_toxicity_on_held_out_rows(spark, folder, least_area, least_recall, most_wrong):
    """The ranking, and both kinds of errors. The smaller table has 18 toxic texts to test and 33 to learn from."""
    docs, labels = tables(spark, folder)
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    order, good = rows.score.rank(), rows.toxic == 1
    area = (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area >= least_area
    assert rows[good].predicted.mean() >= least_recall and rows[~good].predicted.mean() <= most_wrong


def test_quality_on_held_out_rows(spark):
    docs, labels = tables(spark, MEDIUM)
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (rows.predicted == rows.quality).mean() >= 0.95


@pytest.mark.parametrize("scores", [toxicity.toxicity_scores, quality.quality_scores])
def test_awkward_rows(spark, make_docs, awkward, scores):
    texts = [(i, ("bad evil words " if i % 2 else "good kind words ") * 40) for i in range(100, 160)]
    labels = spark.createDataFrame(
        [(i, 1 - i % 2, i % 2) for i, _ in texts] + [(None, 1, 1), (1, None, None), (2, 0, 0), (2, 0, 0), (999, 1, 1)],
        "doc_id long, quality int, toxic int",
    ).withColumn("text", F.lit("clash"))
    docs = make_docs(awkward + texts).withColumn("score", F.lit("clash")).withColumn("held_out", F.lit(1))
    rows = scores(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in awkward + texts)
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None and r["doc_id"] >= 100}
    assert len({r["predicted"] for r in by_id.values()}) == 2
    assert scores(docs.limit(0), labels).collect() == []
    assert len({r["score"] for r in scores(docs, labels.limit(0)).collect()}) == 1


def test_scores_do_not_depend_on_the_batch(spark):
    """A text's score is its own, whatever texts stand around it."""
    docs, labels = tables(spark, SMALL)
    found = docs.limit(40).toPandas()
    texts = pa.array([*found.text, "", None, "a b c"], pa.large_string())
    for model, score in (
        (toxicity.fitted_model(docs, labels, F.lit(True)), toxicity._scores),
        (quality.train(*labelled.labelled_texts(docs, labels, "quality", F.lit(True), 50)[:2]), lambda m, t: m.scores(t)),
    ):
        whole = score(model, texts)
        alone = np.concatenate([score(model, texts.slice(i, 1)) for i in range(len(texts))])
        assert np.allclose(whole, alone, atol=1e-4)


def test_dropping_the_toxic_keeps_columns(spark):
    docs, labels = tables(spark, SMALL)
    kept = toxicity.drop_toxic(docs.withColumns({c: F.lit(1) for c in ("extra", "row", "a.b", "score")}), labels)
    assert kept.columns == [*docs.columns, "extra", "row", "a.b", "score"] and 0 < kept.count() <= docs.count()


def test_sample_is_bounded_and_reads_no_held_out_row(spark):
    docs, labels = tables(spark, MEDIUM)
    _, classes, ids = labelled.labelled_texts(docs, labels, "toxic", toxicity.training_rows(), 20)
    assert classes.count(1) == 20 and classes.count(0) == 20
    import zlib

    assert all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)


def test_quality_gradients():
    """The written gradients agree with differences."""
    random.seed(0)
    rand = np.random.RandomState(0)
    rows, bounds, y = rand.normal(0, 1, (9, 5)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    shapes = [(5, 4), (4,), (4, 3), (4, 3), (3,), (4,), (1,)]
    model = quality.QualityModel(np.zeros(5), np.ones(5), [rand.normal(0, 0.5, s) for s in shapes])

    def loss():
        p = model.forward(rows, bounds)["score"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for weights, gradient in zip(model.weights, model.gradients(rows, bounds, y)):
        for at in list(np.ndindex(weights.shape))[:6]:
            weights[at] += 1e-6
            up = loss()
            weights[at] -= 2e-6
            down = loss()
            weights[at] += 1e-6
            assert abs((up - down) / 2e-6 - gradient[at]) < 1e-5


def test_threshold_prefers_clean_texts():
    assert toxicity._threshold(np.array([-2.0, -1.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 1.0
    one_above = toxicity._threshold(np.array([0.0, 1.0, 2.0, 3.0]), np.array([0, 1, 0, 1]))
    assert 2 < one_above < 3


def test_sample_takes_one_text_for_each_id_and_keeps_to_the_bytes(spark, make_docs):
    rows = [(i, f"text {i} " * 10) for i in range(40)] + [(i, f"other {i}") for i in range(40)] * 50 + [(40, "x" * 10_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(41)] + [(3, 0), (3, 1)], "doc_id long, quality int")
    labels = labels.withColumns({c: F.lit("clash") for c in ("label", "order", "of", "text")})
    docs = make_docs(rows).withColumn("label", F.lit(7)).withColumn("id", F.lit(8))
    texts, classes, ids = labelled.labelled_texts(docs, labels, "quality", F.lit(True), 50)
    assert len(ids) == 42 and sorted(set(ids)) == list(range(41))  # one id has both labels
    some, _, _ = labelled.labelled_texts(docs, labels, "quality", F.lit(True), 50, bytes_per_class=500)
    assert 0 < sum(len(t) for t in some.to_pylist()) <= 1000
    few, classes, _ = labelled.labelled_texts(docs, labels, "quality", F.lit(True), 1)
    assert len(few) == 2 and sorted(classes) == [0, 1]


def plain_toxicity(model, text):
    """The logit of one text, word by word, in plain Python."""
    import re

    words = re.findall(rb"(?:[0-9A-Za-z]|[\x80-\xff])+", (text or "").encode())
    buckets = []
    for word in words:
        raw = np.frombuffer(word, np.uint8)
        one = toxicity.span_hashes(raw, np.array([0, 0]), np.array([len(raw), min(len(raw), toxicity.PREFIX_BYTES)]), toxicity.FOLDED)
        shift = 64 - toxicity.BUCKETS.bit_length() + 1
        buckets.append((int(one[0]) >> shift, int(toxicity.mix(one[1:])[0]) >> shift))
    vectors = [model.embedding[a] + model.embedding[b] for a, b in buckets] + [np.zeros(toxicity.DIM)] * max(toxicity.WIDTHS)
    hidden = []
    for width, weights in zip(toxicity.WIDTHS, model.filters):
        for f in range(toxicity.FILTERS):
            windows = [sum(float(vectors[i + j] @ weights[j, :, f]) for j in range(width)) for i in range(max(1, len(words)))]
            hidden.append(max(0.0, max(windows) + float(model.bias[len(hidden)])))
    return float(np.dot(hidden, model.out) + model.out_bias)


def test_toxicity_against_a_plain_forward_pass():
    rand, words = random.Random(4), [f"w{i}" for i in range(60)] + ["É", "bad", "Evil-one"]
    texts = [" ".join(rand.choices(words, k=rand.choice([0, 1, 2, 3, 30]))) for _ in range(60)]
    model = toxicity.train(pa.array([t + " bad" * (i % 2) for i, t in enumerate(texts)], pa.large_string()), [i % 2 for i in range(60)])
    for text in [*texts, "", None]:
        for _, _, data, offsets in toxicity.slices(pa.array([text], pa.large_string())):
            assert abs(model.logits(toxicity.encode(data, offsets))[0] - plain_toxicity(model, text)) < 1e-4


def test_words_unknown_to_training_do_not_count():
    texts = ["good day friend"] * 30 + ["bad evil foe"] * 30
    model = toxicity.train(pa.array([f"{t} {i}" for i, t in enumerate(texts)], pa.large_string()), [0] * 30 + [1] * 30)
    one, other = toxicity._scores(model, pa.array(["good day friend", "zzyzx good day friend qwxyv"], pa.large_string()))
    assert abs(one - other) < 0.01
    assert not model.embedding[toxicity.encode(np.frombuffer(b"zzyzx qwxyv", np.uint8), np.array([0, 11])).word].any()


def test_quality_against_a_plain_forward_pass():
    rand = np.random.RandomState(2)
    rows, bounds = rand.normal(0, 1, (12, 5)), [0, 1, 5, 12]
    shapes = [(5, 4), (4,), (4, 3), (4, 3), (3,), (4,), (1,)]
    model = quality.QualityModel(rand.normal(0, 1, 5), np.full(5, 1.5), [rand.normal(0, 0.7, s) for s in shapes])
    w, b, v, u, a, c, c0 = model.weights
    scores = model.forward(rows, np.array(bounds))["score"]
    for k, (first, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        encoded = [np.tanh(((r - model.center) / model.scale).clip(-8, 8) @ w + b) for r in rows[first:end]]
        attention = [np.exp(float((np.tanh(h @ v) / (1 + np.exp(-(h @ u)))) @ a)) for h in encoded]
        bag = sum(h * x for h, x in zip(encoded, attention)) / sum(attention)
        assert abs(scores[k] - 1 / (1 + np.exp(-(bag @ c + c0[0])))) < 1e-9


def test_one_passage_decides():
    """Bags of nine ordinary passages and one that is good or bad, anywhere in the text."""
    rand = random.Random(1)
    plain = [f"plain{i}" for i in range(40)]

    def text(mark):
        passages = [" ".join(rand.choices(plain, k=64)) for _ in range(9)]
        passages.insert(rand.randrange(10), " ".join(rand.choices(mark, k=64)))
        return " ".join(passages)

    good, bad = ["Fine, well said."], ["$$$ ### BUY|NOW"]
    texts = [text(good if i % 2 else bad) for i in range(240)]
    model = quality.train(pa.array(texts[:160], pa.large_string()), [i % 2 for i in range(160)])
    scores = model.scores(pa.array(texts[160:], pa.large_string()))
    assert ((scores >= 0.5) == (np.arange(160, 240) % 2 == 1)).mean() >= 0.95
