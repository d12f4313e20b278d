import math
import zlib
from collections import Counter

import numpy as np
import pytest

from logledger.llm import quality_classifier as qc
from logledger.llm.queries import QUERIES
from tests.llm.conftest import rows


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op6_quality_classifier"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(out) == docs and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, y in held if y == 1], [s for s, _, y in held if y == 0]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    share = max(len(good), len(bad)) / len(held)
    accuracy = sum(p == y for _, p, y in held) / len(held)
    assert auc > 0.97 and accuracy > max(share, 0.95)


def test_scores_depend_on_the_text_alone(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (9, 0), (9, 0), (3, None), (None, 1), (8, 5)], "doc_id long, quality int")
    model = qc.train(odd_docs, labels, rows=10)
    out = qc.classify(odd_docs, model)
    assert out.count() == odd_docs.count()
    text = {r.doc_id: r.text for r in odd_docs.collect()}
    score = model.scorer()
    for r in out.collect():
        assert r.score == pytest.approx(score(text[r.doc_id]), abs=1e-12)
    assert rows(out) == rows(qc.classify(odd_docs, qc.train(odd_docs, labels, rows=10)))
    assert qc.classify(odd_docs.limit(0), model).count() == 0


def test_without_labels_all_scores_are_one_half(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in qc.classify(odd_docs, qc.train(odd_docs, labels)).collect()} == {0.5}


def test_long_texts_in_parts_have_all_words(monkeypatch):
    text = " ".join(f"w{i}\n" for i in range(5000))
    whole = [w for part in qc.word_parts(text) for w in part]
    monkeypatch.setattr(qc, "PART", 11)
    assert [w for part in qc.word_parts(text) for w in part] == whole == text.encode().split()


def plain_grams(word):
    """A word's hashes one by one."""
    marked = b"<" + word + b">"
    yield zlib.crc32(marked) % qc.BUCKETS
    for n in qc.GRAMS:
        for i in range(len(marked) - n + 1):
            value = 0
            for byte in marked[i:i + n]:
                value = value * qc.FACTOR % 2 ** 32 ^ byte
            yield ((value + n) * qc.SPREAD % 2 ** 32 >> 16) % qc.BUCKETS


def plain_features(text):
    words = (text or "").encode().split()
    counts = Counter(g for w in words for g in plain_grams(w))
    counts[qc.REPEAT] += qc.REPEAT_TIMES * sum(a == b for a, b in zip(words, words[1:]))
    counts = +counts
    total = sum(counts.values())
    return {g: c / total for g, c in counts.items()}


def test_repeats_across_parts():
    assert qc.repeats([b"a", b"a", b"b", b"b", b"b"], None) == 3
    assert qc.repeats([b"a", b"a"], b"a") == 2 and qc.repeats([], b"a") == 0


TEXTS = [None, "", " \n", "a", "one two two three", "Ωmega ß", "x " * 50 + "y", "lorem ipsum " * 3000, "z" * 5000]


def test_features_match_brute_force(monkeypatch):
    for part in (qc.PART, 7):
        monkeypatch.setattr(qc, "PART", part)
        for text in TEXTS:
            used, shares = (np.frombuffer(x, t) for x, t in zip(qc.features(text), ("<u4", "<f4"), strict=True))
            assert dict(zip(used.tolist(), shares.tolist(), strict=True)) == pytest.approx(plain_features(text), rel=1e-6)


def test_fit_matches_brute_force():
    """Every step of softmax regression on mean vectors, with plain lists of floats."""
    texts = [(1, "good plain words here"), (0, "bad bad junk"), (1, "other good words"), (0, "junk again bad")]
    rows_ = [(y, *qc.features(t)) for y, t in texts]
    model = qc.Model.fit(rows_, epochs=3)
    rng = np.random.default_rng(qc.SEED)
    first = rng.uniform(-1, 1, (qc.BUCKETS, qc.DIMENSIONS)).astype(np.float32) / qc.DIMENSIONS
    vectors = {g: first[g].astype(float).tolist() for _, t in texts for g in plain_features(t)}
    past = dict.fromkeys(vectors, 1e-12)
    layer, bias = [[0.0, 0.0] for _ in range(qc.DIMENSIONS)], [0.0, 0.0]
    data = [(y, plain_features(t)) for (y, _, _), t in sorted(zip(rows_, [t for _, t in texts], strict=True))]
    step, steps = 0, 3 * len(data)
    for _ in range(3):
        for i in rng.permutation(len(data)):
            y, share = data[i]
            left, step = 1 - step / steps, step + 1
            mean = [sum(s * vectors[g][d] for g, s in share.items()) for d in range(qc.DIMENSIONS)]
            out = [sum(m * w[k] for m, w in zip(mean, layer, strict=True)) + bias[k] for k in (0, 1)]
            e = [math.exp(o - max(out)) for o in out]
            error = [x / sum(e) - (k == y) for k, x in enumerate(e)]
            back = [sum(w[k] * error[k] for k in (0, 1)) for w in layer]
            for d in range(qc.DIMENSIONS):
                for k in (0, 1):
                    layer[d][k] -= left * qc.LAYER_RATE * mean[d] * error[k]
            bias = [b - left * qc.LAYER_RATE * 0.1 * x for b, x in zip(bias, error, strict=True)]
            for g, s in share.items():
                past[g] += s * s * sum(b * b for b in back)
                vectors[g] = [v - left * qc.RATE * s / math.sqrt(past[g]) * b for v, b in zip(vectors[g], back, strict=True)]
    weights = {g: sum(v * (w[1] - w[0]) for v, w in zip(vec, layer, strict=True)) for g, vec in vectors.items()}
    assert model.bias == pytest.approx(bias[1] - bias[0], rel=1e-3, abs=1e-6)
    for g, w in weights.items():
        assert model.weights[g] == pytest.approx(w, rel=1e-2, abs=1e-4)
    for text in [t for _, t in texts] + TEXTS:
        logit = model.bias + sum(s * float(model.weights[g]) for g, s in plain_features(text).items())
        assert model.scorer()(text) == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-9)


def test_scores_do_not_depend_on_what_is_remembered(monkeypatch):
    model = qc.Model(np.random.default_rng(1).normal(size=qc.BUCKETS), 0.3)
    want = [model.scorer()(t) for t in TEXTS]
    for memo, at_once, length in ((3, 5, 64), (10, 10 ** 6, 2), (10 ** 6, 1, 4)):
        monkeypatch.setattr(qc, "MEMO", memo)
        monkeypatch.setattr(qc, "WORDS_AT_ONCE", at_once)
        monkeypatch.setattr(qc, "MEMO_LENGTH", length)
        scorer = model.scorer()
        assert scorer.scores(TEXTS * 2) == pytest.approx(want * 2, rel=1e-12) and len(scorer.known) <= memo


def test_score_is_the_folded_model():
    rng = np.random.default_rng(1)
    model = qc.Model(rng.normal(size=qc.BUCKETS), 0.3)
    for text in ("", "one", "two two three", "x " * 50):
        used, shares = qc.features(text)
        logit = 0.3 + float(model.weights[np.frombuffer(used, "<u4").astype(int)] @ np.frombuffer(shares, "<f4").astype(float))
        assert model.scorer()(text) == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-5)
