"""Supervised subword embeddings: a text's words and character n-grams are hashed to learned vectors, their
mean goes through a softmax layer.

Of pairs of neighbouring words, those of a word and itself have one hash
together: what they tell is the repetition, not the word.

Vectors and layer are learned together by stochastic gradient descent in
numpy, from a bounded sample of labelled documents.  To score, the vectors are
folded with the layer into one weight per hash, so a word adds two numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
DIMENSIONS = 16
GRAMS = (3, 4, 5)
REPEAT, REPEAT_TIMES = 0, 8  # hash of a word after itself, and how often it counts beside the word's own hashes
FACTOR, SPREAD = 0x01000193, 0x9E3779B1  # of the n-grams' hash
SAMPLE = 2048
EPOCHS, RATE, LAYER_RATE, SEED = 8, 0.2, 0.5, 6
MEMO, MEMO_LENGTH = 500_000, 64  # words a worker keeps, some 150 bytes each, and their length
PART = 1 << 20
WORDS_AT_ONCE = 50_000


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, hash) of each word and its character n-grams, the word's ends marked.

    An n-gram's hash is taken over its bytes in 32-bit arithmetic, for all
    places of all words at once; the whole word's is its CRC-32.
    """
    marked = [b"<" + w + b">" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    place = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes of the word from here on
    places, hashes = [np.arange(len(marked))], [np.fromiter(map(zlib.crc32, marked), np.int64, len(marked)) & (BUCKETS - 1)]
    value = np.zeros(len(data), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        whole = max(0, len(data) - n + 1)
        value[:whole] = value[:whole] * np.uint32(FACTOR) ^ data[n - 1:n - 1 + whole]
        if n in GRAMS:
            at = np.flatnonzero(left >= n)
            mixed = (value[at] + np.uint32(n)) * np.uint32(SPREAD)
            places.append(place[at])
            hashes.append((mixed >> np.uint32(16)).astype(np.int64) & (BUCKETS - 1))
    return np.concatenate(places), np.concatenate(hashes)


def word_parts(text: str | None) -> Iterator[list[bytes]]:
    """The words of a whole text, some megabytes at a time."""
    data = (text or "").encode("utf-8", "surrogatepass")
    start = 0
    while start < len(data):
        end = start + PART
        if end < len(data):  # on to the next white space
            while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
                end += 1
        yield data[start:end].split()
        start = end


def repeats(words: list[bytes], before: bytes | None) -> int:
    """Words equal to the one before them; ``before`` is the last word of the part before."""
    return sum(map(eq, words, words[1:])) + (words[:1] == [before])


def features(text: str | None) -> tuple[bytes, bytes]:
    """Distinct hashes (uint32) of a text and their shares (float32), as bytes."""
    counts, before = np.zeros(BUCKETS), None
    for words in word_parts(text):
        counts[REPEAT] += REPEAT_TIMES * repeats(words, before)
        before = words[-1] if words else before
        seen: dict[bytes, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        if seen:
            place, hashes = grams(list(seen))
            counts += np.bincount(hashes, np.fromiter(seen.values(), np.float64, len(seen))[place], BUCKETS)
    used = np.flatnonzero(counts)
    total = max(counts.sum(), 1)
    return used.astype("<u4").tobytes(), (counts[used] / total).astype("<f4").tobytes()


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = SAMPLE) -> DataFrame:
    """(label, hashes, shares) of at most ``rows`` labelled documents, those with the smallest hashes of their keys.

    The keys are chosen from the labels alone, so what is broadcast to the
    documents is ``rows`` keys and labels at most, and no text is shuffled.
    Of documents that share a key and label, one counts.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("_k"), F.col(label).cast("int").alias("_y")).distinct()
    chosen = known.withColumn("_h", F.xxhash64("_k", F.lit(SEED))).orderBy("_h", "_k", "_y").limit(rows).drop("_h")
    joined = docs.select(F.col(key).cast("string").alias("_k"), F.col(text).cast("string").alias("_t")).join(
        F.broadcast(chosen), "_k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [features(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:2], pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                names=["_k", "label", "hashes", "shares"])

    found = joined.select("_k", "_y", "_t").mapInArrow(run, "_k string, label int, hashes binary, shares binary")
    return found.groupBy("_k", "label").agg(F.min(F.struct("hashes", "shares")).alias("f")).select("label", "f.*")


class Model:
    """One weight per hash (the difference of the two classes' outputs) and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def fit(cls, rows: list[tuple[int, bytes, bytes]], epochs: int = EPOCHS, rate: float = RATE,
            layer_rate: float = LAYER_RATE) -> Model:
        """Softmax regression on mean vectors; vectors and layer by stochastic gradient descent, rates falling to 0.

        A hash's steps are divided by the root of its past squared gradients,
        so hashes that are rare, or have small shares in long texts, learn too.
        """
        rng = np.random.default_rng(SEED)
        vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
        past = np.full(BUCKETS, 1e-12)
        layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
        rows = sorted(rows)
        data = [(y, np.frombuffer(h, "<u4").astype(np.int64), np.frombuffer(s, "<f4")) for y, h, s in rows]
        step, steps = 0, max(1, epochs * len(data))
        for _ in range(epochs):
            for i in rng.permutation(len(data)):
                y, used, share = data[i]
                left = 1 - step / steps
                step += 1
                mean = share @ vectors[used]
                out = mean @ layer + bias
                error = np.exp(out - out.max())
                error /= error.sum()
                error[y] -= 1
                back = layer @ error
                layer -= left * layer_rate * np.outer(mean, error)
                bias -= left * layer_rate * 0.1 * error
                past[used] += share.astype(np.float64) ** 2 * float(back @ back)
                vectors[used] -= ((left * rate) * share / np.sqrt(past[used]))[:, None].astype(np.float32) * back
        return cls((vectors.astype(np.float64) @ (layer[:, 1] - layer[:, 0])), float(bias[1] - bias[0]))

    def scorer(self) -> Scorer:
        return Scorer(self.weights, self.bias)


class Scorer:
    """text -> probability of label 1; a worker's memory of words, as the sum of their weights and, imaginary, the number."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.known = weights, bias, {}

    def _look_up(self, words: Iterable[bytes]) -> dict[bytes, complex]:
        """All different ``words`` with their sums; new short ones are kept."""
        words = set(words)
        new = list(words - self.known.keys())
        if len(self.known) + len(new) > MEMO:
            self.known, new = {}, list(words)
        if not new:
            return self.known
        place, hashes = grams(new)
        sums = np.bincount(place, self.weights[hashes], len(new)) + 1j * np.bincount(place, minlength=len(new))
        found = dict(zip(new, sums.tolist(), strict=True))
        if max(map(len, new)) > MEMO_LENGTH or len(new) > MEMO:
            long = {w: found.pop(w) for w in new if len(w) > MEMO_LENGTH or len(new) > MEMO}
            self.known.update(found)
            return _Both(self.known, long)
        self.known.update(found)
        return self.known

    def scores(self, texts: Iterable[str | None]) -> list[float]:
        """Scores of texts, looked up some ``WORDS_AT_ONCE`` words at a time; a long text part by part."""
        totals: list[complex] = []
        waiting: list[tuple[int, list[bytes]]] = []
        size, repeat = 0, REPEAT_TIMES * complex(self.weights[REPEAT], 1)
        for i, text in enumerate(texts):
            totals.append(0j)
            before = None
            for words in word_parts(text):
                totals[i] += repeat * repeats(words, before)
                before = words[-1] if words else before
                waiting.append((i, words))
                size += len(words)
                if size >= WORDS_AT_ONCE:
                    self._add(totals, waiting)
                    waiting, size = [], 0
        self._add(totals, waiting)
        logits = [self.bias + (t.real / t.imag if t.imag else 0.0) for t in totals]
        return (1 / (1 + np.exp(-np.clip(np.array(logits, np.float64), -500.0, 500.0)))).tolist()

    def _add(self, totals: list[complex], waiting: list[tuple[int, list[bytes]]]) -> None:
        known = self._look_up(w for _, words in waiting for w in words)
        for i, words in waiting:
            totals[i] += sum(map(known.__getitem__, words))

    def __call__(self, text: str | None) -> float:
        return self.scores([text])[0]


class _Both(dict):
    """Words not kept, and those that are."""

    def __init__(self, kept: dict[bytes, complex], others: dict[bytes, complex]):
        super().__init__(others)
        self.kept = kept

    def __missing__(self, word: bytes) -> complex:
        return self.kept[word]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = SAMPLE) -> Model:
    """A model from at most ``rows`` labelled documents.

    Labels other than 0 and 1, and rows without a key, are left out.  Only
    hashes of the sample come to the driver: at most ``rows`` times BUCKETS of
    them.  Without labelled rows every score is one half.
    """
    found = [(r.label, bytes(r.hashes), bytes(r.shares)) for r in sample(docs, labels, key, text, label, rows).collect()]
    return Model.fit(found) if found else Model(np.zeros(BUCKETS), 0.0)


def classify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, score (probability of label 1) and predicted (1 from one half up).

    Scores depend on the whole text alone; null, empty and blank texts get the
    bias's score.  Repeated rows and null keys are scored each on its own; an
    empty table gives an empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for b in batches:
            scores = pa.array(score.scores(t.as_py() for t in b.column(1)), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), scores], names=[key, "score"])

    kinds = docs.select(F.col(key).alias(key), F.lit(0.0).alias("score")).schema
    scored = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_t")).mapInArrow(run, kinds)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
