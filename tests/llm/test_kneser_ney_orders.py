import math
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from logledger.llm import kneser_ney as kn
from logledger.llm.queries import QUERIES
from tests.llm.conftest import SF
from tests.llm.test_kneser_ney import words


def brute(train, texts, order):
    """(n_tokens, n_known, base, score) by dictionaries of n-grams, each text with one <s> before it; and P(word | words)."""
    raw = [Counter() for _ in range(order + 1)]
    for t in train:
        w = ["<s>", *words(t)]
        for k in range(1, order + 1):
            raw[k].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    n, v = sum(c for g, c in raw[1].items() if g != ("<s>",)), len(raw[1]) - (("<s>",) in raw[1])
    count = [None] * (order + 1)
    for k in range(1, order + 1):
        left = Counter(g[1:] for g in raw[k + 1]) if k < order else {}
        count[k] = {g: c if k == order or g[0] == "<s>" else left[g] for g, c in raw[k].items() if g != ("<s>",)}
    cut, total, kinds = [None], defaultdict(int), defaultdict(Counter)
    for k in range(1, order + 1):
        h = Counter(count[k].values())
        y = h[1] / (h[1] + 2 * h[2]) if h[1] else 0.0
        cut.append([0, *[min(max(j - (j + 1) * y * h[j + 1] / h[j] if h[j] else j, 0), j) for j in (1, 2, 3)]])
        for g, c in count[k].items():
            total[g[:-1]] += c
            kinds[g[:-1]][min(c, 3)] += 1

    def p(context, word):
        lower = p(context[1:], word) if context else 1 / (v + 1)
        if not total[context]:
            return lower
        k = len(context) + 1
        c, d = count[k].get((*context, word), 0), cut[k]
        return (max(c - d[min(c, 3)], 0) + sum(d[j] * kinds[context][j] for j in (1, 2, 3)) * lower) / total[context]

    out = []
    for t in texts:
        w = ["<s>", *words(t)]
        out.append((len(w) - 1, sum(raw[1][(x,)] > 0 for x in w[1:]),
                    sum(math.log10((raw[1][(x,)] + .1) / (n + .1 * (v + 1))) for x in w[1:]),
                    sum(math.log10(p(tuple(w[max(0, i - order + 1):i]), w[i])) for i in range(1, len(w)))))
    return out, p, raw


def test_query_matches_brute_force_of_order_3(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs}
    want, _, _ = brute([d.text for d in docs if not out[d.doc_id]], [d.text for d in docs], 3)
    got = {r.doc_id: r for r in QUERIES["op4_lm_scoring"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d, w in zip(docs, want, strict=True):
        r = got[d.doc_id]
        assert (r.n_tokens, r.n_known) == w[:2]
        assert (r.base_score, r.score) == pytest.approx(w[2:], rel=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-w[3] / w[0]))


@pytest.mark.parametrize("order, shards", [(2, 3), (3, 1), (3, 7), (4, 5)])
def test_orders_on_odd_rows_and_unseen_texts(spark, odd_docs, tmp_path, order, shards):
    train = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["a b a c", "b a a d", "a b", "", "a b a c a b", "d a b a", None, "one two three one two"])], "doc_id long, text string")
    model = kn.train(train, f"{tmp_path}/m", shards=shards, order=order)
    for docs in (train, odd_docs):
        d = docs.collect()
        want, _, _ = brute([r.text for r in train.collect()], [r.text for r in d], order)
        got = sorted((tuple(r) for r in kn.score(docs, model).collect()), key=repr)
        for g, w in zip(got, sorted(((r.doc_id, *w) for r, w in zip(d, want, strict=True)), key=repr), strict=True):
            assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9)


def test_probabilities_of_order_3_sum_to_one():
    _, p, raw = brute(["a b a c", "b a a d", "a b"], [], 3)
    for context in (("<s>",), ("<s>", "a"), ("a", "b"), ("b", "never seen"), ()):
        assert sum(p(context, w) for w in [*[g[0] for g in raw[1] if g != ("<s>",)], "unknown"]) == pytest.approx(1)


def test_one_word_before_others_is_spread_over_the_shards():
    text = pa.array([" ".join(f"the w{i}" for i in range(4000))])
    (batch,) = kn._count(8, 2)(iter([pa.RecordBatch.from_arrays([text], names=["t"])]))
    rows = [len(kn._merged([p])[1][0]) for p in batch.column(1).to_pylist()]
    assert len(rows) == 8 and max(rows) < 1.3 * sum(rows) / 8


def test_shards_follow_the_text(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c " * 500), (2, None)], "doc_id long, text string")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert kn.train(docs, f"{tmp_path}/a").shards == partitions
    monkeypatch.setattr(kn, "SHARD_BYTES", 3000 // (2 * partitions))
    model = kn.train(docs, f"{tmp_path}/b", order=3)
    assert model.shards >= 2 * partitions
    assert kn.score(docs, model).count() == 2
