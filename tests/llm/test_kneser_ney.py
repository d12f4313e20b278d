import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from logledger.llm import kneser_ney as kn
from logledger.llm.queries import QUERIES
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), "</s>"]


def brute(train, texts):
    """(n_tokens, n_known, N, base, score) by dictionaries of words."""
    pairs, raw = Counter(), Counter()
    for t in train:
        w = words(t)
        raw.update(w)
        pairs.update(zip(["<s>", *w], w, strict=False))
    n, v = sum(raw.values()), len(raw)
    total, kinds, different = Counter(), defaultdict(Counter), Counter()
    for (a, b), c in pairs.items():
        total[a] += c
        kinds[a][min(c, 3)] += 1
        different[b] += 1

    def cuts(counts):
        h = Counter(counts)
        y = h[1] / (h[1] + 2 * h[2]) if h[1] else 0.0
        return [0, *[min(max(k - (k + 1) * y * h[k + 1] / h[k] if h[k] else k, 0), k) for k in (1, 2, 3)]]

    d2, d1 = cuts(pairs.values()), cuts(different.values())
    spread = sum(d1[min(c, 3)] for c in different.values())

    def p1(b):
        if not pairs:
            return 1 / (v + 1)
        c = different[b]
        return (max(c - d1[min(c, 3)], 0) + spread / (v + 1)) / len(pairs)

    def p2(a, b):
        if not total[a]:
            return p1(b)
        c = pairs[a, b]
        return (max(c - d2[min(c, 3)], 0) + sum(d2[k] * kinds[a][k] for k in (1, 2, 3)) * p1(b)) / total[a]

    out = []
    for t in texts:
        w = words(t)
        out.append((len(w), sum(raw[x] > 0 for x in w), n, sum(math.log10((raw[x] + .1) / (n + .1 * (v + 1))) for x in w),
                    sum(math.log10(p2(a, b)) for a, b in zip(["<s>", *w], w, strict=False))))
    return out, p2, raw


def same(got, want):
    assert got[:3] == want[:3]
    assert got[3:] == pytest.approx(want[3:], rel=1e-9)


def test_whole_table_matches_brute_force_of_order_2(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = table.collect()
    out = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs}
    want, _, _ = brute([d.text for d in docs if not out[d.doc_id]], [d.text for d in docs])
    model = kn.train(table.filter(~kn.held_out(table["doc_id"])), f"{tmp_path}/m", order=2)
    got = {r.doc_id: r for r in kn.score(table, model).collect()}
    assert len(got) == len(docs)
    better = 0
    for d, w in zip(docs, want, strict=True):
        r = got[d.doc_id]
        same((r.n_tokens, r.n_known, model.n_tokens, r.base_score, r.score), w)
        better += r.score > r.base_score
    assert better > 0.5 * len(docs)


def test_query_columns(spark):
    rows = QUERIES["op4_lm_scoring"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    assert len({r.train_tokens for r in rows}) == 1 and rows[0].train_tokens == sum(r.n_tokens for r in rows if not r.held_out)


@pytest.mark.parametrize("shards", [1, 5])
def test_odd_rows(spark, odd_docs, tmp_path, shards):
    docs = odd_docs.collect()
    want, _, _ = brute([d.text for d in docs], [d.text for d in docs])
    model = kn.train(odd_docs, f"{tmp_path}/m", shards=shards)
    got = sorted((tuple(r) for r in kn.score(odd_docs, model).collect()), key=repr)
    want = sorted(((d.doc_id, w[0], w[1], w[3], w[4]) for d, w in zip(docs, want, strict=True)), key=repr)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9)
    assert kn.score(odd_docs.limit(0), model).count() == 0


def test_without_training_texts(spark, odd_docs, tmp_path):
    model = kn.train(odd_docs.limit(0), f"{tmp_path}/m", shards=3)
    r = kn.score(odd_docs.filter("doc_id = 7"), model).first()
    assert (r.n_tokens, r.n_known, r.score) == (3, 0, 0.0)


def test_probabilities_sum_to_one():
    _, p, raw = brute(["a b a c", "b a a d", "a b"], [])
    for before in ("<s>", "a", "never seen"):
        assert sum(p(before, w) for w in [*raw, "unknown"]) == pytest.approx(1)


def test_discounts_and_shards():
    assert kn.discounts([0, 0, 0, 0]) == [0.0, 1.0, 2.0, 3.0]
    h = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 1000, dtype=np.uint64))
    s = kn._shard(h, 7)
    assert (np.diff(s.astype(int)) >= 0).all() and set(s.tolist()) == set(range(7))
