import re
from collections import defaultdict

import pytest

from logledger.llm import mixing
from logledger.llm.queries import QUERIES
from tests.llm.conftest import SF, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, capped, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        target |= {s: left * weight[s] / total for s in free}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        capped |= over


def check(docs, out):
    sizes = defaultdict(int)
    for r in docs:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    targets = brute_targets(sizes)
    assert sorted(((r.doc_id, len(WORD.findall(r.text or "")), r.source) for r in docs), key=repr) == sorted(
        ((r.doc_id, r["size"], r.source) for r in out), key=repr)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= largest[s] + max(largest.values())


def test_query_hits_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()
    one = QUERIES["op9_mixing"](spark, SF)
    check(docs, one.collect())
    assert rows(one) == rows(QUERIES["op9_mixing"](spark, SF))


def test_buckets_do_not_change_running_sums(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = ["doc_id", "epoch", "served", "finish", "size"]
    got = sorted(mixing.mix(docs, bucket=7).select(*cols).collect(), key=lambda r: r.served)
    run = 0
    for r in got:
        run += r["size"]
        assert r.served == run
    assert all(a.finish <= b.finish for a, b in zip(got, got[1:], strict=False))


def test_odd_rows(spark, odd_docs):
    check(odd_docs.collect(), mixing.taken(mixing.mix(odd_docs)).collect())
    assert mixing.taken(mixing.mix(odd_docs.limit(0))).count() == 0
    blank = odd_docs.filter("text is null or text = ''")
    assert {r.taken for r in mixing.taken(mixing.mix(blank)).collect()} == {0}


def test_in_order_is_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix(docs)
    out = mixing.in_order(mixed).select("served", "size").collect()
    run = 0
    for r in out:
        run += r["size"]
        assert r.served == run
    budget = mixed.select("source", "target").distinct().agg({"target": "sum"}).first()[0]
    assert budget - max(r["size"] for r in mixed.select("size").collect()) <= run <= budget


def test_one_key_and_empty_texts_do_not_fill_a_bucket(spark):
    docs = spark.range(300).selectExpr("if(id % 3 = 0, 5, id) as doc_id", "'a b' as text", "'s' as source").unionAll(
        spark.range(300).selectExpr("cast(null as long)", "''", "'empty'"))
    out = mixing.mix(docs, bucket=20)
    check(docs.collect(), mixing.taken(out).collect())
    assert out.filter("source = 'empty'").select("finish").distinct().count() > 100
    assert out.filter("doc_id = 5").selectExpr("round(finish, 1)").distinct().count() > 5


def test_repeated_keys_do_not_depend_on_files_or_buckets(spark):
    # the size tells the rows of a key apart; every 4th is there three times
    data = [(None if i % 2 else 5, " ".join(["w"] * (i + 1)), "ab"[i % 3 == 0])
            for i in range(90) for _ in range(3 if i % 4 == 0 else 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    cols = ["doc_id", "size", "source", "epoch", "finish", "served", "taken_copy"]
    want = rows(mixing.mix(docs.coalesce(1)).select(*cols))
    backwards = spark.createDataFrame(data[::-1], docs.schema)
    for other, bucket in ((backwards.coalesce(1), mixing.BUCKET), (docs.repartition(5, "text"), 8), (backwards, 20)):
        assert rows(mixing.mix(other, bucket=bucket).select(*cols)) == want
