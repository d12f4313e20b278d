from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as cp
from logledger.llm import mixing, quality_rules, secrets
from tests.llm import test_mixing, test_packing, test_secrets, test_simhash
from tests.llm.conftest import SF, rows


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select(*cp.COLUMNS)


def test_each_stage_against_brute_force(spark):
    docs = documents(spark)
    judged = {r.doc_id for r in quality_rules.judge(docs).filter("kept").collect()}
    kept = cp.quality(spark, docs, SF).cache()
    assert rows(kept) == rows(docs.filter(F.col("doc_id").isin(list(judged))))

    text = [(r.doc_id, test_simhash.brute_fingerprint(r.text)) for r in kept.collect()]
    first = set(test_simhash.brute_components(text, 4))
    single = cp.near_dedup(spark, kept, SF).cache()
    assert rows(single) == rows(kept.filter(F.col("doc_id").isin(list(first))))
    assert 0 < single.count() < kept.count()

    first = single.agg(F.min("doc_id")).first()[0]  # the small table has no live secret
    planted = F.concat("text", F.lit(" password=Zx81mQp0LsT5vYw2"))
    single = single.withColumn("text", F.when(F.col("doc_id") == first, planted).otherwise(F.col("text"))).cache()
    masked = cp.scan_secrets(spark, single, SF).cache()
    assert masked.columns == cp.COLUMNS
    before = {r.doc_id: r for r in single.collect()}
    hidden = 0
    for r in masked.collect():
        was = before[r.doc_id]
        assert r.n_chars == len(r.text)
        if r.text != was.text:
            hidden += 1
            assert secrets.MASK in r.text and (r.lang, r.source) == (was.lang, was.source)
            assert len(test_secrets.brute_base(r.text)) < len(test_secrets.brute_base(was.text)) or "opaque" in str(r)
    assert hidden

    mixed = cp.mix_sources(spark, masked, SF).cache()
    copies = Counter(r.doc_id for r in mixed.collect())
    taken = {r.doc_id: r for r in mixing.taken(mixing.mix(masked)).collect()}
    assert copies == Counter({i: r.copies for i, r in taken.items() if r.copies})
    test_mixing.check(masked.collect(), list(taken.values()))

    pieces = cp.pack(spark, mixed, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    test_packing.check(library, mixed.collect(), pieces)


def test_run_is_the_stages_in_turn(spark):
    out = entry.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    docs = documents(spark)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert rows(out.drop("sequence_id")) == rows(docs.drop("sequence_id"))
    assert [name for name, _ in cp.STAGES] == ["quality_rules", "simhash_near_dedup", "secret_scan", "mixing", "packing"]


def test_stages_take_odd_rows(spark):
    long = "The first sentence stands here and ends. " * 3 + " ".join(f"word{i} goes on," for i in range(400)) + "."
    data = [(1, long, "en", "a", 1), (1, long, "en", "a", 1), (None, long + " But other words follow it.", None, None, None),
            (None, None, "en", "a", 0), (3, "", "en", "b", 0), (4, long.upper(), "en", None, 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("copies", "KEPT", "size", "component_id", "Fingerprint", "n_words", "live", "target", "_x", "row", "spans"):
        docs = docs.withColumn(c, F.lit("other"))
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert cp.near_dedup(spark, docs.limit(2), SF).count() == 1

    good = {(r.doc_id, r.text) for r in quality_rules.judge(docs.select("doc_id", "text").withColumn(
        "_text_key", secrets.text_key(F.col("text")))).filter("kept").join(
            docs.select(F.col("doc_id").alias("k"), "text", secrets.text_key(F.col("text")).alias("x")),
            F.expr("doc_id <=> k and _text_key = x")).collect()}
    assert rows(cp.quality(spark, docs, SF)) == sorted((r for r in data if (r[0], r[1]) in good), key=repr)

    prints = [test_simhash.brute_fingerprint(r[1]) for r in data]
    group = list(range(len(data)))
    for _ in data:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    kept = cp.near_dedup(spark, docs, SF).collect()
    of = {r: group[i] for i, r in enumerate(data)}
    assert sorted(of[tuple(r)] for r in kept) == sorted(set(group))
    for r in kept:
        ids = [d[0] for d in data if of[d] == of[tuple(r)] and d[0] is not None]
        assert r.doc_id == min(ids, default=None)

    assert rows(cp.scan_secrets(spark, docs, SF)) == sorted(
        ((*r[:4], None if r[1] is None else len(r[1])) for r in data), key=repr)
    copies = Counter((r.doc_id, r.source) for r in cp.mix_sources(spark, docs, SF).collect())
    want = Counter()
    for r in mixing.taken(mixing.mix(docs)).collect():
        want[r.doc_id, r.source] += r.copies
    assert copies == +want and copies
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    once = docs.dropDuplicates(["doc_id"])
    test_packing.check(library, once.collect(), cp.pack(spark, once, SF).collect())


def test_rows_without_ids_are_mixed_each_on_its_own(spark):
    data = [(None, f"{s} w{i}", "en", s, 0) for s in "abc" for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    copies = Counter(r.text for r in cp.mix_sources(spark, docs, SF).collect())
    taken = Counter()
    for text, n in copies.items():
        taken[text[0]] += 2 * n
    for s, target in test_mixing.brute_targets({s: 600 for s in "abc"}).items():
        assert abs(taken[s] - target) <= 4
    assert taken["b"] < 600 < taken["c"] < 1200
