import re

from logledger.llm import quality_rules as q
from logledger.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF, compare_with_oracle, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - q.WINDOW + 1):
        windows.setdefault(tuple(words[i:i + q.WINDOW]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(q.WINDOW)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_query_matches_oracle(spark, con):
    compare_with_oracle(con, ORACLE["op10_quality_rules"], QUERIES["op10_quality_rules"](spark, SF))


def test_counts_match_brute_force(spark, odd_docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = rows(q.features(odd_docs).select("doc_id", *names))
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in odd_docs.collect()), key=repr)


def test_odd_rows_are_judged(spark, odd_docs):
    out = q.judge(odd_docs)
    assert out.count() == odd_docs.count() and dict(out.dtypes)["kept"] == "boolean"
    assert all(not r.kept and r.base_failed for r in out.filter("n_words = 0").collect())
    assert q.judge(odd_docs.limit(0)).count() == 0


def test_estimated_posterior_beats_one_rule_for_all(spark):
    good, bad = "The cat sat quietly on mat number {}.\nIt was warm there today.\nNobody came by at {}.", "a# b$ c% d& {} e* "
    texts = [(i, good.format(i, i + 1)) for i in range(200)] + [(1000 + i, bad.format(i) + " ".join(
        f"w{i}x{k}{'#%'}" for k in range(30))) for i in range(30)]
    out = q.judge(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r.doc_id >= 1000 for r in out.filter("not kept").collect()} == {True}
    assert out.filter("kept").count() == 200
