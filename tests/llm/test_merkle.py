import hashlib
import zlib

import pytest

from logledger.llm import merkle
from logledger.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF, compare_with_oracle, rows


def test_query_matches_oracle(spark, con):
    compare_with_oracle(con, ORACLE["op13_merkle_manifest"], QUERIES["op13_merkle_manifest"](spark, SF))


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def beside(levels, i):
    for level in levels[:-1]:
        run = i - i % 3
        yield level[run:i], level[i + 1:run + 3]
        i //= 3


def brute_force(data):
    """Rows (doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    first = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted({r[1] for r in data}, key=lambda v: (v is not None, (v or "").encode()))
    groups = {s: sorted((r for r in data if r[1] == s), key=lambda r: (first(r[0]), leaf(r))) for s in sources}
    trees = {s: tree([leaf(r) for r in g]) for s, g in groups.items()}
    top = tree([trees[s][-1][0] for s in sources]) if data else None
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(groups[s]):
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            node, proof = leaf((*r[:4], r[4].replace("\n", "") if cut else r[4])), ""
            for left, right in [*beside(trees[s], i), *beside(top, k)]:
                node, proof = h(*left, node, *right), proof + "".join(left + right)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, data):
    df = spark.createDataFrame([(*r, "z", 1) for r in data], "doc_id long, source string, lang string, n_chars long,"
                               " text string, leaf string, _pos int")
    return rows(merkle.manifest(df, tampered=merkle.without_newlines()))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_small_trees(spark, n):
    data = [(i, f"s{i % 2}", "en", i, f"a\n{i}") for i in range(n)]
    assert run(spark, data) == brute_force(data)


def test_odd_rows(spark):
    data = [(None, None, None, None, None), (None, None, None, None, None), (-5, None, "é", 0, ""), (2, "b", "x", 1, "a\nb"),
            (2, "b", "x", 1, "a\nb"), (2, "b", "x", 1, "other\n"), (7, "", "y", 2, "Ω" * 300_000 + "\n"), (8, "é", None, 3, "-"),
            (9, "z", "", 4, "\n"), (10, "😀", "q", 5, "\n\n"), (11, "ａ", "q", 5, "x")]
    assert run(spark, data) == brute_force(data)
    assert run(spark, []) == []


def test_more_than_one_round_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    data = [(i, "hot" if i % 3 else f"s{i}", "en", i, f"{i}\n") for i in range(100)]
    assert run(spark, data) == brute_force(data)


def test_tampering_is_found(spark):
    data = [(i, "s", "en", 3, f"{i}\n") for i in range(40)]
    for r in run(spark, data):
        assert r[6] == (zlib.crc32(str(r[0]).encode()) % 2 == 1)
