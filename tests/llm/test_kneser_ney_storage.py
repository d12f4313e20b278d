import numpy as np
import pyarrow as pa
import pytest

from logledger.llm import kneser_ney as kn


def texts(n, seed=1):
    """Half of the words frequent, half rare."""
    rng = np.random.default_rng(seed)
    number = np.where(rng.random(n) < 0.5, rng.integers(0, 50, n), rng.integers(0, 20_000, n))
    return [" ".join(f"w{i}" for i in part) for part in np.split(number, n // 100)]


def batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["t"])


def test_packets_hold_numbers_of_words_and_no_hashes():
    (found,) = kn._count(8, 3)(iter([batch(texts(100_000))]))
    packets = found.column(1).to_pylist()
    n = sum(len(kn._merged([p])[1][0]) for p in packets)
    assert n > 90_000 and sum(map(len, packets)) < 7 * n


def test_stored_model_is_some_bytes_an_ngram(spark, tmp_path):
    rows = texts(100_000)
    grams = {g for t in rows for w in [["", "", *t.split(), "."]] for k in (1, 2, 3) for g in zip(*[w[i:] for i in range(k)], strict=False)}
    kn.train(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), f"{tmp_path}/m", shards=3, order=3)
    files = list((tmp_path / "m").rglob("*.npy"))
    assert sum(f.stat().st_size for f in files) < 13 * len(grams)
    assert not [f for f in files if "grams" in str(f)]


@pytest.mark.parametrize("columns", [[[0, 0, 0, 7], [3, 3, 9, 0], [1, 5, 0, 2]], [[5], [4], [3]], [[1, 1, 2], [0, 300_000, 1]], [[], []]])
def test_packed_and_unpacked(columns):
    columns = [np.array(c, np.int64) for c in columns]
    values = [np.arange(len(columns[0])) * 100_000, np.ones(len(columns[0]), np.int64)]
    got = kn._unpacked(kn._packed(columns, values))
    assert [[x.tolist() for x in part] for part in got] == [[x.tolist() for x in part] for part in (columns, values)]


def test_tokens_are_the_lower_cased_words_and_ends():
    rows = ["", None, " \t\r\n ", " Ab\x0bAB  ab\x0c", "ÀÉ \x1c\x85 x y", "Z"]
    tokens = kn._Tokens()
    tokens.add(pa.array(["left out", *rows, "too"]).slice(1, len(rows)))
    name = {n: w for w, n in tokens.words.items()} | {1: None}
    want = [w for t in rows for w in [*(t or "").encode().lower().split(), None]]
    assert [name[n] for n in np.concatenate(tokens.parts).tolist()] == want
    assert tokens.lengths == [len((t or "").encode().split()) + 1 for t in rows] and tokens.n == len(want)


def test_long_texts_are_taken_whole_and_one_after_the_other(monkeypatch):
    monkeypatch.setattr(kn, "TEXT_AT_ONCE", 20)
    monkeypatch.setattr(kn, "TOKENS_AT_ONCE", 15)
    rows = ["a b c", "word " * 40, None, "d", "", "e f g h"]
    found = list(kn._by_tokens(iter([batch(rows[:4]), batch(rows[4:]), batch([])])))
    assert [n for t, _ in found for n in t.lengths] == [len((t or "").split()) + 1 for t in rows]
    assert [x for _, b in found for r in b for x in r.column(0).to_pylist()] == rows and len(found) > 1


def test_words_that_were_not_numbered_are_an_error(tmp_path):
    (found,) = kn._find_words(2)(iter([batch(["a b c d e f"])]))
    files = {}
    for shard, packet in zip(*[c.to_pylist() for c in found.columns], strict=True):
        rows = kn._number_words(str(tmp_path))((shard,), kn.pd.DataFrame({"packet": [packet]}))
        files[shard] = rows["files"][0]
    numbers = kn.Numbers(files, 2)
    known = np.array([kn.START, kn.END, *[kn.xxhash.xxh64_intdigest(w) for w in b"abcdef".decode()]], np.uint64)
    assert (numbers.hashes(numbers.of(known)) == known).all()
    with pytest.raises(RuntimeError, match="numbered"):
        numbers.of(np.array([kn.xxhash.xxh64_intdigest("other")], np.uint64))
