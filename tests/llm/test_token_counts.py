import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logledger.llm import token_counts as tc
from logledger.llm.queries import QUERIES
from tests.llm.conftest import SF, rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def machine():
    return tc.Counter(PATH)


def test_query_matches_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(d.doc_id, len((d.text or "").encode()), library(d.text), library(d.text) > 2048) for d in docs]
    assert rows(QUERIES["op8_token_counts"](spark, SF)) == sorted(want, key=repr)


@pytest.mark.parametrize("chunk", [1 << 16, 50])
def test_odd_rows_and_chunks(spark, library, odd_docs, chunk):
    want = sorted(((d.doc_id, len((d.text or "").encode()), library(d.text), library(d.text) > 100)
                   for d in odd_docs.collect()), key=repr)
    assert rows(tc.count_tokens(odd_docs, PATH, limit=100, chunk=chunk)) == want
    assert tc.count_tokens(odd_docs.limit(0), PATH).count() == 0


BITS = ["a", "the", " ", "  ", "\n", "\t", "'s", "don't", "1234", "é", "é", "ß", "ΣΑΣ", "İx", "中文字", "\x85", "\x1c", "!!",
        "!'s", "...", "\U0001f600", "_", " ", "　", "antidisestablishmentarianism", "\r\n", "I'M", "x" * 70, "²½",
        "<|endoftext|>", "<|startoftext|>", "<|endof", "qzxv", "̸", "≠"]


def test_machine_equals_library(machine, library):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["", *BITS, *("".join(rng.choice(BITS) for _ in range(rng.randint(1, 12))) for _ in range(3000)),
             *("".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)),
             *("".join(rng.choice(["th", "e", "in", "g", "tion", "an", "er", "re"]) for _ in range(rng.randint(1, 12)))
               for _ in range(3000))]
    for t in texts:
        assert machine.count(t) == library(t), repr(t)


def test_chunk_maps_compose_to_the_whole(machine, library):
    rng = random.Random(9)
    safe = [b for b in BITS if "́" not in b and "̸" not in b]
    for _ in range(300):
        text = "".join(rng.choice(safe) for _ in range(rng.randint(1, 30)))
        size = rng.randint(1, 9)
        maps = [machine.chunk_map(text[i:i + size]) for i in range(0, len(text), size)]
        assert machine.closed(machine.compose(maps)) == library(text), repr(text)


def test_long_pieces_and_few_states(machine, library, monkeypatch):
    monkeypatch.setattr(tc, "STATES", 50)
    text = "abracadabra" * 2000 + " " + "=" * 5000
    assert machine.count(text) == library(text)


def test_long_chunks_with_and_without_white_space(machine, library):
    rng = random.Random(10)
    composed = [b for b in BITS if "\u0301" not in b and "\u0338" not in b]  # a text is composed before it is cut
    closed = 0
    for n in range(400):
        bits = composed if n % 2 else [b for b in composed if not any(c.isspace() for c in b)]
        text = "".join(rng.choice(bits) for _ in range(rng.randint(20, 120)))
        size = rng.randint(31, 150)
        maps = [machine.chunk_map(text[i:i + size]) for i in range(0, len(text), size)]
        assert machine.closed(machine.compose(maps)) == library(text), repr(text)
        closed += sum(tail is not None for _, _, tail in maps) if n % 2 == 0 else 0
    assert closed > 300


def test_a_long_text_without_white_space_is_counted_by_its_chunks(spark, library, machine):
    rng = random.Random(11)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    text = "".join(rng.choices(signs, k=150_000))
    head, n, tail = machine.chunk_map(text[:4096])
    assert n > 1000 and len(head) + len(tail) < 100
    docs = spark.createDataFrame([(1, text), (2, "中文，字" * 9000), (3, "z" * 3000)], "doc_id long, text string")
    for chunk in (1 << 16, 700):
        got = {r.doc_id: r.n_tokens for r in tc.count_tokens(docs, PATH, chunk=chunk).collect()}
        assert got == {r.doc_id: library(r.text) for r in docs.collect()}
