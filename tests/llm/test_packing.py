import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logledger.llm import packing
from logledger.llm.queries import QUERIES
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(library, docs, pieces, key="doc_id"):
    """Each document's pieces are its ids; sequences hold one piece, of a power of two."""
    want = defaultdict(list)
    for r in docs:
        want[r.doc_id].append(library.encode(r.text or "", add_special_tokens=False).ids + [0])
    assert len({r.sequence_id for r in pieces}) == len(pieces)
    got = defaultdict(list)
    for r in pieces:
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and 0 < r.length <= packing.LENGTH
        got[r.doc_id].append(r)
    assert set(got) == set(want)
    for k, texts in want.items():
        rows = sorted(got[k], key=lambda r: (r.doc_tokens, r.start))
        assert sum(r.length for r in rows) == sum(map(len, texts))
        digests = sorted((len(t), a, n, zlib.crc32(np.array(t[a:a + n], "<u4").tobytes())) for t in texts
                         for a, n in zip(np.cumsum([0, *packing.piece_lengths(len(t))]).tolist(),
                                         packing.piece_lengths(len(t)), strict=False))
        assert digests == sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in rows)


def test_query_round_trip(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(library, docs, QUERIES["op3_packing"](spark, SF).collect())


def test_odd_rows(spark, library, odd_docs):
    from pyspark.sql import functions as F
    out = packing.pack(odd_docs, PATH).withColumn("ids_crc32", F.crc32("ids"))
    check(library, odd_docs.collect(), out.collect())
    assert packing.pack(odd_docs.limit(0), PATH).count() == 0


def test_encoder_equals_library(library):
    rng = random.Random(3)
    bits = ["a", "the", " ", "  ", "\n", " \n", "\n ", "\t", "'s", "don't", "1234", "é", "ß", "中文", " ", "\x85", "\x1c",
            "<|endoftext|>", "!!", "...", "\U0001f600", "_", " ", "　", "x" * 40, "\r\n", "I'm", "A's "]
    encode = packing.Encoder(PATH)
    texts = ["", " ", "a", " a", "a ", "a b", *bits,
             *("".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(3000)),
             *(" ".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(3000))]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_buckets_on_disk(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(50)
    packing.write_buckets(packing.pack(docs, PATH), f"{tmp_path}/b", files=2)
    back = spark.read.parquet(f"{tmp_path}/b")
    assert back.filter("bucket <> length or octet_length(ids) <> 4 * length").count() == 0
    assert back.count() == packing.pack(docs, PATH).count()
