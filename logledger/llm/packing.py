"""Packing token sequences by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are the binary digits of
its length: full pieces of the sequence length first, then falling powers of
two.  Every piece is a sequence of its own, so none crosses documents and none
needs padding; sequences of one length form a bucket, from which batches of
equal shape are drawn.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 1024
END = 0
MEMO = 600_000  # runs a worker keeps, some 150 bytes each
PIECES_AT_ONCE = 20_000


class _Whole(Exception):
    """The text must be encoded as a whole."""


class _Memo(dict):
    """Ids, as little-endian bytes, of a space and a run of text without leading or trailing white space.

    Byte-level BPE of this kind cuts before a single space between two other
    characters, so such runs are encoded one by one.  Holds MEMO runs at most.
    """

    def __init__(self, encode, special: list[str]):
        super().__init__()
        self.encode = encode
        self.marked = re.compile("|".join(map(re.escape, special)) or r"(?!)").search

    def __missing__(self, run: str) -> bytes:
        if not run or run[0].isspace() or run[-1].isspace() or self.marked(run):
            raise _Whole
        if len(self) >= MEMO:
            self.clear()
        ids = self.encode(" " + run)
        packed = self[run] = struct.pack(f"<{len(ids)}I", *ids)
        return packed


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts as the tokenizer file's library gives them, without added special tokens.

    For byte-level BPE files with the usual split pattern, the merges of
    single runs go through a rank table of the same vocabulary, which gives
    the same ids faster; anything else goes to the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        plain = (spec["model"]["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                 and not split.get("add_prefix_space") and not spec.get("normalizer")
                 and not spec["model"].get("dropout"))
        self.memo = None
        if plain:
            import public_tokenizers
            import tiktoken

            chars, added = _byte_chars(), {t["content"] for t in spec["added_tokens"]}
            ranks = {bytes(chars[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                     if token not in added}
            ranked = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
            self.memo = _Memo(ranked.encode_ordinary, sorted(added))

    def __call__(self, text: str) -> bytes:
        if self.memo is not None and text:
            # a letter before the first run makes it one like the others
            first, *rest = text.split(" ")
            try:
                if not first or first[-1].isspace() or self.memo.marked(first):
                    raise _Whole
                return self.whole(first) + b"".join(map(self.memo.__getitem__, rest))
            except _Whole:
                pass
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def piece_lengths(n: int, length: int = LENGTH) -> list[int]:
    """Full pieces, then the binary digits of the rest from high to low."""
    rest = n % length
    return [length] * (n // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         end: int = END) -> DataFrame:
    """One row per piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``length`` is a power of two.  A document is its ids and then ``end``; a
    null or empty text has that id alone.  Each row of ``docs`` is packed on
    its own, repeated rows and null keys included; an empty table gives an
    empty result; other columns are ignored.

    ``sequence_id`` holds the logarithm of the sequence's length in the bits
    from 58 up and a number of its own below, so ids of one bucket are
    neighbours.  Nothing is shuffled: :func:`write_buckets` lays the buckets
    out on disk.
    """
    if length & (length - 1) or length < 1:
        raise ValueError("the sequence length must be a power of two")
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
    kinds = docs.select(F.col(key).alias(key), F.lit(0).cast("long").alias("start"),
                        F.lit(0).cast("long").alias("length"), F.lit(b"").alias("ids"),
                        F.lit(0).cast("long").alias("doc_tokens")).schema
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)

        def flushed(keys: pa.Array, places: list, rows: list) -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)]
            return pa.RecordBatch.from_arrays([keys.take(pa.array(places, pa.int64())), *columns],
                                              names=[key, *[f for f, _ in fields]])

        for b in batches:
            places, rows = [], []
            for place, t in enumerate(b.column(1)):
                ids = encode(t.as_py() or "") + tail
                n, start = len(ids) // 4, 0
                for size in piece_lengths(n, length):
                    places.append(place)
                    rows.append((start, size, ids[4 * start:4 * (start + size)], n))
                    start += size
                    if len(rows) >= PIECES_AT_ONCE:
                        yield flushed(b.column(0), places, rows)
                        places, rows = [], []
            if rows:
                yield flushed(b.column(0), places, rows)

    pieces = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, kinds)
    bucket = F.round(F.log2("length")).cast("long")
    return pieces.withColumn("sequence_id", F.shiftleft(bucket, 58) + F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long"))


def write_buckets(packed: DataFrame, path: str, files: int = 1) -> None:
    """Parquet folders by sequence length; each bucket, however large, is dealt over ``files`` tasks."""
    salted = packed.withColumn("_salt", F.pmod(F.xxhash64("sequence_id"), F.lit(files)))
    (salted.repartition("length", "_salt").drop("_salt").withColumn("bucket", F.col("length"))
     .write.mode("overwrite").partitionBy("bucket").parquet(path))
