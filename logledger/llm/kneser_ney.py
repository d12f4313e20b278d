"""Interpolated modified Kneser-Ney model of any order from 2 on.

Words: a first read of the texts numbers their words, frequent ones small, so
that an n-gram is some bytes on disk wherever it goes, and not its words' hashes.

Counting: every task counts the n-grams of the highest order in some
million tokens at a time and emits them packed by shard of the n-gram's hash;
Spark brings a shard's packets together, and they are merged and stored packed,
so no row is made per token.  A stored shard emits, packed in the same way for
the order below, its n-grams without their first word (for their counts: how
many different words come before) and without their last (for the totals of
contexts), so all lower orders come from the highest one's counts.  Last, the
packed n-grams of each order are replaced by the arrays that scoring looks up,
one order after the other; shuffle files are released as soon as they are read.

Texts begin with START.  As usual, n-grams that begin with START count as
often as they occur, there being one word before them only, and the first
words of a text are predicted by the orders that their context fills.

Scoring: workers memory-map the arrays, sorted by hash, and look up the sorted
hashes of many tokens at once.  Words and n-grams are known by 64-bit hashes.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.session import forget_shuffles

TOKENS_AT_ONCE = 1_000_000
TEXT_AT_ONCE = 1 << 23  # bytes, or one text
SHARD_BYTES = 1 << 24  # of text a shard, about; with it goes what a task merges
START, END = 1, 2  # hashes kept for the text's beginning, never predicted, and its end
ADDED = 0.1
MODULUS, HELD_OUT = 10, 0
ORDER = 3  # of the registered query


def held_out(key: Column) -> Column:
    """Documents kept out of training: CRC-32 of the key as text; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % MODULUS == HELD_OUT


class _Words(dict):
    """Numbers of words from 2 on, in order of appearance, with their hashes; 0 is START and 1 END."""

    def __init__(self):
        super().__init__()
        self.hashes = [START, END]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return n


class _Tokens:
    """Tokens of some texts, as numbers of their words in order of hash."""

    def __init__(self):
        self.words, self.parts, self.lengths, self.n = _Words(), [], [], 0

    def add(self, texts: pa.Array) -> None:
        """Adds the lower-cased words of whole texts, each with its end."""
        found = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null(""))))
        words = found.flatten()
        kept = pc.greater(pc.binary_length(words), 0)  # a blank text is split into one empty word
        sizes = 1 + np.where(pc.equal(pc.binary_length(pc.list_element(found, 0)), 0), 0, pc.list_value_length(found))
        coded = words.filter(kept).dictionary_encode()
        names = coded.dictionary.cast(pa.binary()).to_pylist()
        number = np.fromiter(map(self.words.__getitem__, names), np.int32, len(names))
        ends = np.cumsum(sizes) - 1
        part = np.ones(int(sizes.sum()), np.int32)
        inside = np.ones(len(part), bool)
        inside[ends] = False
        part[inside] = number[coded.indices.to_numpy()]
        self.parts.append(part)
        self.lengths.extend(sizes.tolist())
        self.n += len(part)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the words, sorted; how often each occurs)."""
        hashes = np.array(self.words.hashes, np.uint64)
        ranks = np.argsort(hashes)
        return hashes[ranks], np.bincount(np.concatenate(self.parts), minlength=len(hashes))[ranks]

    def ngrams(self, order: int) -> tuple[np.ndarray, list[_Grams], np.ndarray]:
        """(hashes of the words, sorted; per length from 2 to ``order`` its different n-grams; for each token its word)."""
        hashes = np.array(self.words.hashes, np.uint64)
        ranks = np.argsort(hashes)
        rank = np.empty(len(ranks), np.int64)
        rank[ranks] = np.arange(len(ranks))
        hashes, own = hashes[ranks], rank[np.concatenate(self.parts)]
        starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        found = []
        ends, keys, beginning = own, hashes, rank[0]  # per token the n-gram that ends there; hashes; that of START alone
        for _ in range(order - 1):
            context = _shifted(ends, starts, beginning)
            code, at, place = _different(context * len(hashes) + own)
            context, word = np.divmod(code, len(hashes))
            grams = _Grams(mix(keys[context], hashes[word]), context, ends[at], place)
            # one more, which is nowhere: a context of START alone
            keys, beginning = np.append(grams.keys, mix(keys[[beginning]], hashes[rank[:1]])), len(code)
            ends = place
            found.append(grams)
        return hashes, found, own

    def columns(self, place: np.ndarray, order: int) -> list[np.ndarray]:
        """For each token the places of the word ``order - 1`` before it, ..., of the one before and of its own."""
        columns, starts = [place[np.concatenate(self.parts)]], np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        for _ in range(order - 1):
            columns.insert(0, _shifted(columns[0], starts, place[0]))
        return columns


def _different(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different codes in order, a place of each, for each place the number of its code)."""
    order = np.argsort(code)
    code = code[order]
    first = np.concatenate((code[:1] == code[:1], code[1:] != code[:-1]))
    number = np.empty_like(order)
    number[order] = np.cumsum(first) - 1
    return code[first], order[first], number


class _Grams:
    """Different n-grams of some tokens: hashes; numbers of the context and of the n-gram without its first word among
    those one shorter; for each token the number of its n-gram."""

    def __init__(self, keys, context, suffix, place):
        self.keys, self.context, self.suffix, self.place = keys, context, suffix, place


def _shifted(values: np.ndarray, starts: np.ndarray, first: int) -> np.ndarray:
    """Each token's value moved to the next token of its text, ``first`` at the text's beginning."""
    out = np.concatenate(([first], values[:-1]))
    out[starts] = first
    return out


def mix(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from those of its context and its last word."""
    with np.errstate(over="ignore"):
        x = before * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash, rising with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _small(x: np.ndarray) -> np.ndarray:
    """Numbers in the smallest unsigned type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _planes(a: np.ndarray) -> bytes:
    """An array's lowest bytes, then the next ones and so on: alike ones stand together."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _packed(columns: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """N-grams in order, by numbers of their words, and their values.

    Of a number stands its distance to the one above where the words before it are the same as there.
    """
    n = len(columns[0])
    same, arrays = np.arange(n) > 0, []
    for c in columns:
        step = np.diff(c.astype(np.int64), prepend=0)
        arrays.append(_small(np.where(same, step, c)))
        same = same & (step == 0)
    arrays += [_small(v) for v in values]
    head = np.array([n, len(columns), *[a.itemsize for a in arrays]], np.int64).tobytes()
    body = pa.Codec("zstd").compress(b"".join(map(_planes, arrays)), asbytes=True)
    return bytes([len(head) // 8]) + head + body


def _unpacked(data: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    end = 1 + 8 * data[0]
    n, width, *sizes = np.frombuffer(data[1:end], np.int64).tolist()
    body = np.frombuffer(pa.Codec("zstd").decompress(data[end:], n * sum(sizes), asbytes=True), np.uint8)
    arrays, at = [], 0
    for size in sizes:
        part = body[at:at + n * size].reshape(size, n).T
        arrays.append(np.ascontiguousarray(part).view(f"<u{size}").ravel())
        at += n * size
    columns, same = [], np.arange(n) > 0
    for c in arrays[:width]:
        upto = np.cumsum(c, dtype=np.int64)
        first = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        columns.append(_small(upto - (upto - c)[first]))
        same = same & (c == 0)
    return columns, arrays[width:]


def _codes(columns: list[np.ndarray], bound: int = 0) -> np.ndarray:
    """A number for each row of the columns, rising with their order; all are below ``bound``, if given."""
    code, size = columns[0].astype(np.int64), bound or int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        n = bound or int(c.max(initial=0)) + 1
        if size * n >= 1 << 62:
            found, code = np.unique(code, return_inverse=True)
            size = len(found)
        code, size = code * n + c.astype(np.int64), size * n
    return code


def _summed(columns: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Different n-grams in order, with the sums of their values."""
    code = _codes(columns)
    order = np.argsort(code, kind="stable")
    code = code[order]
    starts = np.flatnonzero(np.concatenate((code[:1] == code[:1], code[1:] != code[:-1])))
    first = order[starts]
    return [c[first] for c in columns], [_small(np.add.reduceat(v[order], starts, dtype=np.int64)) if len(v) else v for v in values]


def _placed(columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(the numbers in use, sorted; the columns as places among them)."""
    top = 1 + max(int(c.max(initial=0)) for c in columns)
    if top > 8 * sum(map(len, columns)):
        used, place = np.unique(np.concatenate(columns), return_inverse=True)
        return used, np.split(place, len(columns))
    found = np.zeros(top, bool)
    for c in columns:
        found[c] = True
    place = np.cumsum(found, dtype=np.min_scalar_type(top)) - 1
    return np.flatnonzero(found), [place[c] for c in columns]


def _merged(packets: Iterable[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(numbers of the words, n-grams by places among them, sums of their values) of some packets."""
    found = [_unpacked(p) for p in packets]
    columns, values = ([np.concatenate(x) for x in zip(*part, strict=True)] for part in zip(*found, strict=True))
    ids, columns = _placed(columns)
    return ids, *_summed(columns, values)


def _keys(hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of n-grams."""
    keys = hashes[columns[0]]
    for c in columns[1:]:
        keys = mix(keys, hashes[c])
    return keys


def _split(hashes: np.ndarray, ids: np.ndarray, columns: list[np.ndarray], values: list[np.ndarray],
           shards: int) -> Iterator[tuple[int, bytes]]:
    """(shard, packet) of the n-grams, by their hash; ``columns`` are places in ``hashes`` and ``ids``."""
    for s, part in _by_shard(_shard(_keys(hashes, columns), shards), shards):
        yield s, _packed([ids[c[part]] for c in columns], [v[part] for v in values])


def _by_tokens(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[_Tokens, list[pa.RecordBatch]]]:
    """(tokens of some texts, their rows): some million tokens at a time."""
    tokens, rows = _Tokens(), []
    for b in batches:
        size = np.cumsum(pc.binary_length(b.column(column)).fill_null(0).to_numpy().astype(np.int64))
        start = 0
        while start < b.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + TEXT_AT_ONCE, "right")))
            rows.append(b.slice(start, end - start))
            tokens.add(rows[-1].column(column))
            start = end
            if tokens.n >= TOKENS_AT_ONCE:
                yield tokens, rows
                tokens, rows = _Tokens(), []
    if rows:
        yield tokens, rows


PACKETS = "shard int, packet binary"


def _packets(found: Iterable[tuple[int, bytes]]) -> pa.RecordBatch:
    numbers, packets = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packets, pa.binary())],
                                      names=["shard", "packet"])


def _find_words(shards: int):
    """Rows (shard, packet): different words, by their hash, and their counts."""
    def split(hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        bounds = np.searchsorted(_shard(hashes, shards), np.arange(shards + 1))
        halves = np.divmod(hashes, np.uint64(1 << 32))  # a hash needn't be below 2 ** 63
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            part = slice(bounds[s], bounds[s + 1])
            yield s, _packed([x[part] for x in halves], [counts[part]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in _by_tokens(batches):
            yield _packets(split(*tokens.counts()))
    return run


def _number_words(folder: str):
    """Stores a shard's words: sorted hashes, the number of each by falling count, the place of each number."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = [_unpacked(p) for p in rows["packet"]]
        hashes, place = np.unique(np.concatenate([(c[0].astype(np.uint64) << np.uint64(32)) | c[1].astype(np.uint64)
                                                  for c, _ in found]), return_inverse=True)
        counts, n = np.zeros(len(hashes), np.int64), int(key[0])
        np.add.at(counts, place, np.concatenate([v[0] for _, v in found]))
        by_count = np.argsort(-counts, kind="stable")
        number = np.empty_like(by_count)
        number[by_count] = np.arange(len(by_count))
        files = [_save(folder, f"words-{n}-keys", hashes), _save(folder, f"words-{n}-numbers", _small(number)),
                 _save(folder, f"words-{n}-places", _small(by_count))]
        return pd.DataFrame([(n, files)], columns=["shard", "files"])
    return run


class Numbers:
    """Numbers of all training words, from the arrays of their shards: frequent words have small ones."""

    def __init__(self, files: dict[int, list[str]], shards: int):
        self.files, self.shards = files, shards

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes."""
        out = np.empty(len(hashes), np.int64)
        for s, at in _by_shard(_shard(hashes, self.shards), self.shards):
            keys, numbers, _ = map(_open, self.files[s])
            place = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
            if (keys[place] != hashes[at]).any():
                raise RuntimeError("a text has a word that it didn't have when the words were numbered")
            out[at] = numbers[place].astype(np.int64) * self.shards + s
        return out

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        """Hashes of the words with these numbers."""
        out = np.empty(len(ids), np.uint64)
        number, shard = np.divmod(ids, self.shards)
        for s, at in _by_shard(shard, self.shards):
            keys, _, places = map(_open, self.files[s])
            out[at] = keys[places[number[at]]]
        return out


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, the places where it stands)."""
    shard = shard.astype(np.min_scalar_type(shards))  # small ones are sorted by radix
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(bounds)).tolist():
        yield s, order[bounds[s]:bounds[s + 1]]


def _count(shards: int, order: int, numbers: Numbers | None = None):
    """Rows (shard, packet): n-grams and their counts, by the n-gram's hash; without ``numbers``, words have places."""
    def split(tokens: _Tokens) -> Iterator[tuple[int, bytes]]:
        hashes = np.array(tokens.words.hashes, np.uint64)
        ids = numbers.of(hashes) if numbers else hashes
        by_id = np.argsort(ids)
        place = np.empty_like(by_id)
        place[by_id] = np.arange(len(by_id))
        columns, ids = tokens.columns(place, order), ids[by_id] if numbers else np.arange(len(by_id))
        if len(ids) ** order < 1 << 62:
            code, counts = np.unique(_codes(columns, len(ids)), return_counts=True)
            columns = []
            for _ in range(order):
                code, c = np.divmod(code, len(ids))
                columns.insert(0, c)
            found = columns, [counts]
        else:
            found = _summed(columns, [np.ones(tokens.n, np.int64)])
        return _split(hashes[by_id], ids, *found, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in _by_tokens(batches):
            yield _packets(split(tokens))
    return run


def _save(folder: str, name: str, array: np.ndarray) -> str:
    """Writes an array under a name of this attempt's own; returns its address."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}.npy"
    with store.open_output_stream(f"{root.rstrip('/')}/{name}", compression=None) as out:
        header = io.BytesIO()
        np.lib.format.write_array_header_1_0(header, np.lib.format.header_data_from_array_1_0(array))
        out.write(header.getvalue())
        out.write(np.ascontiguousarray(array).data.cast("B") if array.size else b"")
    return f"{folder.rstrip('/')}/{name}"


@lru_cache(maxsize=4096)
def _open(address: str) -> np.ndarray:
    """A stored array: memory-mapped where the shared folder is a mounted one, else read whole."""
    parsed = urlparse(address)
    if parsed.scheme in ("", "file"):
        return np.load(parsed.path, mmap_mode="r")
    store, place = fs.FileSystem.from_uri(address)
    with store.open_input_stream(place, compression=None) as f:
        return np.load(io.BytesIO(f.read()))


def _histogram(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def _read(address: str) -> bytes:
    """A stored array's bytes; not kept, so that its space is free when it is deleted."""
    store, place = fs.FileSystem.from_uri(address)
    with store.open_input_stream(place, compression=None) as f:
        return np.load(io.BytesIO(f.read())).tobytes()


LEVEL_ROW = "shard int, grams string, h array<long>, n array<long>"
GRAMS = "shard int, grams string"


def _counts(start: np.ndarray, columns: list[np.ndarray], values: list[np.ndarray], length: int,
            order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(occurrences, counts, which are n-grams) of some n-grams; ``start``: whether a place of the columns is START."""
    if length == order:
        raw = count = values[0]
    else:
        left, raw = values[:2]
        count = np.where(start[columns[0]], raw, left) if length > 1 else left
    # more than one START: no n-gram, only the way to the shorter one
    return raw, count, ~start[columns[1]] if length > 1 else np.ones(len(raw), bool)


def _merge(folder: str, length: int, order: int, numbers: Numbers):
    """Merges a shard's packets of n-grams of one length and stores them packed, their words by number."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ids, columns, values = _merged(rows["packet"])
        start = ids == numbers.of(np.array([START], np.uint64))
        raw, count, whole = _counts(start, columns, values, length, order)
        totals = [int((raw > 0).sum()), int(raw.sum()), int(count.sum())]
        grams = np.frombuffer(_packed([ids[c] for c in columns], values), np.uint8)
        out = [(int(key[0]), _save(f"{folder}/grams-{length}", f"{key[0]}", grams), _histogram(count[whole]), totals)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in LEVEL_ROW.split(", ")])
    return run


def _stored(address: str, numbers: Numbers) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(hashes of the words, their numbers, n-grams by places among them, values) that :func:`_merge` stored."""
    columns, values = _unpacked(_read(address))
    ids, columns = _placed(columns)
    return numbers.hashes(ids), ids, columns, values


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
    for b in batches:
        for r in b.to_pylist():
            yield r["shard"], r["grams"]


def _below(length: int, order: int, shards: int, numbers: Numbers):
    """Rows (shard, packet) for the length below: the n-grams without their first word and without their last.

    Their values: how many different words come before, occurrences; as contexts, the
    total and the numbers of n-grams counted once, twice and more often.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, address in _rows(batches):
            hashes, ids, columns, values = _stored(address, numbers)
            raw, count, whole = _counts(hashes == np.uint64(START), columns, values, length, order)
            zero, seen = np.zeros(len(raw), np.uint8), count[whole]
            last = [zero + np.uint8(1), raw, zero, zero, zero, zero]
            context = [zero[whole], zero[whole], seen, *[x.astype(np.uint8) for x in (seen == 1, seen == 2, seen > 2)]]
            shorter = [np.concatenate((c, d[whole])) for c, d in zip(columns[1:], columns[:-1], strict=True)]
            below = _summed(shorter, [np.concatenate(x) for x in zip(last, context, strict=True)])
            yield _packets(_split(hashes, ids, *below, shards))
    return run


def _store(folder: str, length: int, order: int, numbers: Numbers):
    """Rows (shard, files): the arrays of a shard's n-grams, sorted hashes, numbers of their values, and different values.

    The values are the count and, below the highest order, as contexts, the
    total and the numbers of n-grams counted once, twice and more often; for
    words also how often they occur.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, address in _rows(batches):
            hashes, _, columns, values = _stored(address, numbers)
            raw, count, whole = _counts(hashes == np.uint64(START), columns, values, length, order)
            keys = _keys(hashes, columns)
            by_key = np.argsort(keys)
            by_key = by_key[whole[by_key]]
            kept = [v[by_key] for v in (count, *values[2:], *([raw] if length == 1 else []))]
            _, first, number = _different(_codes(kept))
            # words are those numbered
            files = [numbers.files[n][0] if length == 1 else _save(folder, f"{length}-{n}-keys", keys[by_key]),
                     _save(folder, f"{length}-{n}-numbers", _small(number)),
                     _save(folder, f"{length}-{n}-values", _small(np.stack([v[first] for v in kept])))]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([files], pa.list_(pa.string()))],
                                             names=["shard", "files"])
    return run


def discounts(n: list[int]) -> list[float]:
    """[0, D1, D2, D3+] from the numbers of counts 1 to 4; each within 0 and its count."""
    ratio = lambda a, b: a / b if b else 0.0
    y = ratio(n[0], n[0] + 2 * n[1])
    return [0.0, *[min(max(k - (k + 1) * y * ratio(n[k], n[k - 1]), 0.0), float(k)) for k in (1, 2, 3)]]


class Model:
    """Where the arrays are, per length of n-grams and shard, and the totals; small, whatever the corpus."""

    def __init__(self, levels: list[dict[int, list[str]]], shards: int, cuts: list[list[float]],
                 n_words: int, n_tokens: int, n_pairs: int, spread: float):
        self.levels, self.shards, self.order = levels, shards, len(levels)
        self.cuts = [np.array(c) for c in cuts]
        self.n_words, self.n_tokens, self.n_pairs, self.spread = n_words, n_tokens, n_pairs, spread

    def find(self, length: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(different values, count and so on in rows, see :func:`_store`; for each of the n-grams ``keys`` the number of its own).

        Number 0 are n-grams that aren't stored, all of whose values are 0.
        """
        order = np.argsort(keys)
        keys = keys[order]
        bounds = np.searchsorted(_shard(keys, self.shards), np.arange(self.shards + 1))
        rows = 1 if length == self.order else 6 if length == 1 else 5
        values, size, found = [np.zeros((rows, 1), np.int64)], 1, np.zeros(len(keys), np.int64)
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            files, part = self.levels[length - 1].get(s), slice(bounds[s], bounds[s + 1])
            stored, numbers, own = map(_open, files) if files else ((), (), ())
            if len(stored):
                at = np.minimum(np.searchsorted(stored, keys[part]), len(stored) - 1)
                found[part] = np.where(stored[at] == keys[part], size + numbers[at].astype(np.int64), 0)
                values.append(own)
                size += own.shape[1]
        out = np.empty_like(found)
        out[order] = found
        return np.concatenate(values, axis=1), out

    def unigram(self, different: np.ndarray) -> np.ndarray:
        """P(word) by the numbers of different words before, mixed with the uniform one over V + 1 words."""
        uniform = 1.0 / (self.n_words + 1)
        if not self.n_pairs:
            return np.full(len(different), uniform)
        kept = np.maximum(different - self.cuts[0][np.minimum(different, 3)], 0)
        return (kept + self.spread * uniform) / self.n_pairs

    def higher(self, length: int, count: np.ndarray, stats: np.ndarray, context: np.ndarray,
               lower: np.ndarray) -> np.ndarray:
        """P(word | context) from the n-gram's count, stats and the number of its context's, and P(word | shorter context)."""
        cuts = self.cuts[length - 1]
        total, spread = stats[0][context], (cuts[1:] @ stats[1:])[context]
        kept = np.maximum(count - cuts[np.minimum(count, 3)], 0)
        return np.where(total > 0, (kept + spread * lower) / np.maximum(total, 1), lower)

    def base(self, raw: np.ndarray) -> np.ndarray:
        """Additively smoothed unigram probability."""
        return (raw + ADDED) / (self.n_tokens + ADDED * (self.n_words + 1))

    def score(self, tokens: _Tokens) -> tuple[list[int], list[int], list[float], list[float]]:
        """Per text: tokens, known tokens, base score, model's score."""
        hashes, grams, own = tokens.ngrams(self.order)
        values, number = self.find(1, hashes)
        raw = values[5][number]
        p = self.unigram(values[0][number])
        for length, g in enumerate(grams, 2):
            stats, context = values[1:5], np.append(number, 0)[g.context]  # 0: nothing for the context of START alone
            values, number = self.find(length, g.keys)
            p = self.higher(length, values[0][number], stats, context, p[g.suffix])
        starts = np.concatenate(([0], np.cumsum(tokens.lengths)[:-1]))
        return (tokens.lengths, np.add.reduceat((raw > 0)[own].astype(np.int64), starts).tolist(),
                np.add.reduceat(np.log10(self.base(raw))[own], starts).tolist(),
                np.add.reduceat(np.log10(p)[grams[-1].place], starts).tolist())


def train(docs: DataFrame, folder: str, text: str = "text", shards: int | None = None, order: int = 2) -> Model:
    """A model of whole texts, its arrays stored in ``folder``, which all executors must see.

    ``order`` is the length of the longest n-grams.  ``shards`` grows with the
    bytes of text unless given (a read of its own) and is at least the number
    of shuffle partitions.  A shard is dealt n-grams by their hash, frequent
    words' like others, so no task merges more than its share of the tokens.
    The driver gets a row of addresses and totals per order and shard.  A null
    text is an empty one (its end alone is learned).  Without documents, words
    are equally likely.
    """
    if order < 2:
        raise ValueError("order must be 2 at least")
    if not shards:
        size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("long"))).first()[0] or 0
        shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    spark, texts = docs.sparkSession, docs.select(F.col(text).cast("string").alias("_t"))
    numbers = Numbers({r.shard: r.files for r in _collected(spark, texts.mapInArrow(
        _find_words(shards), PACKETS).groupBy("shard").applyInPandas(_number_words(folder), FILES))}, shards)
    grams, cuts = [], []
    for length in range(order, 0, -1):
        packets = texts.mapInArrow(_count(shards, order, numbers), PACKETS) if length == order else (
            _one_a_task(spark, grams[0]).mapInArrow(_below(length + 1, order, shards, numbers), PACKETS))
        rows = _collected(spark, packets.groupBy("shard").applyInPandas(_merge(folder, length, order, numbers), LEVEL_ROW))
        h = [sum(r.h[k] for r in rows) for k in range(4)]
        grams.insert(0, [(r.shard, r.grams) for r in rows])
        cuts.insert(0, discounts(h))
    n_words, n_tokens, n_pairs = (sum(r.n[k] for r in rows) for k in range(3))
    d, more = cuts[0], n_words - h[0] - h[1]
    levels = []
    for length in range(1, order + 1):
        files = _one_a_task(spark, grams[length - 1]).mapInArrow(_store(folder, length, order, numbers), FILES).collect()
        levels.append({r.shard: r.files for r in files})
        _delete(f"{folder}/grams-{length}")
    return Model(levels, shards, cuts, n_words, n_tokens, n_pairs, d[1] * h[0] + d[2] * h[1] + d[3] * more)


FILES = "shard int, files array<string>"


def _collected(spark: SparkSession, frame: DataFrame) -> list:
    """The few rows of a frame, whose shuffle files then go."""
    rows = frame.collect()
    del frame
    forget_shuffles(spark)
    return rows


def _one_a_task(spark: SparkSession, grams: list[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(spark.sparkContext.parallelize(grams, max(len(grams), 1)), GRAMS)


def _delete(folder: str) -> None:
    store, place = fs.FileSystem.from_uri(folder)
    if store.get_file_info(place).type == fs.FileType.Directory:
        store.delete_dir(place)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_tokens, n_known, base_score, score (log10 probability of the whole text).

    A null or empty text is its end alone.  Repeated rows and null keys are
    scored each on its own; an empty table gives an empty result; other
    columns are ignored.
    """
    names = [key, "n_tokens", "n_known", "base_score", "score"]
    kinds = docs.select(F.col(key).alias(key), *[F.lit(0).cast("long").alias(c) for c in names[1:3]],
                        *[F.lit(0.0).alias(c) for c in names[3:]]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, rows in _by_tokens(batches, 1):
            n, known, base, own = model.score(tokens)
            keys = pa.chunked_array([b.column(0) for b in rows]).combine_chunks()
            yield pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                                              pa.array(base, pa.float64()), pa.array(own, pa.float64())], names=names)

    return docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("_t")).mapInArrow(run, kinds)
