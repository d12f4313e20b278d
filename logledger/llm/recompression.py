"""Removal of passages that occur anywhere else in the corpus, found by recompression.

A text is a sequence of word names.  Rounds replace runs of one name, and pairs
of neighbours, by new names: a pair joins if a bit of its left name is 0 and of
its right name 1.  A name is a hash of what it stands for, so all tasks of a
round give the same name to the same thing without a table of names.  What
happens inside a passage then depends on the passage alone, but for a name lost
at either end: the rest, its core, looks the same wherever the passage occurs.

The anchor of a window of words is a pair of symbols of its core after some
rounds.  Spark counts where each anchor's name occurs: a window whose anchor
occurs at one place is not repeated.  The other windows, those inside and next
to repeated passages, are named whole and counted in the same way, which
verifies them.  Either count returns the names with one place, so a passage
that occurs everywhere is only aggregated, never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.llm.common import GAP, words
from logledger.session import forget_shuffles, scratch_path

WINDOW = 35
RUNS_EVERY = 6       # a round of runs, then this many less one of pairs
CORE = 6             # symbols of the smallest core that an anchor is taken from
PIECE = 1 << 18      # words that one task names at once; longer texts are cut with an overlap
# a place is the second half of the text's key, the word's number and the round, packed into a long
WORD_SHIFT, KEY_SHIFT, KEY_BITS = 6, 38, 25


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _named(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    return _mix(_mix(a + np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD1342543DE82EF95) + b)


def word_names(text_words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, text_words), np.uint64, len(text_words))


def window_names(names: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The name of every window of ``width`` words, put together from windows of powers of two."""
    if len(names) < width:
        return names[:0]
    whole, done, power, size = None, 0, names, 1
    while True:
        if width & size:
            part = power[done:]
            n = len(names) - (done + size) + 1
            whole = part[:n] if whole is None else _named(whole[:n], part[:n], 2 * seed + 1)
            done += size
        if 2 * size > width:
            return whole
        power = _named(power[:-size], power[size:], 2 * seed)
        size *= 2


def anchors(names: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, anchor's name, anchor's first word, the round that named it) of every window inside one text.

    ``names`` holds the words of some texts one after another, ``text`` which.
    The anchor is two neighbouring symbols of the last core of ``CORE`` symbols or
    more, those with the smallest name together, so windows mostly share theirs
    with the next; smaller cores aren't followed.
    """
    n = len(names)
    first = np.flatnonzero(text[:n - width + 1] == text[width - 1:]) if n >= width else np.zeros(0, np.int64)
    found, place, level = np.zeros(len(first), np.uint64), np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    live, lo, hi = np.arange(len(first)), first, first + width - 1
    symbol, at, owner, born, k = names, np.arange(n), text, np.zeros(n, np.int64), 0
    while len(live):
        same = owner[1:] == owner[:-1]
        if k % RUNS_EVERY == 0:
            head = np.r_[True, ~(same & (symbol[1:] == symbol[:-1]))]
            starts = np.flatnonzero(head)
            count = np.diff(np.r_[starts, len(symbol)])
            joined = np.flatnonzero(count > 1)
            after = symbol[starts]
            after[joined] = _named(after[joined], count[joined].astype(np.uint64), 2 * k + 100)
            number = np.cumsum(head) - 1
            new_lo, new_hi = number[lo] + 1, number[hi] - 1  # runs at the ends may go on outside
        else:
            right = (_mix(symbol + np.uint64(k)) & np.uint64(1)).astype(bool)
            joins = same & ~right[:-1] & right[1:]
            head = np.r_[True, ~joins]
            starts = np.flatnonzero(head)
            after = symbol[starts]
            joined = np.flatnonzero(np.r_[joins, False][starts])
            after[joined] = _named(after[joined], symbol[starts[joined] + 1], 2 * k + 101)
            number = np.cumsum(head) - 1
            inner_lo, inner_hi = lo + right[lo], hi - ~right[hi]  # these may join what is outside
            new_lo, new_hi = number[np.minimum(inner_lo, n - 1)], number[inner_hi]
            new_hi = np.where(inner_lo > inner_hi, new_lo - 1, new_hi)
        over = new_hi - new_lo < CORE - 1
        if over.any():
            ended, low, high = live[over], lo[over], hi[over]
            two = np.append(_named(symbol[:-1], symbol[1:], 1), np.uint64(0))
            best = low.copy()
            for step in range(1, int((high - low).max())):
                other = np.minimum(low + step, np.maximum(high - 1, low))
                best = np.where(two[other] < two[best], other, best)
            single = low == high
            found[ended] = np.where(single, symbol[best], two[best])
            place[ended] = at[best]
            level[ended] = np.where(single, born[best], np.maximum(born[best], born[np.minimum(best + 1, len(born) - 1)]))
        live, lo, hi = live[~over], new_lo[~over], new_hi[~over]
        symbol, at, owner, born, n, k = after, at[starts], owner[starts], born[starts], len(starts), k + 1
        born[joined] = k
    return first, found, place, level


def _pieces(names: list[np.ndarray], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(names, piece, text, word number) of texts of at least ``width`` words, some ``PIECE`` words at a time."""
    parts, total = [], 0
    for i, x in enumerate(names):
        for start in range(0, len(x) - width + 1, PIECE):
            parts.append((i, start, x[start:start + PIECE + width - 1]))
            total += len(parts[-1][2])
            if total >= PIECE:
                yield _together(parts)
                parts, total = [], 0
    if parts:
        yield _together(parts)


def _together(parts: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(x) for _, _, x in parts]
    number = np.concatenate([np.arange(start, start + len(x)) for _, start, x in parts])
    return (np.concatenate([x for _, _, x in parts]), np.repeat(np.arange(len(parts)), sizes),
            np.repeat([i for i, _, _ in parts], sizes), number)


def _batches(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Batches with the words of their texts, some ``PIECE`` words at a time."""
    for b in batches:
        sizes = np.cumsum(np.asarray(pc.binary_length(b.column(text)).fill_null(0)))
        cuts = np.flatnonzero(np.diff(np.r_[0, sizes // (8 * PIECE)])).tolist()
        for start, end in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            if end > start:
                part = b.slice(start, end - start)
                # bytes.split() cuts at the six characters of the contract and no others
                yield part, [(t or b"").split() for t in part.column(text).cast(pa.binary()).to_pylist()]


def _ends(names: list[np.ndarray], places: list[np.ndarray]) -> np.ndarray:
    """Of each name its first and its last place, in the order given: all that tells whether it has one place."""
    order = np.lexsort([*places[::-1], *names[::-1]])
    differs = np.zeros(len(order) + 1, bool)
    differs[[0, -1]] = True
    for x in names:
        differs[1:-1] |= x[order[1:]] != x[order[:-1]]
    chosen = differs[:-1] | differs[1:]
    return np.sort(order[chosen])


def _name_anchors(width: int):
    """Rows (name, _k1, place) of the anchors of the texts' windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, split in _batches(batches):
            k1, k2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_k1", "_k2"))
            for x, piece, text, number in _pieces([word_names(w) for w in split], width):
                _, name, at, level = anchors(x, piece, width)
                new = np.r_[True, (level[1:] != level[:-1]) | (at[1:] != at[:-1])]
                name, at, level = name[new], at[new], level[new]
                i = text[at]
                place = k2[i] << KEY_SHIFT | number[at] << WORD_SHIFT | level
                ends = _ends([name], [k1[i], place])
                yield pa.RecordBatch.from_arrays([pa.array(name[ends].view(np.int64)), pa.array(k1[i[ends]]),
                                                  pa.array(place[ends])], names=["name", "_k1", "place"])
    return run


def _lists(b: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of the numbers, or pairs of numbers, in a column of lists."""
    lists = b.column(column)
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    values = lists.flatten()
    if pa.types.is_list(values.type):
        values = values.flatten()
        return np.repeat(np.arange(len(lists)), sizes), values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
    return np.repeat(np.arange(len(lists)), sizes), values.to_numpy(zero_copy_only=False).astype(np.int64)


def _spans(marked: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    return edges.reshape(-1, 2).tolist()


def _sha(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


TEXTS = "_k1 long, _k2 long, copies long, n_words long, kept_sha256 string, text string, starts array<array<int>>"
WINDOWS = "name long, more int, _t long, word int"


def _candidates(width: int):
    """The texts without the windows that have an anchor of one place; texts that keep none are done."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, split in _batches(batches):
            row, value = _lists(b, "places")
            alone = np.append(np.sort(row << KEY_SHIFT | value & (1 << KEY_SHIFT) - 1), np.int64(-1))
            starts: list[list[list[int]]] = [[] for _ in split]
            for x, piece, text, number in _pieces([word_names(w) for w in split], width):
                first, _, at, level = anchors(x, piece, width)
                anchor = text[at] << KEY_SHIFT | number[at] << WORD_SHIFT | level
                left = first[alone[np.searchsorted(alone[:-1], anchor)] != anchor]
                if len(left):
                    cuts = np.flatnonzero((np.diff(left) > 1) | (np.diff(piece[left]) > 0)) + 1
                    for a, z in zip(left[np.r_[0, cuts]].tolist(), left[np.r_[cuts - 1, len(left) - 1]].tolist(), strict=True):
                        starts[text[a]].append([int(number[a]), int(number[z]) + 1])
            copies = b.column("copies").to_pylist()
            gone = [n > 1 and len(w) >= width for n, w in zip(copies, split, strict=True)]
            sha = [_sha([] if g else w) if g or not s else None for g, w, s in zip(gone, split, starts, strict=True)]
            texts = b.column("text").take(pa.array([i if s else None for i, s in enumerate(starts)], pa.int64()))
            yield pa.RecordBatch.from_arrays([
                b.column("_k1"), b.column("_k2"), b.column("copies"), pa.array([len(w) for w in split], pa.int64()),
                pa.array(sha, pa.string()), texts, pa.array(starts, pa.list_(pa.list_(pa.int32())))],
                names=["_k1", "_k2", "copies", "n_words", "kept_sha256", "text", "starts"])
    return run


def _name_windows(width: int):
    """Rows (name, more of it, text's number, first word) of the texts' windows that are left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, split in _batches(batches):
            names = np.concatenate([word_names(w) for w in split])
            before = np.cumsum([0, *map(len, split[:-1])])
            row, span = _lists(b, "starts")
            first, end = span.T
            sizes = end - first
            word = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            row = np.repeat(row, sizes)
            at = before[row] + word
            # windows over the ends of texts are named too, and never looked at
            name, more = (window_names(names, width, seed)[at] for seed in (1, 2))
            more = more.astype(np.uint32)
            t = b.column("_t").to_numpy(zero_copy_only=False)[row]
            ends = _ends([name, more], [t, word])
            yield pa.RecordBatch.from_arrays([
                pa.array(name[ends].view(np.int64)), pa.array(more[ends].view(np.int32)), pa.array(t[ends]),
                pa.array(word[ends].astype(np.int32))], names=["name", "more", "_t", "word"])
    return run


def _cut(width: int):
    """(_t, n_removed, kept_sha256, removed) of texts, given the windows left that have one place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, split in _batches(batches):
            row, word = _lists(b, "places")
            by_row = np.searchsorted(row, np.arange(len(split) + 1))
            removed, n_removed, sha = [], [], []
            for i, (w, spans) in enumerate(zip(split, b.column("starts").to_pylist(), strict=True)):
                repeated = np.zeros(len(w) + 1, np.int64)
                for start, end in spans:
                    repeated[start:end] = 1
                repeated[word[by_row[i]:by_row[i + 1]]] = 0
                sums = np.r_[np.zeros(width, np.int64), np.cumsum(repeated)]
                covered = (sums[width:] - sums[:-width])[:len(w)] > 0  # a repeated window starts here or shortly before
                removed.append(_spans(covered))
                n_removed.append(int(covered.sum()))
                sha.append(_sha([x for x, c in zip(w, covered.tolist(), strict=True) if not c]))
            yield pa.RecordBatch.from_arrays([b.column("_t"), pa.array(n_removed, pa.int64()), pa.array(sha),
                                              pa.array(removed, pa.list_(pa.list_(pa.int32())))],
                                             names=["_t", "n_removed", "kept_sha256", "removed"])
    return run


def _alone(named: DataFrame, name: list[str], text: str, place: str) -> DataFrame:
    """(text, place) of the names that occur at one place only, however often that is listed.

    Tasks list a name's first and last place only, so their rows can go to the
    name's partition as they are: aggregating them once more would cost more
    bytes, as each row would hold its place twice.
    """
    ends = [F.min(text).alias("_text"), F.max(text).alias("_last_text"), F.min(place).alias("_place"),
            F.max(place).alias("_last_place")]
    return named.repartition("name").groupBy(*name).agg(*ends).filter("_text = _last_text and _place = _last_place").select("_text", "_place")


def _store(frame: DataFrame, path: str) -> DataFrame:
    """``frame`` as written to the shared folder; the shuffles that made it aren't needed any more."""
    spark = frame.sparkSession
    frame.write.option("compression", "zstd").parquet(path)
    del frame
    forget_shuffles(spark)
    return spark.read.parquet(path)


def find_repeats(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept_sha256, removed.

    A word is removed if a window of ``window`` consecutive words that covers
    it occurs anywhere else: in another row, or at another word of the same.
    ``removed`` lists the spans [first, end) of removed word numbers,
    ``kept_sha256`` is of the kept words with a space between them.

    Null, empty and blank texts have no words; a text shorter than the window
    keeps all.  Rows of equal texts are repeats of each other, whatever their
    keys, so every word of such a text is removed if it has a window.  Keys can
    be null or repeat; an empty table gives an empty result; other columns
    don't matter.

    Each different text is handled once, under a key of 89 hashed bits.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    k2 = F.shiftrightunsigned(F.xxhash64(F.lit(1), whole), 64 - KEY_BITS)
    keyed = docs.select(F.col(key).alias("_key"), whole.alias("text"), F.xxhash64(whole).alias("_k1"), k2.alias("_k2"))
    rows = keyed.select("text", "_k1", "_k2")

    # anchors with one place, by text, leave the rest of its windows
    names = rows.mapInArrow(_name_anchors(window), "name long, _k1 long, place long")
    alone = _alone(names, ["name"], "_k1", "place").groupBy(
        F.col("_text").alias("_u1"), F.shiftright("_place", KEY_SHIFT).alias("_u2")).agg(F.collect_list("_place").alias("places"))
    texts = rows.groupBy("_k1", "_k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = texts.join(alone, F.expr("_k1 = _u1 and _k2 = _u2"), "left").drop("_u1", "_u2")
    path = scratch_path(spark, "repeats")
    texts = _store(texts.mapInArrow(_candidates(window), TEXTS).withColumn("_t", F.monotonically_increasing_id()), f"{path}/texts")

    # of these windows, those with one place are not repeated either
    left = texts.filter("text is not null").select("_t", "text", "starts", "kept_sha256")
    names = left.drop("kept_sha256").mapInArrow(_name_windows(window), WINDOWS)
    alone = _alone(names, ["name", "more"], "_t", "word").groupBy(F.col("_text").alias("_u")).agg(
        F.collect_list("_place").alias("places"))
    cut = left.filter("kept_sha256 is null").drop("kept_sha256").join(alone, F.expr("_t = _u"), "left").drop("_u")
    cut = cut.mapInArrow(_cut(window), "_t long, n_removed long, kept_sha256 string, removed array<array<int>>")
    cut = cut.select(F.col("_t").alias("_c"), "n_removed", F.col("kept_sha256").alias("_sha"), "removed")
    facts = texts.select("_k1", "_k2", "_t", "copies", "n_words", "kept_sha256").join(cut, F.expr("_t = _c"), "left")
    all_gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    facts = facts.select(
        F.col("_k1").alias("_f1"), F.col("_k2").alias("_f2"), "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
        F.when(all_gone, F.array(F.array(F.lit(0), F.col("n_words").cast("int")))).otherwise(
            F.coalesce("removed", F.array().cast("array<array<int>>"))).alias("removed"))
    # written, so that the join to the rows stands alone and Spark can split a text with very many rows
    facts = _store(facts, f"{path}/facts")
    found = keyed.select("_key", "_k1", "_k2").join(facts, F.expr("_k1 = _f1 and _k2 = _f2"))
    return found.select(F.col("_key").alias(key), "n_words", "n_removed", "kept_sha256", "removed")


def kept_text(text: Column, removed: Column) -> Column:
    """The words of ``text`` outside the spans, with a space between them; empty for null."""
    return F.array_join(F.filter(words(text), lambda w, i: ~F.exists(removed, lambda s: (s[0] <= i) & (i < s[1]))), " ")


def oracle(docs: str = "documents", window: int = WINDOW) -> str:
    """DuckDB SQL of the counts and digests of :func:`find_repeats`."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'),
    lambda w: w <> '') AS w FROM {docs}),
v AS (SELECT uid, unnest(range(1, len(w) - {window - 2})) AS i, w FROM d WHERE len(w) >= {window}),
h AS (SELECT uid, i, sha256(array_to_string(w[i:i + {window - 1}], ' ')) AS h FROM v),
r AS (SELECT uid, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT uid, i + o AS i FROM r, range({window}) o(o)),
x AS (SELECT uid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT uid, string_agg(x, ' ' ORDER BY i) AS kept FROM x ANTI JOIN c USING (uid, i) GROUP BY uid),
n AS (SELECT uid, count(*) AS n FROM c GROUP BY uid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (uid) LEFT JOIN k USING (uid)"""
