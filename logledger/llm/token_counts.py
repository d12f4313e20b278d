"""Token counts by a finite-state transducer compiled from a BPE tokenizer file.

Within one split piece of a text, the tokens of a prefix end in one token, and
that token is the only one whose left neighbour (the last token of the prefix
before it) would not merge with it.  The state after a prefix is therefore
finite: its longest end that begins some token, and for each place in that end
the last token there and the count of tokens relative to now.  States and
transitions are made when a text first needs them; each transition carries the
number of tokens that it adds.

The end of a split piece returns the machine to its start, and most ends can
be told from the two characters beside them: white space, digits, and the end
of a run of letters.  A chunk of a long text maps the state before it to the
state after it and a count; between its first and its last such end the count
doesn't depend on that state, so the map is held as the count between and the
text outside, its open ends.  Maps of adjacent chunks compose associatively;
Spark combines them some at a time, in rounds, as a tree.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
TOGETHER = 16  # neighbouring maps that one round combines
LIMIT = 2048
MEMO, MEMO_LENGTH, STATES = 200_000, 64, 400_000

# What the file's normalizer and split must be for the machine to apply.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
UNICODE_SPLIT = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}"))
# A piece ends between two characters, whatever stands further off.
ENDS = r"(?<=[\p{White_Space}\p{N}])|(?=[\p{White_Space}\p{N}])|(?<=\p{L})(?!\p{L})"
FIRST_END, LAST_END = regex.compile(ENDS), regex.compile("(?r)" + ENDS)


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Transducer:
    """Counts of tokens of single split pieces, by transitions over bytes; the last byte of a piece is marked."""

    def __init__(self, merges: list[list[str]], vocab: dict[str, int], suffix: str):
        self.suffix = suffix
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.tokens = set(vocab)
        plain = [t.removesuffix(suffix) for t in vocab]
        self.begins = {t[:i] for t in plain for i in range(len(t) + 1)}
        self.chars = byte_chars()
        self.apart: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        # a state: (end of the prefix that begins a token, ((last token, relative count) at each place in it))
        start = ("", ((None, 0),))
        self.number, self.states, self.next = {start: 0}, [start], {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE of a few symbols, lowest rank first."""
        while len(symbols) > 1:
            rank, i = min((self.rank.get(p, len(self.rank)), i)
                          for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == len(self.rank):
                break
            pair = (symbols[i], symbols[i + 1])
            out, k = [], 0
            while k < len(symbols):
                if tuple(symbols[k:k + 2]) == pair:
                    out.append("".join(pair))
                    k += 2
                else:
                    out.append(symbols[k])
                    k += 1
            symbols = out
        return symbols

    def stays_apart(self, left: str | None, right: str) -> bool:
        """Whether ``left`` and ``right`` are the tokens of their own joint text."""
        if left is None:
            symbols = self._symbols(right)
            return self.merged(symbols) == [right]
        known = self.apart.get((left, right))
        if known is None:
            if len(self.apart) > MEMO:
                self.apart.clear()
            known = self.apart[left, right] = self.merged([*left, *self._symbols(right)]) == [left, right]
        return known

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and token != self.suffix:
            body = token.removesuffix(self.suffix)
            return [*body[:-1], body[-1] + self.suffix]
        return [*token]

    def step(self, state: int, byte: int, last: bool) -> tuple[int, int]:
        """The next state and the tokens added; after a piece's last byte the state is the start."""
        end, places = self.states[state]
        grown, mark = end + self.chars[byte], self.suffix if last else ""
        for i in range(len(grown)):  # longest candidate first
            token = grown[i:] + mark
            if token in self.tokens and self.stays_apart(places[i][0], token):
                count = places[i][1] + 1
                break
        else:
            raise ValueError(f"no token ends {grown!r}; the vocabulary lacks a byte")
        if last:
            return 0, count
        places = (*((t, c - count) for t, c in places), (token, 0))
        at = next(i for i in range(len(grown) + 1) if grown[i:] in self.begins)
        made = (grown[at:], places[at:])
        if made not in self.number:
            self.number[made] = len(self.states)
            self.states.append(made)
        return self.number[made], count

    def count(self, piece: str) -> int:
        data, state, n, known = piece.encode("utf-8", "surrogatepass"), 0, 0, self.next
        if len(self.states) > STATES:
            self.reset()
            known = self.next
        last = len(data) - 1
        for i, byte in enumerate(data):
            key = (state << 9) | byte | (256 if i == last else 0)
            move = known.get(key)
            if move is None:
                move = known[key] = self.step(state, byte, i == last)
            state = move[0]
            n += move[1]
        return n


class _Memo(dict):
    """Counts of short pieces, MEMO at most."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Token counts of texts and of their chunks, from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        if (spec["normalizer"].get("normalizers") != NORMALIZERS or pre[0]["pattern"] != {"Regex": SPLIT}
                or pre[1]["type"] != "ByteLevel" or model["type"] != "BPE" or not model["end_of_word_suffix"]):
            raise ValueError(f"{path}: not a tokenizer of the kind that the machine is compiled for")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.transducer = Transducer(merges, model["vocab"], model["end_of_word_suffix"])
        self.memo = _Memo(self.transducer.count)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]))
        self.margin = max((len(t["content"]) for t in spec["added_tokens"]), default=0)

    def count(self, text: str) -> int:
        """Tokens of a text; the strings of special tokens are those tokens."""
        if self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.count, parts))
        if text.isascii():
            return sum(map(self.memo.__getitem__, ASCII_SPLIT.findall(text.lower())))
        # lower case by single characters: a capital sigma has one small form
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(map(self.memo.__getitem__, UNICODE_SPLIT.findall(text)))

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(open beginning, tokens between, open end); the end is None if the chunk has no certain end of a piece.

        An end isn't certain next to a character whose small form is several
        (its class may change), nor inside or near what may be a special token.
        """
        special = [(m.start(), m.end()) for m in self.special.finditer(chunk)]

        def certain(i: int) -> bool:
            return (len(chunk[i - 1].lower()) == len(chunk[i].lower()) == 1
                    and not any(start < i < end for start, end in special))

        low, high = max(self.margin, 1), len(chunk) - max(self.margin, 1)
        ends = (m.start() for m in FIRST_END.finditer(chunk, low))
        first = next((i for i in ends if i > high or certain(i)), None)
        if first is None or first > high:
            return chunk, 0, None
        ends = (m.start() for m in LAST_END.finditer(chunk, 0, len(chunk)))
        last = next(i for i in ends if i <= high and certain(i))
        return chunk[:first], self.count(chunk[first:last]), chunk[last:]

    def compose(self, maps: list[tuple[str, int, str | None]]) -> tuple[str, int, str | None]:
        """The map of adjacent chunks together, combined in a tree."""
        while len(maps) > 1:
            pairs = [self._two(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = pairs + maps[2 * len(pairs):]
        return maps[0]

    def _two(self, a: tuple, b: tuple) -> tuple[str, int, str | None]:
        (head, n, tail), (head2, m, tail2) = a, b
        if tail is None:
            return head + head2, m, tail2
        if tail2 is None:
            return head, n, tail + head2
        return head, n + self.count(tail + head2) + m, tail2

    def closed(self, whole: tuple[str, int, str | None]) -> int:
        head, n, tail = whole
        return self.count(head) + n + (self.count(tail) if tail else 0)


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT,
                 chunk: int = CHUNK) -> DataFrame:
    """One row per document: key, n_bytes, n_tokens, over_limit (n_tokens > limit).

    A null or empty text has no bytes and no tokens.  Repeated rows and null
    keys are counted each on its own; an empty table gives an empty result;
    other columns are ignored.  Texts longer than ``chunk`` characters are
    dealt out by chunks, so one long text is counted by many tasks, with or
    without white space; only a run of one class, letters or signs, that fills
    whole chunks is passed on and counted where it ends.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    d = docs.select(F.col(key).alias(key), F.octet_length(t).cast("long").alias("n_bytes"), t.alias("_t"))
    short, long = d.filter(F.length("_t") <= chunk), d.filter(F.length("_t") > chunk)
    kinds = d.select(key, "n_bytes", F.lit(0).cast("long").alias("n_tokens")).schema

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for b in batches:
            n = pa.array([count(x.as_py()) for x in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:2], n], names=[key, "n_bytes", "n_tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for place, x in enumerate(b.column(3)):
                x, row = x.as_py(), b.slice(place, 1)
                # composed before cutting: a cut may part a character from its accent
                x = x if x.isascii() else unicodedata.normalize("NFC", x)
                for i in range(0, len(x), chunk):
                    yield pa.RecordBatch.from_arrays(
                        [*row.columns[:3], pa.array([i // chunk], pa.int32()), pa.array([x[i:i + chunk]])],
                        names=["_row", key, "n_bytes", "_no", "_chunk"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer)
        for b in batches:
            heads, counts, tails = zip(*[machine.chunk_map(x.as_py()) for x in b.column(4)], strict=True)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(heads, pa.string()), pa.array(counts, pa.int64()), pa.array(tails, pa.string())],
                names=["_row", key, "n_bytes", "_no", "head", "n", "tail"])

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_no")
        maps = [(h, int(n), None if t is None else t) for h, n, t in zip(rows["head"], rows["n"], rows["tail"], strict=True)]
        head, n, tail = counter(tokenizer).compose(maps)
        return rows.iloc[:1].assign(_no=rows["_no"].iloc[0] // TOGETHER, head=head, n=n, tail=tail)

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer)
        for b in batches:
            n = [machine.closed(m) for m in zip(*(b.column(c).to_pylist() for c in ("head", "n", "tail")), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:3], pa.array(n, pa.int64())], names=[key, "n_bytes", "n_tokens"])

    long = long.select(F.monotonically_increasing_id().alias("_row"), key, "n_bytes", "_t")
    placed = long.select("_row", key, "n_bytes", F.lit(0).alias("_no"), F.lit("").alias("_chunk"))
    chunks = long.mapInArrow(cut, placed.schema).repartition("_row", "_no")
    form = placed.select("_row", key, "n_bytes", "_no", F.lit("").alias("head"), F.lit(0).cast("long").alias("n"),
                         F.lit(None).cast("string").alias("tail")).schema
    maps = chunks.mapInArrow(mapped, form).checkpoint()
    most = maps.agg(F.max("_no")).first()[0] or 0
    while most:
        maps = maps.groupBy("_row", F.expr(f"_no div {TOGETHER}").alias("_part")).applyInPandas(joined, form)
        most //= TOGETHER
    counted = short.mapInArrow(whole, kinds).unionByName(maps.mapInArrow(closed, kinds))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
