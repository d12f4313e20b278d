"""SimHash near-duplicates, linked through shards of BK-trees.

Fingerprints are cut into ``RADIUS + AGREE`` blocks of bits.  Two fingerprints
within the radius differ in at most RADIUS blocks, so they agree on at least
AGREE whole blocks: every choice of AGREE blocks is a routing key, and linked
fingerprints meet under at least one of them.  All fingerprints under one key
form a shard.  Each shard's fingerprints build a BK-tree (children keyed by
their Hamming distance to the parent) and query it, following only the edges
within the radius.  A shard holds ``SHARD`` fingerprints at most: larger keys
are dealt into several shards, and every pair of them is searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.llm.components import connected_components

SHINGLE, RADIUS = 4, 4
BITS, SEED = 64, 42
AGREE = 2
SHARD = 4096
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - shingle + 1, 1)
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    last = ends[min(shingle, len(words)) - 1:]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, ROWS_AT_ONCE):
        spans = zip(starts[i:i + ROWS_AT_ONCE].tolist(), last[i:i + ROWS_AT_ONCE].tolist())
        h = np.array([digest(view[a:b], SEED) for a, b in spans], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def add_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without the text, plus ``fingerprint`` (signed long).  Whole texts; only the text goes to Python."""
    kept = [c for c in docs.columns if c.lower() not in (text.lower(), "fingerprint")]
    kinds = docs.select(*kept, F.lit(0).cast("long").alias("fingerprint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = pa.array([fingerprint(t, shingle) for t in b.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], prints], names=[*kept, "fingerprint"])

    return docs.select(F.col(text).cast("string"), *kept).mapInArrow(run, kinds)


class BKTree:
    """A BK-tree over distinct uint64 fingerprints; many queries go down it at once.

    ``children[node]`` is a dictionary from the Hamming distance to the node
    to the child that stands for all fingerprints at that distance.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.children: list[dict[int, int]] = [{} for _ in prints]
        pending = [(0, np.arange(1, len(prints)))] if len(prints) else []
        while pending:
            node, below = pending.pop()
            d = np.bitwise_count(prints[below] ^ prints[node])
            order = np.argsort(d, kind="stable")
            cuts = np.flatnonzero(np.diff(d[order])) + 1
            for part in np.split(below[order], cuts) if len(below) else ():
                first = int(part[0])
                self.children[node][int(np.bitwise_count(prints[first] ^ prints[node]))] = first
                if len(part) > 1:
                    pending.append((first, part[1:]))

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each node that is reached: the node and the places of the queries within the radius of it."""
        pending = [(0, np.arange(len(queries)))] if len(self.prints) else []
        while pending:
            node, asking = pending.pop()
            d = np.bitwise_count(queries[asking] ^ self.prints[node]).astype(np.int64)
            if (near := asking[d <= radius]).size:
                yield node, near
            for edge, child in self.children[node].items():
                if (down := asking[np.abs(d - edge) <= radius]).size:
                    pending.append((child, down))


def _forest(prints: np.ndarray, links: Iterator[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of the links between places of ``prints``, at most one edge less than places."""
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for a, near in links:
        for b in near.tolist():
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((a, b))
    return edges


def search(one: list[int], other: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what links connect, in one shard or between two."""
    tree = np.array(one, np.int64).view(np.uint64)
    if other is None:
        prints = tree
        if len(tree) == 2:
            return [(one[0], one[1])] if int(np.bitwise_count(tree[0] ^ tree[1])) <= radius else []
        links = BKTree(tree).within(tree, radius)
    else:
        asking = np.array(other, np.int64).view(np.uint64)
        prints = np.concatenate([tree, asking])
        links = ((node, near + len(tree)) for node, near in BKTree(tree).within(asking, radius))
    signed = prints.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in _forest(prints, links)]


def _routes(prints: DataFrame, radius: int, agree: int) -> DataFrame:
    """A row (route, value, fingerprint) for every choice of ``agree`` of the ``radius + agree`` blocks."""
    n = radius + agree
    bounds = [BITS * i // n for i in range(n + 1)]
    masks = []
    for chosen in combinations(range(n), agree):
        mask = sum(((1 << (bounds[b + 1] - bounds[b])) - 1) << bounds[b] for b in chosen)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    routes = F.array(*[F.struct(F.lit(i).alias("route"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("value"))
                       for i, m in enumerate(masks)])
    return prints.select("fingerprint", F.explode(routes).alias("r")).select("r.route", "r.value", "fingerprint")


def links(prints: DataFrame, radius: int = RADIUS, agree: int = AGREE, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``fingerprint`` within ``radius`` bits.

    ``prints`` holds distinct fingerprints.  A shard emits a spanning forest
    of its links instead of all pairs.
    """
    routed = _routes(prints, radius, agree)
    sizes = (routed.groupBy("route", "value").agg(F.count("*").alias("n")).filter(F.col("n") > shard)
             .select("route", "value", F.ceil(F.col("n") / shard).cast("int").alias("parts")))
    dealt = (routed.join(sizes, ["route", "value"], "left")
             .withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.coalesce("parts", F.lit(1))).cast("int")))
    shards = (dealt.groupBy("route", "value", "part")
              .agg(F.array_sort(F.collect_list("fingerprint")).alias("one"), F.first("parts").alias("parts")))
    inside = shards.filter(F.size("one") > 1).select("one", F.lit(None).cast("array<long>").alias("other"))
    split = shards.filter("parts is not null").select("route", "value", "part", "one")
    pairs = (split.alias("x").join(split.alias("y"), F.expr(
        "x.route = y.route and x.value = y.value and x.part < y.part"))
        .select(F.col("x.one").alias("one"), F.col("y.one").alias("other")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [e for one, other in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                     for e in search(one, other, radius)]
            if found:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(found, columns=["a", "b"], dtype="int64"),
                                                 preserve_index=False)

    return inside.unionByName(pairs).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """``docs`` without the text, plus ``fingerprint`` (signed long), ``component_id`` and ``root``.

    ``component_id`` is the smallest ``key`` among the rows whose fingerprints
    can be reached by links of ``radius`` bits or fewer.  Null, empty and
    blank texts have fingerprint zero and link like any other.  Rows without a
    key count for no smallest key; a component without any key has a null id.
    ``root``, a fingerprint, tells components apart even so.
    Repeated rows stay.  An empty table gives an empty result.  Input columns
    named like an output are replaced.
    """
    docs = docs.drop("component_id", "root", "_least")
    printed = add_fingerprints(docs, text, shingle).checkpoint()
    prints = printed.groupBy("fingerprint").agg(F.min(key).alias("_least")).checkpoint()
    found = connected_components(links(prints.select("fingerprint"), radius))
    rooted = (prints.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
              .select("fingerprint", "_least", F.coalesce("component", "fingerprint").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(ids, "root").select("fingerprint", "component_id", "root")
    return printed.join(named, "fingerprint")
