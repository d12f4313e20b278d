"""Exact near-duplicate join of vectors by pivots.

Unit vectors within a cosine lie within a Euclidean distance r of each other.
Pivots partition the vectors of a group (same label, same length): each vector
belongs to the cell of its nearest pivot.  A vector that lies within r of the
boundary to another cell, by its distances to the two pivots and theirs to
each other, is copied there, so each cell can find all partners of its own
vectors alone.  Cells are cut into blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.llm.components import connected_components

COSINE = 0.93
CELL, PIVOTS = 2048, 64
BLOCK, TILE = 16_384, 2048  # vectors shipped together, and compared at once
SLACK, CLOSE = 1e-7, 1e-12
GROUP = ["_label", "_dim"]


def unit_vectors(vectors: DataFrame, key: str, embedding: str, label: str) -> DataFrame:
    """(_id, _label, _dim, _unit): the vector scaled to length one as packed doubles; null if it links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units: list[bytes | None] = []
            for v, lab in zip(b.column(2).to_pylist(), b.column(1), strict=True):
                x = None if v is None or not lab.is_valid or any(c is None for c in v) else np.array(v, np.float64)
                if x is None or not x.size or not np.isfinite(x).all() or not x.any():
                    units.append(None)
                    continue
                x = x / np.abs(x).max()
                units.append((x / np.sqrt((x * x).sum()) + 0.0).tobytes())
            dims = [0 if u is None else len(u) // 8 for u in units]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dims, pa.int32()),
                                              pa.array(units, pa.binary())], names=["_id", *GROUP, "_unit"])

    d = vectors.select(F.col(key).cast("long").alias("_id"), F.col(label).cast("string").alias("_label"),
                       F.col(embedding).cast("array<double>").alias("_v"))
    return d.mapInArrow(run, "_id long, _label string, _dim int, _unit binary")


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _assign(radius: float):
    """Cells of a block of vectors: its own (home) and those behind a boundary within ``radius``."""
    def run(block: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return pd.DataFrame({"_label": [], "_dim": [], "cell": [], "home": [], "cid": [], "copies": [], "_unit": []})
        p = _matrix(pivots["_unit"])
        squares = 2 - 2 * (_matrix(block["_unit"]) @ p.T)  # squared distances to the pivots
        apart = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))
        home = squares.argmin(axis=1)
        nearest = squares[np.arange(len(block)), home]
        beyond = squares - nearest[:, None] <= 2 * apart[home] * (radius + SLACK) + SLACK
        beyond[np.arange(len(block)), home] = True
        row, cell = np.nonzero(beyond)
        out = block.iloc[row][["_label", "_dim", "cid", "copies", "_unit"]].reset_index(drop=True)
        return out.assign(cell=pivots["cid"].to_numpy()[cell], home=cell == home[row])
    return run


def _least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest place reachable from each of n places by the pairs (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        now = label.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = now[now]
        if (now == label).all():
            return label
        label = now


def _near(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of a and b reach the cosine.

    The last bits of a matrix product depend on its shape, so values next to the
    threshold are summed once more in one order, the same for (a, b) and (b, a).
    """
    product = a @ b.T
    near = product >= cosine
    i, j = np.nonzero(np.abs(product - cosine) < CLOSE)
    if len(i):
        near[i, j] = (a[i] * b[j]).sum(axis=1) >= cosine
    return near


def _link(cosine: float):
    """Rows (a, b, n): the links n of home vector a, or an edge (a, b) of a forest over the block's links."""
    def run(homes: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="Int64"), "n": pd.Series([], dtype="Int64")})
        if homes.empty or members.empty:
            return empty
        a, b = _matrix(homes["_unit"]), _matrix(members["_unit"])
        h, m = homes["cid"].to_numpy(), members["cid"].to_numpy()
        ids, place = np.unique(np.concatenate([h, m]), return_inverse=True)
        at_h, at_m, copies = place[:len(h)], place[len(h):], members["copies"].to_numpy().astype(np.float64)
        counts, root = np.zeros(len(h)), np.arange(len(ids))
        for x in range(0, len(a), TILE):
            for y in range(0, len(b), TILE):
                near = _near(a[x:x + TILE], b[y:y + TILE], cosine)
                near &= h[x:x + TILE, None] != m[None, y:y + TILE]
                counts[x:x + TILE] += near @ copies[y:y + TILE]
                i, j = np.nonzero(near)
                if len(i):  # the forest so far and the tile's links
                    root = _least_labels(np.concatenate([np.arange(len(ids)), at_h[x + i]]),
                                         np.concatenate([root, at_m[y + j]]), len(ids))
        inner = np.flatnonzero(root != np.arange(len(ids)))
        linked = np.flatnonzero(counts)
        if not len(linked):
            return empty
        return pd.DataFrame({
            "a": np.concatenate([h[linked], ids[inner]]),
            "b": pd.array([*[None] * len(linked), *ids[root[inner]].tolist()], "Int64"),
            "n": pd.array([*counts[linked].astype(np.int64).tolist(), *[None] * len(inner)], "Int64")})
    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    cosine: float = COSINE, cell: int = CELL, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null and their
    lengths are equal.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing: no links, a component of their
    own.  Repeated rows are vectors of their own and link with each other.
    ``component_id`` is the smallest key in the component, ``kept`` whether it
    is the vector's; a null key is never the smallest, and without any key in
    the component the id is null.  An empty table gives an empty result; other
    columns are ignored.

    Vectors of one direction are joined as one class with a number of copies.
    A group of n classes has n / ``cell`` pivots or about ``pivots``, whichever
    is less, chosen by hash; they only steer the cost.
    """
    radius = float(np.sqrt(2 - 2 * cosine))
    units = unit_vectors(vectors, key, embedding, label).checkpoint()
    classes = (units.filter("_unit is not null").groupBy(*GROUP, "_unit")
               .agg(F.count("*").alias("copies"), F.min("_id").alias("least"))
               .withColumn("cid", F.monotonically_increasing_id()).checkpoint())
    groups = classes.groupBy(*GROUP).agg(F.count("*").alias("_n"), F.min(F.xxhash64("cid")).alias("_h")).select(
        F.col("_label").alias("_gl"), F.col("_dim").alias("_gd"), "_h",
        F.ceil(F.col("_n") / block).cast("int").alias("_blocks"),
        (F.least(F.ceil(F.col("_n") / cell), F.lit(pivots)) / F.col("_n")).alias("_share"))
    known = classes.select(*GROUP, "cid", "copies", "_unit").join(
        groups, F.expr("_label = _gl and _dim = _gd")).drop("_gl", "_gd")
    unit_hash = F.pmod(F.xxhash64("cid"), F.lit(1 << 40)) / float(1 << 40)
    chosen = known.filter((F.xxhash64("cid") == F.col("_h")) | (unit_hash < F.col("_share")))
    dealt = known.withColumn("_block", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("_blocks")).cast("int"))
    for_blocks = chosen.select(*GROUP, "cid", "_unit", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    for_blocks = for_blocks.toDF(*for_blocks.columns)  # columns of its own: both sides come from one table
    by = [*GROUP, "_block"]
    placed = (dealt.select(*by, "cid", "copies", "_unit").groupBy(*by).cogroup(for_blocks.groupBy(*by))
              .applyInPandas(_assign(radius), "_label string, _dim int, cell long, home boolean, cid long, copies long,"
                             " _unit binary").checkpoint())
    sizes = placed.groupBy("cell").agg(F.ceil(F.count_if("home") / block).cast("int").alias("_hs"),
                                       F.ceil(F.count("*") / block).cast("int").alias("_ms"))
    sized = placed.join(sizes.withColumnRenamed("cell", "_c"), F.expr("cell = _c"))
    own = lambda n: F.pmod(F.xxhash64("cid", F.lit(2)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    homes = sized.filter("home").select("cell", own("_hs").alias("_hb"), every("_ms").alias("_mb"), "cid", "_unit")
    members = sized.filter("_hs > 0").select("cell", every("_hs").alias("_hb"), own("_ms").alias("_mb"), "cid", "copies",
                                             "_unit")
    members = members.toDF(*members.columns)
    by = ["cell", "_hb", "_mb"]
    linked = (homes.groupBy(*by).cogroup(members.groupBy(*by))
              .applyInPandas(_link(cosine), "a long, b long, n long").checkpoint())
    counts = linked.filter("n is not null").groupBy(F.col("a").alias("_a")).agg(F.sum("n").alias("_links"))
    roots = connected_components(linked.filter("b is not null").select("a", "b"))
    rooted = classes.join(roots, F.col("cid") == F.col("node"), "left").withColumn(
        "_root", F.coalesce("component", "cid")).drop("node", "component")
    ids = rooted.groupBy("_root").agg(F.min("least").alias("component_id"))
    named = (rooted.join(ids, "_root").join(counts, F.col("cid") == F.col("_a"), "left")
             .select(F.col("_label").alias("_cl"), F.col("_unit").alias("_cu"),
                     (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    found = units.filter("_unit is not null").join(named, F.expr("_label = _cl and _unit = _cu")).select(
        F.col("_id").alias(key), "n_links", "component_id")
    alone = units.filter("_unit is null").select(F.col("_id").alias(key), F.lit(0).cast("long").alias("n_links"),
                                                 F.col("_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def oracle(vectors: str = "embeddings") -> str:
    """DuckDB SQL of :func:`near_duplicates` with the default cosine, by comparing all pairs of a label."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM {vectors} WHERE label IS NOT NULL
  AND len(embedding) > 0 AND NOT list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
  AND list_contains(list_transform(embedding, lambda x: x <> 0), true)),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e)
  AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
r(vec_id, m) AS (SELECT vec_id, vec_id FROM {vectors} UNION SELECT r.vec_id, p.b FROM r JOIN p ON r.m = p.a),
c AS (SELECT vec_id, min(m) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)"""
