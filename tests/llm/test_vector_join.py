import math
import random

import numpy as np
import pandas as pd
import pytest

from logledger.llm import vector_join
from logledger.llm.queries import QUERIES
from tests.llm.conftest import SF, rows

KIND = "vec_id long, embedding array<double>, label int, kept string, component_id string"


def brute(data):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    def usable(v, lab):
        return lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def unit(v):
        x = np.array(v, float) / max(map(abs, v))
        return x / np.linalg.norm(x)

    units = [unit(v) if usable(v, lab) else None for _, v, lab in data]
    n = len(data)
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None
             and data[i][2] == data[j][2] and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= 0.93]
            for i in range(n)]
    group = list(range(n))
    for i in range(n):
        stack, seen = [i], {i}
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        group[i] = min(seen, key=lambda j: (data[j][0] is None, data[j][0] or 0))
    return sorted(((d[0], len(near[i]), data[group[i]][0], d[0] == data[group[i]][0]) for i, d in enumerate(data)), key=repr)


def test_query_matches_brute_force(spark):
    data = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = QUERIES["op2_embedding_near_dedup"](spark, SF)
    assert rows(out.select("vec_id", "n_links", "component_id", "kept")) == brute(data)


def clustered(seed, n=260, dims=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(9)]
    return [(i, [c + rng.gauss(0, 0.35) for c in rng.choice(centres)], rng.choice([1, 1, 1, 2])) for i in range(n)]


@pytest.mark.parametrize(("cell", "block"), [(2048, 2048), (20, 16), (4, 7)])
def test_cells_and_blocks_lose_no_link(spark, cell, block):
    data = clustered(cell)
    df = spark.createDataFrame([(*r, "x", "y") for r in data], KIND)
    out = vector_join.near_duplicates(df, cell=cell, block=block)
    assert rows(out.select("vec_id", "n_links", "component_id", "kept")) == brute(data)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
            (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [1e300, 1e299], 1), (13, [-1.0, 0.0], 1), (None, [0.0, -1.0], 1),
            (14, [0.0, -3.0], 1)]
    df = spark.createDataFrame([(*r, "x", "y") for r in data], KIND)
    out = vector_join.near_duplicates(df)
    assert rows(out.select("vec_id", "n_links", "component_id", "kept")) == brute(data)
    assert vector_join.near_duplicates(df.limit(0)).count() == 0


def test_tiles_and_ties_at_the_threshold(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3))
    x = np.concatenate([x, x[:20] + rng.normal(size=(20, 3)) * 0.05])
    x /= np.linalg.norm(x, axis=1)[:, None]
    frame = pd.DataFrame({"cid": np.arange(80), "copies": rng.integers(1, 4, 80), "_unit": [v.tobytes() for v in x]})
    found = []
    for tile in (2048, 7):
        monkeypatch.setattr(vector_join, "TILE", tile)
        out = vector_join._link(0.93)(frame[["cid", "_unit"]], frame)
        forest = out[out.b.notna()]
        label = vector_join._least_labels(forest.a.to_numpy(np.int64), forest.b.to_numpy(np.int64), 80)
        found.append((out[out.n.notna()].set_index("a").n.astype(int).to_dict(), label.tolist()))
    assert found[0] == found[1] and len(set(found[0][1])) < 80
    pair = x[:2]
    at = float((pair[0] * pair[1]).sum())
    for cosine in (at, np.nextafter(at, 2)):
        ways = {bool(vector_join._near(a, b, cosine)[0, 0]) for a, b in ((pair[:1], pair[1:]), (pair[1:], pair[:1]))}
        assert ways == {cosine == at}
