"""Sorted reports, top-k and top-n per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def top_k(df: DataFrame, order: Sequence[str | Column], k: int,
          tie_break: Sequence[str] | None = None) -> DataFrame:
    """``ORDER BY order, tie_break LIMIT k``.

    Planned as ``TakeOrderedAndProject``: each task keeps its own k best rows
    and only those reach the final merge, so nothing scales with the input.
    ``tie_break`` (ascending) makes the cut deterministic on equal keys.
    """
    return df.orderBy(*_cols(order), *_cols(tie_break or [])).limit(k)


def top_counts(df: DataFrame, keys: Sequence[str], k: int = 10, name: str = "count",
               where: Column | None = None) -> DataFrame:
    """Group count, largest first, ties by key ascending, first ``k``."""
    if where is not None:
        df = df.filter(where)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return top_k(counted, [F.col(name).desc()], k, tie_break=list(keys))


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                    n: int | None, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of every group by ``order`` (all rows when n is None).

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000) rows, every
    task keeps its own first n of a group before the exchange, so a hot group's
    last task ranks n rows of each task.  Beyond that Spark sends whole groups,
    so a group is first dealt into as many parts as there are shuffle
    partitions, by a hash of the whole row, each part keeps its first n, and
    the group's first n are taken from those.  ``order`` should end in a unique
    tie-break.
    """
    if n is None:
        return df
    rc = rank_col or "_rn"

    def first(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return rows.withColumn(rc, F.row_number().over(w)).filter(F.col(rc) <= n)

    conf = df.sparkSession.conf
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        parts = int(conf.get("spark.sql.shuffle.partitions", "200"))
        dealt = df.withColumn("_part", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(parts)))
        df = first(dealt, [*group, "_part"]).drop("_part", rc)
    out = first(df, list(group))
    return out if rank_col else out.drop(rc)
