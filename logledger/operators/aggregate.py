"""Aggregations shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_sums(tagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``sum(control_n), sum(candidate_n)`` per key (one partial + one final agg)."""
    return tagged.groupBy(*keys).agg(
        F.sum("control_n").cast("long").alias("control_sum"),
        F.sum("candidate_n").cast("long").alias("candidate_sum"))


def group_count(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))



class Reports(dict):
    """Tables, by name, that are read from one cached aggregate; :meth:`release` drops it when they have been shown."""

    def __init__(self, tables: dict[str, DataFrame], cached: DataFrame | None = None):
        super().__init__(tables)
        self.cached = cached

    def release(self) -> None:
        if self.cached is not None:
            self.cached.unpersist()
