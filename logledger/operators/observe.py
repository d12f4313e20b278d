"""Counts of read, accepted and refused lines, taken by the pass that makes the report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class LineCounts:
    """What became of a log's lines; :meth:`get` waits for the first action on the rows.

    The counts are those of the tasks that action needed: an action that stops
    early (``limit`` without a sort) has read less.
    """

    def __init__(self) -> None:
        self._read, self._accepted = Observation(), Observation()

    def get(self) -> dict[str, int]:
        lines, accepted = self._read.get.get("n", 0), self._accepted.get.get("n", 0)
        return {"lines": lines, "accepted": accepted, "refused": lines - accepted}


def observed(lines: DataFrame, extract: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, LineCounts]:
    """``extract(lines)`` and the counts of its lines, without an action or a scan of their own.

    ``extract`` gives one row or none for a line; its rows go on to any report.
    Null lines are lines.
    """
    counts, n = LineCounts(), F.count(F.lit(1)).alias("n")
    rows = extract(lines.observe(counts._read, n))
    return rows.observe(counts._accepted, n), counts
