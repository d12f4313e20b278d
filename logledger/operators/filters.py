"""Range predicates on publication / entity ids (pushed down as plain comparisons)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def within(col: str | Column, lower: int | None = None, upper: int | None = None) -> Column:
    """Inclusive range; ``None`` leaves that end open (no sentinel values)."""
    c = F.col(col) if isinstance(col, str) else col
    cond = F.lit(True)
    if lower is not None:
        cond = cond & (c >= F.lit(lower))
    if upper is not None:
        cond = cond & (c <= F.lit(upper))
    return cond


def within_any(col: str | Column, *ranges: tuple[int | None, int | None] | None) -> Column:
    """OR of inclusive ranges; a ``None`` range is skipped."""
    conds = [within(col, lo, hi) for r in ranges if r is not None for (lo, hi) in [r]]
    if not conds:
        return F.lit(True)
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def open_upper(upper: int | None) -> int | None:
    """Command-line convention: ``-1`` means no upper bound."""
    return None if upper is None or upper == -1 else upper
