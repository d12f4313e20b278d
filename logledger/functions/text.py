"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the difference text of every reconciliation report is a signed,
# thousands-grouped integer right-aligned to width 8 (wider numbers overflow).
SIGNED_FORMAT = "%,+8d"


def signed_text(diff: Column | str) -> Column:
    """``12345 -> ' +12,345'``; null stays null (``format_string`` would print 'null')."""
    c = F.col(diff) if isinstance(diff, str) else diff
    return F.when(c.isNotNull(), F.format_string(SIGNED_FORMAT, c.cast("long")))


def split_drop_trailing_empty(col: Column | str, pattern: str) -> Column:
    """``split`` with Java ``String.split`` semantics: trailing empty parts removed.

    Spark keeps them (``'a|b|'`` gives ``['a','b','']``).  Only the *trailing*
    run of empty strings is dropped; inner empty parts stay; a text of
    separators alone has no parts.  The parts are those of one line, so a line
    break can hold their places while the end is trimmed (no lambda per part).
    """
    c = F.col(col) if isinstance(col, str) else col
    kept = F.rtrim(F.array_join(F.split(c, pattern), "\n"), F.lit("\n"))
    return F.when(kept == "", F.array().cast("array<string>")).otherwise(F.split(kept, "\n"))
