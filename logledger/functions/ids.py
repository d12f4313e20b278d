"""Packed 64-bit catalogue ids as a native column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the id layout: bits 56+ scheme, 40-55 type, 32-39 namespace,
# 0-31 the (sign-extended) int key.  Type codes per identifier.
TYPE_CODES = {"st": 523, "cl": 313}
DEFAULT_TYPE = 320
SCHEME, NAMESPACE = 0, 0


def packed_id(kind: str, key: Column | str) -> Column:
    """``scheme<<56 | type<<40 | ns<<32 | key``; null key gives null.

    A negative key is sign-extended before the OR, so it overwrites the upper
    bits (``-1 -> -1``), as the original per-row function does.
    """
    k = F.col(key) if isinstance(key, str) else key
    code = TYPE_CODES.get(kind, DEFAULT_TYPE)
    head = (SCHEME << 56) | (code << 40) | (NAMESPACE << 32)
    return F.lit(head).cast("long").bitwiseOR(k.try_cast("int").cast("long"))

