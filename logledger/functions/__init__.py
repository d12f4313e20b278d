"""Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""

from logledger.functions.text import signed_text, split_drop_trailing_empty
from logledger.functions.flags import drift_flag
from logledger.functions.ids import packed_id, TYPE_CODES
from logledger.functions.time import log_time_to_utc

__all__ = ["signed_text", "split_drop_trailing_empty", "drift_flag", "packed_id",
           "TYPE_CODES", "log_time_to_utc"]
