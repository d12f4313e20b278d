"""Access-log time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the access-log time layout, e.g. 07/Mar/2004:16:05:49 -0800.
ACCESS_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def log_time_to_utc(col: Column | str) -> Column:
    """Access-log time text -> UTC wall time (``timestamp_ntz``), null if unparsable.

    The zone offset in the text fixes the instant, so the result does not
    depend on the session or JVM zone: ``16:05:49 -0800`` is ``00:05:49`` UTC
    on the next day, ``+0530`` subtracts 5:30.
    """
    c = F.col(col) if isinstance(col, str) else col
    instant = F.try_to_timestamp(c, F.lit(ACCESS_TIME_FORMAT))
    epoch0 = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch0)
