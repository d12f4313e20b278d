"""Parse once, report many times: extracted log rows landed as parquet.

Text scans are not vectorised and every report over raw lines runs the
extraction again.  Landing the extracted rows as parquet partitioned by
resource lets later reports prune whole resources (a resource list becomes a
partition filter) and skip row groups by pub_id / rovi_id statistics.  The
reconciliation reports accept either form (a line table with ``value``, or
landed rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logledger.operators.extract import extract_resolver_raw, extract_states
from logledger.sinks import save_table

MATCH_KEYS = ["resource", "pub_id", "rovi_id", "old_pub_id"]  # of matched_differences
RESOLVER_SCHEMA = "rovi_id long, pub_id long, old_pub_id string, state string, dirty_size long, resource string"
STATE_SCHEMA = "rovi_id long, state string, pub_id long, resource string"


def _land(rows: DataFrame, path: str, mode: str) -> None:
    """Parquet partitioned by resource, in files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.

    The rebalance sends a resource to one partition; where that is too large
    AQE splits it by what the shuffle really wrote, and joins small ones, so
    the number of a resource's files follows its bytes.
    """
    (rows.hint("rebalance", "resource").sortWithinPartitions("resource", "pub_id")
     .write.mode(mode).partitionBy("resource").parquet(path))


def land_resolver(lines: DataFrame, dialect: str, path: str, mode: str = "overwrite") -> None:
    """Resolver lines -> parquet of (resource, rovi_id, pub_id, old_pub_id, state, dirty_size)."""
    _land(extract_resolver_raw(lines, dialect), path, mode)


def land_states(lines: DataFrame, dialect: str, path: str, listener_digits: int = 1, mode: str = "overwrite") -> None:
    """State lines -> parquet of (rovi_id, resource, state, pub_id)."""
    _land(extract_states(lines, dialect, listener_digits), path, mode)


def land_resolver_table(lines: DataFrame, dialect: str, table: str, buckets: int, mode: str = "overwrite",
                        path: str | None = None) -> None:
    """Resolver lines -> catalogue table in ``buckets`` buckets of the matching key, sorted by it.

    Two tables of as many buckets are joined by that key without an exchange,
    as often as the report is run.  The key holds ids, so a hot resource is
    spread over all buckets; choose ``buckets`` so that one fits a task.  Files
    are sorted by resource first: a resource list skips row groups.
    """
    rows = extract_resolver_raw(lines, dialect).repartition(buckets, *MATCH_KEYS)
    save_table(rows, table, mode, bucket_by=(buckets, *MATCH_KEYS), path=path)


def read_landed(spark: SparkSession, path: str, schema: str = RESOLVER_SCHEMA) -> DataFrame:
    """Landed rows by a fixed schema: a resource named ``007`` stays text."""
    return spark.read.schema(schema).parquet(path)
