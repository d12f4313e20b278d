"""``resource - count`` files and per-table row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: separator of a count line, e.g. "Asset - 64638".
COUNT_SEPARATOR = " - "


def parse_count_lines(lines: DataFrame, mode: str = "fail", col: str = "value",
                      count_name: str = "count") -> DataFrame:
    """``resource - count`` lines -> (resource, count).

    ``mode='fail'`` raises on a line that does not have exactly two parts or
    whose count is not a number (as the original assertion does);
    ``mode='drop'`` skips such lines.
    """
    parts = F.split(F.col(col), COUNT_SEPARATOR)
    df = lines.select(parts.alias("_p"))
    n = F.expr("try_cast(_p[1] as bigint)")
    ok = (F.size("_p") == 2) & n.isNotNull()
    if mode == "drop":
        df = df.filter(ok)
        cnt = n
    elif mode == "fail":
        cnt = F.when(ok, n).otherwise(
            F.raise_error(F.concat(F.lit("bad count line: "), F.array_join("_p", COUNT_SEPARATOR))))
    else:
        raise ValueError("mode must be 'fail' or 'drop'")
    return df.select(F.col("_p")[0].alias("resource"), cnt.cast("long").alias(count_name))


def render_count_lines(counts: DataFrame, resource: str = "resource",
                       count: str = "count") -> DataFrame:
    """(resource, count) -> ``value`` lines, the inverse of :func:`parse_count_lines`."""
    return counts.select(F.concat_ws(COUNT_SEPARATOR, F.col(resource),
                                     F.col(count).cast("string")).alias("value"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(resource, count) with ``count(*)`` of every table, one union plan."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("count"))
               .select(F.lit(name).alias("resource"), "count")
             for name, df in tables.items()]
    return _union(parts)


def table_nonnull_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(resource, count) with the number of rows whose key column is not null."""
    parts = [df.agg(F.count(F.col(key)).cast("long").alias("count"))
               .select(F.lit(name).alias("resource"), "count")
             for name, (df, key) in tables.items()]
    return _union(parts)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that answers counts from parquet footers.

    Its parquet reader is the V2 one, the only one that takes aggregates; the
    settings would change how other reports read, so they are not the caller's.
    """
    own = spark.newSession()
    v1 = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(f for f in v1 if f != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def file_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """:func:`table_counts` of parquet folders: no row is read, footers have the counts."""
    own = footer_session(spark)
    return table_counts({n: own.read.parquet(p) for n, p in paths.items()})


def file_nonnull_counts(spark: SparkSession, paths: Mapping[str, tuple[str, str]]) -> DataFrame:
    """:func:`table_nonnull_counts` of parquet folders (path, key column): rows less nulls, from footers."""
    own = footer_session(spark)
    return table_nonnull_counts({n: (own.read.parquet(p), key) for n, (p, key) in paths.items()})


def catalog_tables(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.table(n) for n in names}


def catalog_table_counts(spark: SparkSession, database: str | None = None,
                         exclude_prefix: str = "system") -> DataFrame:
    """(resource, count) for every table and view of a database whose name does
    not start with ``exclude_prefix`` - one union plan, one count per table."""
    names = sorted(t.name for t in spark.catalog.listTables(database)
                   if not t.name.startswith(exclude_prefix) and not (database and t.isTemporary))
    return table_counts({n: spark.table(f"{database}.{n}" if database else n) for n in names})


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
