"""Helpers shared by the operators: words of a text, distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the query contracts: words are runs of anything but these six characters.
GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null, empty and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP, -1))


def n_words(text: Column) -> Column:
    """Number of words as a long, without a lambda per word."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP, -1))).cast("long")


def prefix_sums(rows: DataFrame, by: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the inclusive running sum of ``value`` in each ``by`` group.

    The order is (``bucket``, ``order``), so ``bucket`` must rise with the
    intended order.  No task sees a whole group: rows are summed per
    (group, bucket), only these totals are accumulated per group, and the rows
    are then accumulated within their bucket.  Choose buckets of bounded size.
    """
    totals = rows.groupBy(*by, bucket).agg(F.sum(value).alias("_in_bucket"))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_o_{c}") for c in by], F.col(bucket).alias("_o_bucket"),
                            F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_before"))
    same = F.col(bucket) == F.col("_o_bucket")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    within = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_within", F.sum(value).over(within))
    return (summed.join(offsets, same).withColumn(out, F.col("_before") + F.col("_within"))
            .drop("_o_bucket", "_before", "_within", *[f"_o_{c}" for c in by]))
