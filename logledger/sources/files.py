"""File, table and format readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines, one row per line in column ``value``; ``.gz`` is read transparently."""
    return spark.read.text(path if isinstance(path, str) else list(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, sep: str = ",", encoding: str = "UTF-8",
             infer_sampling: float = 1.0, columns: Mapping[str, str] | None = None) -> DataFrame:
    """CSV with header.  ``columns`` (name -> type) picks fields by their names
    in the header and casts them, ``schema`` takes all fields in file order;
    neither makes an inference pass (use them at scale).  Without both, types
    are inferred, optionally from a sample."""
    r = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
    if columns is not None:
        return r.csv(path).select(*[F.col(c).cast(k).alias(c) for c, k in columns.items()])
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True).option("samplingRatio", infer_sampling)
    return r.csv(path)


ZIPS_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("loc", T.ArrayType(T.DoubleType())),
    T.StructField("pop", T.LongType()),
    T.StructField("state", T.StringType()),
])


def read_json_typed(spark: SparkSession, path: str, schema: T.StructType = ZIPS_SCHEMA,
                    rename: dict[str, str] | None = None) -> DataFrame:
    """JSON lines read with a fixed schema (no inference job), columns renamed."""
    df = spark.read.schema(schema).json(path)
    for old, new in (rename if rename is not None else {"_id": "zip"}).items():
        df = df.withColumnRenamed(old, new)
    return df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str] | str) -> DataFrame:
    """A small literal table (``createDataFrame(list).toDF(names)``)."""
    if isinstance(names, str):
        return spark.createDataFrame(list(rows), names)
    return spark.createDataFrame(list(rows)).toDF(*names)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table or view by name."""
    return spark.table(name)


def read_format(spark: SparkSession, fmt: str, path: str | None = None,
                columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Any data-source format with options; ``columns`` picks fields by name."""
    r = spark.read.format(fmt).options(**options)
    df = r.load(path) if path else r.load()
    return df.select(*columns) if columns else df
