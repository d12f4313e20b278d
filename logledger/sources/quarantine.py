"""Lines that don't parse, kept with file and reason beside the rows that do.

A reader judges every line: the parsed columns, or a reason.  One write puts
both kinds below one folder, partitioned by ``quarantined``, so nothing is read
twice and no line is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.functions.text import split_drop_trailing_empty
from logledger.sources.counts import COUNT_SEPARATOR
from logledger.sources.ratings_files import FIELD_SEP, GENRE_SEP, MOVIE_FIELDS, RATING_FIELDS

BAD = {"line": "string", "file": "string", "reason": "string"}
RATING_COLUMNS = {"user_id": "int", "movie_id": "int", "rating": "float"}
MOVIE_COLUMNS = {"id": "int", "title": "string", "genres": "array<string>"}
COUNT_COLUMNS = {"resource": "string", "count": "bigint"}


def read_lines_with_file(spark: SparkSession, path: str) -> DataFrame:
    """(value, file) of the text files below ``path``."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def _judge(lines: DataFrame, parts: Column, n_fields: int, columns: dict[str, tuple[Column, str]]) -> DataFrame:
    """The columns of a good line, or its text, file and the reason: number of fields, or the column that is no number."""
    split = lines.select("value", "file", parts.alias("_p"))
    reason = F.when(F.coalesce(F.size("_p"), F.lit(-1)) != n_fields, F.lit(f"not {n_fields} fields"))
    for name, (field, kind) in columns.items():
        if kind in ("int", "float", "bigint"):
            reason = reason.when(field.try_cast(kind).isNull(), F.lit(f"{name} is no {kind}"))
    judged = split.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return judged.select(*[F.when(good, field.try_cast(kind) if kind in ("int", "float", "bigint") else field).alias(name)
                           for name, (field, kind) in columns.items()],
                         F.when(~good, F.col("value")).alias("line"), F.when(~good, F.col("file")).alias("file"), "reason")


def _part(i: int) -> Column:
    return F.get("_p", F.lit(i))


def judge_ratings(lines: DataFrame) -> DataFrame:
    """``user::item::rating::ts`` lines (value, file) -> user_id, movie_id, rating or line, file, reason."""
    fields = {c: (_part(i), kind) for i, (c, kind) in enumerate(RATING_COLUMNS.items())}
    return _judge(lines, split_drop_trailing_empty(F.col("value"), FIELD_SEP), RATING_FIELDS, fields)


def judge_movies(lines: DataFrame) -> DataFrame:
    """``id::title::g1|g2`` lines (value, file) -> id, title, genres or line, file, reason."""
    genres = split_drop_trailing_empty(_part(2), GENRE_SEP)
    return _judge(lines, split_drop_trailing_empty(F.col("value"), FIELD_SEP), MOVIE_FIELDS,
                  {"id": (_part(0), "int"), "title": (_part(1), "string"), "genres": (genres, "array<string>")})


def judge_counts(lines: DataFrame) -> DataFrame:
    """``resource - count`` lines (value, file) -> resource, count or line, file, reason."""
    return _judge(lines, F.split(F.col("value"), COUNT_SEPARATOR), 2,
                  {"resource": (_part(0), "string"), "count": (_part(1), "bigint")})


def land_judged(judged: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Good rows and quarantined lines in one pass, as Parquet below ``path``."""
    judged.withColumn("quarantined", F.col("reason").isNotNull().cast("int")).write.mode(mode).partitionBy(
        "quarantined").parquet(path)


def _read(spark: SparkSession, path: str, columns: dict[str, str], quarantined: int) -> DataFrame:
    schema = ", ".join(f"`{c}` {kind}" for c, kind in {**columns, "quarantined": "int"}.items())
    return spark.read.schema(schema).parquet(path).filter(F.col("quarantined") == quarantined).drop("quarantined")


def read_good(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    return _read(spark, path, columns, 0)


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, reason); only their folder is read."""
    return _read(spark, path, BAD, 1)
