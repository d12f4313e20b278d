"""Catalogue categorisation and packed numeric ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions.ids import packed_id

# Show-type codes and the resource type each one stands for;
# type 5 splits on the programme id prefix.  Other codes give a null type.
MOVIE_TYPE, OTHER_TYPE, SERIES_TYPE = 8, 3, 5
EPISODE_PREFIX = "EP"


def content_overlays(csv: DataFrame) -> DataFrame:
    """Overlay rows: resource type, content id, collection id and both packed ids."""
    rtype = (F.when(F.col("SHOWTYPE") == MOVIE_TYPE, "movie_overlay")
             .when(F.col("SHOWTYPE") == OTHER_TYPE, "other_overlay")
             .when(F.col("SHOWTYPE") == SERIES_TYPE,
                   F.when(F.col("TMSID").startswith(EPISODE_PREFIX), "episode_overlay")
                   .otherwise("series_overlay")))
    coll = F.substring(F.col("SERIESTMSID"), 3, 10).try_cast("int")
    df = csv.withColumns({"resource_type": rtype, "coll_tmsid": coll})
    return df.select(F.col("sourceProgramId").alias("rovi_id"), "resource_type", "mfsid",
                     packed_id("ct", F.col("mfsid")).alias("ct_numeric"), "coll_tmsid",
                     packed_id("cl", F.col("coll_tmsid")).alias("cl_numeric"),
                     F.col("TITLE").alias("title"))


def overlay_type_counts(overlays: DataFrame) -> DataFrame:
    return overlays.groupBy("resource_type").agg(F.count(F.lit(1)).alias("count"))


def overlay_samples(overlays: DataFrame, resource_type: str = "movie_overlay") -> DataFrame:
    """Rows of one type (the original sample filter compared with 'movie' and never matched)."""
    return overlays.filter(F.col("resource_type") == resource_type)


def station_overlays(csv: DataFrame) -> DataFrame:
    return csv.select(F.col("sourceStationId").alias("rovi_id"),
                      F.lit("station_overlay").alias("resource_type"), "mfsid",
                      packed_id("st", F.col("mfsid")).alias("st_numeric"))


def save_overlays(content: DataFrame | None, station: DataFrame | None, fmt: str, path: str,
                  run: str | None = None, **options) -> None:
    """Write the lookup collection: content overlays replace it (overwrite),
    station overlays are added to it (append).  Rows keep a common column set
    (missing packed ids are null).

    With ``run``, either kind replaces what an earlier job of that name wrote
    and leaves the rest, so a job can be repeated; the collection is
    partitioned by ``run`` then."""
    from logledger.sinks import write_format, write_run
    cols = {"rovi_id": "long", "resource_type": "string", "mfsid": "int", "ct_numeric": "long",
            "coll_tmsid": "int", "cl_numeric": "long", "title": "string", "st_numeric": "long"}

    def shaped(df):
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                           for c, t in cols.items()])

    if run is not None:
        for df in (content, station):
            if df is not None:
                write_run(shaped(df), fmt, path, run, **options)
        return
    if content is not None:
        write_format(shaped(content), fmt, path, mode="overwrite", **options)
    if station is not None:
        write_format(shaped(station), fmt, path, mode="append", **options)
