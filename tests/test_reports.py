"""Report plans: six-table state summary, overlay collection, flights, CV job."""

from pyspark.sql import functions as F

from logledger.plans import overlays as ov
from logledger.plans import reconcile as rc
from logledger.plans import recommend as rm
from logledger.plans import reports as rp
from logledger.queries import ratings, t, new_user_ratings, NEW_USER
from logledger.sources import render as rd
from tests.conftest import SF_SMALL


def test_state_report_six_tables(spark):
    o = t(spark, SF_SMALL, "orders")
    rep = rc.state_report(rd.state_lines(o, "control"), rd.state_lines(o, "candidate"))
    assert len(rep) == 6
    for side in ("control", "candidate"):
        n = {by: rep[f"{side}_by_{by}"].agg(F.sum("count")).first()[0]
             for by in ("state", "resource", "resource_state")}
        assert len(set(n.values())) == 1


def test_state_filter_option(spark):
    o = t(spark, SF_SMALL, "orders")
    df = rc.states_in_range(rd.state_lines(o, "control"), "control", states=["PUBLISH", "UNPUBLISH"])
    assert {r.state for r in df.select("state").distinct().collect()} == {"PUBLISH", "UNPUBLISH"}


def test_overlay_collection_overwrite_then_append(spark, tmp_path):
    content = ov.content_overlays(rd.content_overlay_rows(t(spark, SF_SMALL, "part")))
    station = ov.station_overlays(rd.station_overlay_rows(t(spark, SF_SMALL, "supplier")))
    path = str(tmp_path / "lookup")
    ov.save_overlays(content, station, "parquet", path)
    ov.save_overlays(content, station, "parquet", path)          # overwrite resets, append adds
    back = spark.read.parquet(path)
    assert back.count() == content.count() + station.count()     # second overwrite dropped the first append
    assert back.filter(F.col("resource_type") == "station_overlay").filter(F.col("st_numeric").isNull()).count() == 0


def test_flight_reports_six_tables(spark):
    rep = rp.flight_reports(rd.flights_from_events(t(spark, SF_SMALL, "events")), k=3, keep_fraction=2 / 3)
    assert len(rep) == 6
    assert all(df.count() <= 3 for df in rep.values())


def test_one_pass_flight_tables_equal_single_tables(spark):
    fl = rd.routes(t(spark, SF_SMALL, "orders"), t(spark, SF_SMALL, "lineitem")).unionByName(
        rd.flights_from_events(t(spark, SF_SMALL, "events")).withColumn("dest", F.lit(None).cast("long"))
        .withColumn("origin", F.col("origin") % 30))
    fl = fl.withColumn("cancelled", (F.col("origin") % 3 == 0).cast("int"))
    allt = rp.flight_reports(fl, k=7)
    for name in rp.FLIGHT_TABLES:
        assert allt[name].collect() == rp.flight_report(fl, name, k=7).collect(), name


def test_cross_validated_job(spark, tmp_path):
    r = ratings(spark, SF_SMALL)
    mine = new_user_ratings(spark).select("user_id", "movie_id", F.col("rating").cast("int").alias("rating"))
    movies = t(spark, SF_SMALL, "part").select(F.col("p_partkey").cast("int").alias("movie_id"),
                                               F.col("p_name").alias("title"))
    table, user_rows = rm.cross_validated_job(r, mine, movies, NEW_USER, str(tmp_path / "csv"),
                                              str(tmp_path / "cv"), k=5, folds=2)
    rows = table.collect()
    assert len(rows) == 6 and sum(x.is_best for x in rows) == 1
    assert min(rows, key=lambda x: x.avg_rmse).is_best
    assert user_rows.count() <= 5
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() > 0


def test_salted_access_join_equals_plain(spark):
    lines = rd.access_lines(t(spark, SF_SMALL, "events"))
    prices = rd.price_list(t(spark, SF_SMALL, "part"))
    a = rp.access_value_join(lines, prices)
    b = rp.access_value_join(lines, prices, salts=8)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_coldstart_job(spark):
    r = ratings(spark, SF_SMALL)
    mine = new_user_ratings(spark).select("user_id", "movie_id", F.col("rating").cast("int").alias("rating"))
    movies = t(spark, SF_SMALL, "part").select(F.col("p_partkey").cast("int").alias("movie_id"),
                                               F.col("p_name").alias("title"))
    old = r.first()["user_id"]
    out = rm.coldstart_job(r, mine, movies, [NEW_USER, old], k=5)
    rows = out["tuning"].collect()
    assert len(rows) == 6 and sum(x.is_best for x in rows) == 1
    assert min(rows, key=lambda x: x.validation_rmse).is_best
    unrated = out[f"user_{NEW_USER}_unrated"]
    assert unrated.count() == 5
    assert unrated.join(mine, ["movie_id"]).count() == 0          # rated movies excluded
    assert out[f"user_{NEW_USER}_from_all"].count() == 5 and out[f"user_{old}_from_all"].count() == 5


def test_cached_aggregates_are_released(spark):
    flights = spark.createDataFrame([(2000, 1, "A", "B", 20.0, 0), (2001, 2, "A", "C", 70.0, 1)],
                                    "year int, quarter int, origin string, dest string, depdelay double, cancelled int")
    report = rp.flight_reports(flights)
    assert report["departures"].first()["total_departures"] == 2 and report.cached.storageLevel.useMemory
    report.release()
    assert not report.cached.storageLevel.useMemory
    assert rp.flight_reports(flights, cache=False).cached is None


def test_scratch_is_the_applications_own_and_goes(spark):
    import os
    from urllib.parse import urlparse
    from logledger.session import remove_folder, scratch_path
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and spark.sparkContext.applicationId in a
    spark.range(3).write.parquet(a)
    assert spark.read.parquet(a).count() == 3
    remove_folder(spark, a)
    assert not os.path.exists(urlparse(a).path)
