"""Readers and sinks: gz text, CSV inference, typed JSON, Latin-1 movies, count lines."""

import gzip

import pytest
from pyspark.sql import functions as F

from logledger.plans import overlays as ov
from logledger.sources import counts as cn
from logledger.sources import files as fl
from logledger.sources import ratings_files as ml


def test_text_gz(spark, tmp_path):
    p = tmp_path / "a.log.gz"
    with gzip.open(p, "wt") as f:
        f.write("l1\nl2\n")
    assert [r.value for r in fl.read_lines(spark, str(p)).collect()] == ["l1", "l2"]


def test_csv_inference_and_overlay(spark, tmp_path):
    p = tmp_path / "ov.csv"
    p.write_text("SHOWTYPE,TMSID,SERIESTMSID,mfsid,sourceProgramId,TITLE\n"
                 "8,MV0000000001,SH0000000042,7,100,Film\n"
                 "5,EP0000000002,SHxxxxxxxxxx,8,101,Episode\n"
                 "5,SH0000000003,SH9999999999,9,102,Series\n"
                 "1,MV0000000004,SH0000000001,-1,103,Other\n")
    csv = fl.read_csv(spark, str(p))
    assert dict(csv.dtypes)["SHOWTYPE"] == "int" and dict(csv.dtypes)["mfsid"] == "int"
    r = {x.rovi_id: x for x in ov.content_overlays(csv).collect()}
    assert r[100].resource_type == "movie_overlay" and r[100].coll_tmsid == 42
    assert r[100].cl_numeric == (313 << 40) | 42 and r[100].ct_numeric == (320 << 40) | 7
    assert r[101].resource_type == "episode_overlay" and r[101].coll_tmsid is None and r[101].cl_numeric is None
    assert r[102].resource_type == "series_overlay" and r[102].coll_tmsid is None   # overflows int
    assert r[103].resource_type is None and r[103].ct_numeric == -1


def test_json_typed(spark, tmp_path):
    p = tmp_path / "z.json"
    p.write_text('{"_id": "01001", "city": "AGAWAM", "loc": [-72.6, 42.07], "pop": 15338, "state": "MA"}\n')
    z = fl.read_json_typed(spark, str(p)).first()
    assert (z.zip, z.pop, z.loc) == ("01001", 15338, [-72.6, 42.07])


def test_movies_latin1_and_trailing_bar(spark, tmp_path):
    p = tmp_path / "movies.dat"
    p.write_bytes("1::Crème fraîche (1999)::Comedy|\n2::Toy Story (1995)::Animation|Children's\n".encode("latin-1"))
    m = {r.id: r for r in ml.read_movies(spark, str(p)).collect()}
    assert m[1].title == "Crème fraîche (1999)" and m[1].genres == ["Comedy"]
    assert m[2].genres == ["Animation", "Children's"]


def test_ratings_field_count_modes(spark, lines):
    good = lines("1::2::3.5::978300760")
    r = ml.parse_ratings(good).first()
    assert (r.user_id, r.movie_id, r.rating) == (1, 2, 3.5)
    bad = lines("1::2::3.5::978300760", "1::2::3")
    assert ml.parse_ratings(bad, mode="drop").count() == 1
    with pytest.raises(Exception):
        ml.parse_ratings(bad, mode="fail").collect()


def test_count_lines_modes(spark, lines):
    assert cn.parse_count_lines(lines("A - 1", "B - x", "C")).filter(F.lit(False)).count() == 0
    assert cn.parse_count_lines(lines("A - 1", "B - x", "C"), mode="drop").count() == 1
    with pytest.raises(Exception):
        cn.parse_count_lines(lines("A - 1", "C")).collect()


def test_delimiter_conversion_quotes_commas(spark, tmp_path, lines):
    movies = ml.parse_movies(lines("1::American President, The (1995)::Comedy|Drama"))
    out = str(tmp_path / "csv")
    ml.movies_to_csv(movies, out)
    back = fl.read_csv(spark, out, schema="id int, title string, genres string").first()
    assert back.title == "American President, The (1995)" and back.genres == "Comedy|Drama"


def test_sinks_roundtrip(spark, tmp_path):
    from logledger import sinks
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    sinks.write_format(df, "parquet", str(tmp_path / "a"), mode="overwrite")
    sinks.write_format(df, "parquet", str(tmp_path / "a"), mode="append")
    assert spark.read.parquet(str(tmp_path / "a")).count() == 20
    sinks.save_table(df, "t_sink_test", path=str(tmp_path / "tbl"))
    sinks.cache_table(spark, "t_sink_test")
    assert fl.read_table(spark, "t_sink_test").count() == 10
    names = [r.name for r in sinks.list_tables(spark).collect()]
    assert "t_sink_test" in names
    assert sinks.coalesce_by_fraction(df.repartition(9), 2 / 3).rdd.getNumPartitions() == 6


def test_catalog_table_counts_skips_system_prefix(spark):
    spark.range(3).createOrReplaceTempView("cnt_alpha")
    spark.range(5).createOrReplaceTempView("system_hidden")
    got = {r.resource: r["count"] for r in cn.catalog_table_counts(spark).collect()}
    assert got["cnt_alpha"] == 3 and "system_hidden" not in got


def test_checkpoint_is_reliable(spark):
    from logledger import sinks
    c = sinks.checkpoint(spark.range(10_000).withColumn("k", F.col("id") % 100).filter("k < 3"))
    assert c.count() == 300


def test_drop_mode_drops_lines_whose_fields_are_no_numbers(spark, lines):
    text = lines("1::2::3.5::4", "a::2::3::4", "1::2::x::4", "1::2::3")
    assert [tuple(r) for r in ml.parse_ratings(text, mode="drop").collect()] == [(1, 2, 3.5)]
    movies = lines("1::T::A|B", "x::T::A")
    assert [r.id for r in ml.parse_movies(movies, mode="drop").collect()] == [1]


def test_zips_keep_keys_of_six_digits(spark):
    from logledger.sources import render as rd
    customer = spark.createDataFrame([(7, 0, "A", 1.0), (99_999, 0, "A", 1.0), (150_000, 0, "A", 1.0)],
                                     "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double")
    nation = spark.createDataFrame([(0, "N")], "n_nationkey int, n_name string")
    assert sorted(r._id for r in rd.zips_rows(customer, nation).collect()) == ["00007", "150000", "99999"]


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,b,a\n1,two,3\n")
    got = fl.read_csv(spark, str(tmp_path / "a.csv"), columns={"a": "int", "b": "string"})
    assert [tuple(r) for r in got.collect()] == [(3, "two")] and dict(got.dtypes)["a"] == "int"


def test_rendered_logs_have_a_line_per_row(spark):
    from logledger.queries import t
    from logledger.sources import render as rd
    from tests.conftest import SF_SMALL
    orders, items = t(spark, SF_SMALL, "orders"), t(spark, SF_SMALL, "lineitem")
    for side in ("control", "candidate"):
        assert rd.state_lines(orders, side).count() == orders.count()
        assert rd.resolver_detail_lines(items, side).count() == items.count()
    for env in ("control", "candidate", "third"):
        assert rd.priority_counts(orders, env).agg(F.sum("count")).first()[0] == orders.count()


def test_runs_replace_their_own_rows(spark, tmp_path):
    from logledger import sinks
    path = str(tmp_path / "runs")
    for _ in range(2):
        sinks.write_run(spark.range(5), "parquet", path, "a")
    sinks.write_run(spark.range(3), "parquet", path, "b")
    sinks.write_run(spark.range(2), "parquet", path, "b")
    sinks.write_run(spark.range(0), "parquet", path, "a")       # nothing to write leaves the earlier copy
    back = fl.read_format(spark, "parquet", path)
    assert sorted((r.run, r["count"]) for r in back.groupBy("run").count().collect()) == [("a", 5), ("b", 2)]
