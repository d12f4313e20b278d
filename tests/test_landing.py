"""Reports over landed (parquet) rows equal the reports over raw lines."""


import contextlib
import glob
import io
import uuid

from pyspark.sql import functions as F

from logledger.plans import reconcile as rc
from logledger.queries import t
from logledger.sources import landing as ld
from logledger.sources import render as rd
from tests.conftest import SF_SMALL


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_resolver_reports_on_landed_rows(spark, tmp_path):
    li = t(spark, SF_SMALL, "lineitem")
    c, d = rd.resolver_detail_lines(li, "control"), rd.resolver_detail_lines(li, "candidate")
    ld.land_resolver(c, "control", str(tmp_path / "c"))
    ld.land_resolver(d, "candidate", str(tmp_path / "d"))
    lc, lcand = ld.read_landed(spark, str(tmp_path / "c")), ld.read_landed(spark, str(tmp_path / "d"))
    res = ["ResAF", "ResNO"]
    assert _same(rc.resolver_drift(c, d, (0, None)), rc.resolver_drift(lc, lcand, (0, None)))
    assert _same(rc.resolver_drift(c, d, (0, None), count_only=True),
                 rc.resolver_drift(lc, lcand, (0, None), count_only=True))
    assert _same(rc.matched_differences(c, d, 0, None, res, 5), rc.matched_differences(lc, lcand, 0, None, res, 5))
    assert _same(rc.one_sided_keys(c, d, 0, -1, "update", res), rc.one_sided_keys(lc, lcand, 0, -1, "update", res))
    # the resource list reaches the scan as a partition filter
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rc.matched_differences(lc, lcand, 0, None, res, 5).explain()
    import re
    assert re.search(r"PartitionFilters: \[resource#\d+ IN \(ResAF,ResNO\)", buf.getvalue())
    assert "GreaterThanOrEqual(pub_id,0)" in buf.getvalue()


def test_state_reports_on_landed_rows(spark, tmp_path):
    o = t(spark, SF_SMALL, "orders")
    c, d = rd.state_lines(o, "control"), rd.state_lines(o, "candidate")
    ld.land_states(c, "control", str(tmp_path / "c"))
    ld.land_states(d, "candidate", str(tmp_path / "d"))
    lc, lcand = ld.read_landed(spark, str(tmp_path / "c"), ld.STATE_SCHEMA), ld.read_landed(spark, str(tmp_path / "d"), ld.STATE_SCHEMA)
    assert _same(rc.state_crosstab_all(c, d, (0, None), (25000000100, None)),
                 rc.state_crosstab_all(lc, lcand, (0, None), (25000000100, None)))


def test_numeric_resource_names_stay_text(spark, tmp_path, lines):
    log = lines("x RESOLVE 007 5 (9 replacing empty) , 3 dirty", "x RESOLVE 08 5 (9 replacing empty) , 4 dirty")
    ld.land_resolver(log, "control", str(tmp_path / "n"))
    back = ld.read_landed(spark, str(tmp_path / "n"))
    raw = rc.resolver_drift(log, log.limit(0), (0, None))
    assert sorted(r.resource for r in back.collect()) == ["007", "08"]
    assert sorted(r.resource for r in rc.resolver_drift(back, back.limit(0), (0, None)).collect()) == sorted(
        r.resource for r in raw.collect())


@contextlib.contextmanager
def conf(spark, **values):
    values = {"spark.sql.adaptive." + k: v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _files(path):
    return {f.rpartition("=")[2]: len(glob.glob(f"{f}/*.parquet")) for f in glob.glob(f"{path}/resource=*")}


def _hot_log(spark):
    """Six in seven lines are of one resource."""
    resource = F.when(F.col("id") % 7 == 0, F.concat(F.lit("Res"), (F.col("id") % 5).cast("string"))).otherwise("ResHot")
    rest = F.concat(F.lit(" "), "id", F.lit(" ("), F.col("id") * 7919, F.lit(" replacing empty) , "), F.col("id") % 50, F.lit(" dirty"))
    return spark.range(0, 70_000, 1, 12).select(F.concat(F.lit("RESOLVE "), resource, rest).alias("value"))


def test_files_follow_bytes(spark, tmp_path):
    log = _hot_log(spark)
    with conf(spark, advisoryPartitionSizeInBytes="128m"):
        ld.land_resolver(log, "control", str(tmp_path / "few"))
    assert set(_files(tmp_path / "few").values()) == {1}
    with conf(spark, advisoryPartitionSizeInBytes="256k"):
        ld.land_resolver(log, "control", str(tmp_path / "many"))
    files = _files(tmp_path / "many")
    assert files["ResHot"] >= 4 and max(n for r, n in files.items() if r != "ResHot") <= 2
    assert ld.read_landed(spark, str(tmp_path / "many")).exceptAll(ld.read_landed(spark, str(tmp_path / "few"))).isEmpty()
    assert ld.read_landed(spark, str(tmp_path / "many")).count() == 70_000
    counts = [r["count"] for r in ld.read_landed(spark, str(tmp_path / "many")).filter("resource = 'ResHot'").groupBy(
        F.input_file_name()).count().collect()]
    assert max(counts) < 30_000                    # no task wrote the hot resource alone


def test_bucketed_tables_match_as_raw_lines(spark):
    li = t(spark, SF_SMALL, "lineitem")
    c, d = rd.resolver_detail_lines(li, "control"), rd.resolver_detail_lines(li, "candidate")
    names = [f"landed_{uuid.uuid4().hex}" for _ in range(2)]
    for log, dialect, name in ((c, "control", names[0]), (d, "candidate", names[1])):
        ld.land_resolver_table(log, dialect, name, buckets=5)
    tables = [spark.table(n) for n in names]
    assert _same(rc.matched_differences(c, d, 0, None, ["ResAF", "ResNO"], 5),
                 rc.matched_differences(*tables, 0, None, ["ResAF", "ResNO"], 5, bucketed=True))
    assert _same(rc.one_sided_keys(c, d, 0, -1, "update", ["ResAF"]), rc.one_sided_keys(*tables, 0, -1, "update", ["ResAF"]))
    for n in names:
        spark.sql(f"DROP TABLE {n}")
