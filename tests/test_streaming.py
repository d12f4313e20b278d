"""The streaming drift report equals the batch report on the same files."""

from logledger.plans.reconcile import resolver_drift
from logledger.queries import t
from logledger.sources import render as rd
from logledger.streaming.drift import KEEP, drift_stream, read_report, start_drift_to_table
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark, tmp_path):
    li = t(spark, SF_SMALL, "lineitem")
    cdir, ddir, out = str(tmp_path / "c"), str(tmp_path / "d"), str(tmp_path / "out")
    rd.resolver_drift_lines(li, "control").repartition(6).write.text(cdir)
    rd.resolver_drift_lines(li, "candidate").repartition(2).write.text(ddir)
    shared = (rd.RESOLVER_PUB_BASE, None)
    q = start_drift_to_table(drift_stream(spark, cdir, ddir, shared, max_files_per_trigger=1), out,
                             checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in read_report(spark, out).collect())
    want = sorted(tuple(r) for r in resolver_drift(spark.read.text(cdir), spark.read.text(ddir), shared).collect())
    assert got == want and len(got) == 6
    kept = sorted(int(f.name.partition("=")[2]) for f in (tmp_path / "out").glob("trigger=*"))
    assert len(kept) == KEEP and kept[-1] >= KEEP          # earlier reports are gone


def test_stream_resumes_from_checkpoint(spark, tmp_path):
    """A second run reads only the files added since the first and the report
    then equals the batch report over all files."""
    li = t(spark, SF_SMALL, "lineitem")
    half1, half2 = li.filter("l_orderkey % 2 = 0"), li.filter("l_orderkey % 2 = 1")
    cdir, ddir, out, ck = (str(tmp_path / x) for x in ("c", "d", "out", "ck"))
    rd.resolver_drift_lines(half1, "control").write.text(cdir + "/p1")
    rd.resolver_drift_lines(half1, "candidate").write.text(ddir + "/p1")
    shared = (rd.RESOLVER_PUB_BASE, None)

    def run():
        stream = drift_stream(spark, cdir + "/*", ddir + "/*", shared)
        start_drift_to_table(stream, out, checkpoint=ck).awaitTermination(300)
        return sorted(tuple(r) for r in read_report(spark, out).collect())

    first = run()
    rd.resolver_drift_lines(half2, "control").write.text(cdir + "/p2")
    rd.resolver_drift_lines(half2, "candidate").write.text(ddir + "/p2")
    second = run()
    want = sorted(tuple(r) for r in resolver_drift(spark.read.text(cdir + "/*"), spark.read.text(ddir + "/*"),
                                                   shared).collect())
    assert first != second and second == want
