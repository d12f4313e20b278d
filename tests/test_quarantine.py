"""Lines that don't parse are kept with file and reason; accepted and refused lines are counted in the report's pass."""

import pytest

from logledger.operators.extract import extract_states
from logledger.operators.observe import observed
from logledger.plans import reconcile as rc
from logledger.sources import quarantine as qr

CASES = {
    "ratings": (qr.judge_ratings, qr.RATING_COLUMNS,
                {"1::2::3.5::4": (1, 2, 3.5), "1::2::3::x::y": "not 4 fields", "1::2::3": "not 4 fields", "": "not 4 fields",
                 "a::2::3::4": "user_id is no int", "1::99999999999::3::4": "movie_id is no int", "1::2::x::4": "rating is no float",
                 "1::2::4::5::::": (1, 2, 4.0)}),
    "movies": (qr.judge_movies, qr.MOVIE_COLUMNS,
               {"7::T::A|B": (7, "T", ["A", "B"]), "7::T::A|": (7, "T", ["A"]), "7::T": "not 3 fields", "x::T::A": "id is no int"}),
    "counts": (qr.judge_counts, qr.COUNT_COLUMNS,
               {"Asset - 5": ("Asset", 5), "Asset-5": "not 2 fields", "A - 5 - 6": "not 2 fields", "A - ": "count is no bigint"}),
}


@pytest.mark.parametrize("kind", CASES)
def test_good_and_quarantined_are_all_lines(spark, tmp_path, kind):
    judge, columns, cases = CASES[kind]
    for i, part in enumerate((list(cases)[::2], list(cases)[1::2])):
        spark.createDataFrame([(x,) for x in part], "value string").write.text(f"{tmp_path}/in/{i}")
    lines = qr.read_lines_with_file(spark, f"{tmp_path}/in/*")
    qr.land_judged(judge(lines), f"{tmp_path}/out")
    good = sorted(map(tuple, qr.read_good(spark, f"{tmp_path}/out", columns).collect()))
    bad = {r.line: (r.reason, r.file) for r in qr.read_quarantined(spark, f"{tmp_path}/out").collect()}
    assert good == sorted(v for v in cases.values() if isinstance(v, tuple))
    assert {k: v[0] for k, v in bad.items()} == {k: v for k, v in cases.items() if isinstance(v, str)}
    for line, (_, file) in bad.items():
        assert f"/in/{list(cases).index(line) % 2}/part-" in file
    assert len(good) + len(bad) == lines.count() == len(cases)


def test_null_lines_and_none_at_all(spark, tmp_path):
    lines = spark.createDataFrame([(None, "f"), ("1::2::3::4", "f")], "value string, file string")
    qr.land_judged(qr.judge_ratings(lines), f"{tmp_path}/a")
    assert [tuple(r) for r in qr.read_quarantined(spark, f"{tmp_path}/a").collect()] == [(None, "f", "not 4 fields")]
    qr.land_judged(qr.judge_ratings(lines.limit(0)), f"{tmp_path}/b")
    assert qr.read_good(spark, f"{tmp_path}/b", qr.RATING_COLUMNS).count() == qr.read_quarantined(spark, f"{tmp_path}/b").count() == 0


def test_line_counts_come_from_the_report(spark, lines):
    c = lines("x [listener-1] - PUBLISH A 1 (10) y", "x [listener-1] - PUBLISH A 2 (20) y", "other", None)
    d = lines("x [listener-1] - PUBLISH A-1 (10) y", "x [listener-10] - PUBLISH A-2 (20) y")
    (rows_c, counts_c), (rows_d, counts_d) = (observed(x, lambda v, s=s: extract_states(v, s)) for x, s in (
        (c, "control"), (d, "candidate")))
    report = rc.state_crosstab(rows_c, rows_d, (15, None), None).collect()
    assert [tuple(r) for r in report] == [("A", "PUBLISH", 1, 1)]
    assert counts_c.get() == {"lines": 4, "accepted": 2, "refused": 2}
    assert counts_d.get() == {"lines": 2, "accepted": 1, "refused": 1}


def test_line_counts_of_an_empty_log(spark, lines):
    rows, counts = observed(lines("x").limit(0), extract_states)
    assert rows.count() == 0 and counts.get() == {"lines": 0, "accepted": 0, "refused": 0}
