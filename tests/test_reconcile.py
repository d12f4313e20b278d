"""Invariants of the reconciliation reports and a round trip through rendered lines."""

from pyspark.sql import functions as F

from logledger.operators.extract import extract_resolver_raw, extract_states
from logledger.plans import reconcile as rc
from logledger.queries import STATE_CANDIDATE_RANGE, STATE_CONTROL_RANGE, t
from logledger.sources import render as rd
from tests.conftest import SF_SMALL


def _state_logs(spark):
    o = t(spark, SF_SMALL, "orders")
    return rd.state_lines(o, "control"), rd.state_lines(o, "candidate")


def test_crosstab_sums_agree_across_groupings(spark):
    c, d = _state_logs(spark)
    totals = {}
    for by in ("state", "resource", "resource_state", "state_resource"):
        r = rc.state_crosstab(c, d, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE, by).agg(
            F.sum("control_sum"), F.sum("candidate_sum")).first()
        totals[by] = tuple(r)
    n_c = rc.states_in_range(c, "control", STATE_CONTROL_RANGE).count()
    n_d = rc.states_in_range(d, "candidate", STATE_CANDIDATE_RANGE).count()
    assert set(totals.values()) == {(n_c, n_d)}


def test_grouping_sets_equal_separate_groupings(spark):
    c, d = _state_logs(spark)
    allg = rc.state_crosstab_all(c, d, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE)
    for level, keys in (("state", ["state"]), ("resource", ["resource"]),
                        ("resource_state", ["resource", "state"])):
        one = rc.state_crosstab(c, d, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE, level)
        got = allg.filter(F.col("grouping") == level).select(*keys, "control_sum", "candidate_sum")
        assert sorted(got.collect()) == sorted(one.collect())


def test_count_mode_totals_equal_row_counts(spark):
    li = t(spark, SF_SMALL, "lineitem")
    c, d = rd.resolver_detail_lines(li, "control"), rd.resolver_detail_lines(li, "candidate")
    rep = rc.resolver_drift(c, d, (0, None), count_only=True)
    s = rep.agg(F.sum("control_sum"), F.sum("candidate_sum")).first()
    assert tuple(s) == (extract_resolver_raw(c).count(), extract_resolver_raw(d, "candidate").count())


def test_state_round_trip(spark):
    """Rendered lines extract back to the rows they came from (listeners 10+ dropped)."""
    o = t(spark, SF_SMALL, "orders")
    got = extract_states(rd.state_lines(o, "control"), "control").select("rovi_id", "pub_id")
    want = (o.filter((F.col("o_orderkey") % 17 != 0) & (F.col("o_custkey") % 12 < 10))
            .select(F.col("o_orderkey").alias("rovi_id"),
                    (F.col("o_orderkey") + rd.STATE_PUB_BASE).alias("pub_id")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_sided_keys_equals_full_outer_join(spark):
    """The two-anti-join form gives the rows of the full-outer-join form."""
    li = t(spark, SF_SMALL, "lineitem")
    c, d = rd.resolver_detail_lines(li, "control"), rd.resolver_detail_lines(li, "candidate")
    res = ["ResAF", "ResNO"]
    ours = rc.one_sided_keys(c, d, 0, -1, "update", res)
    keys = ["resource", "rovi_id", "state"]

    def side(lines, dialect, p):
        return (extract_resolver_raw(lines, dialect, res).filter(F.col("state") == "update")
                .select(*keys, F.col("pub_id").alias(f"{p}_pub_id"), F.col("dirty_size").alias(f"{p}_dirty_size")))
    fo = side(c, "control", "control").join(side(d, "candidate", "candidate"), keys, "full_outer").filter(
        F.col("control_dirty_size").isNull() | F.col("candidate_dirty_size").isNull()).select(*ours.columns)
    assert ours.count() > 0
    assert ours.exceptAll(fo).count() == 0 and fo.exceptAll(ours).count() == 0


def test_top_n_per_group_bounds(spark):
    li = t(spark, SF_SMALL, "lineitem")
    c, d = rd.resolver_detail_lines(li, "control"), rd.resolver_detail_lines(li, "candidate")
    r = rc.matched_differences(c, d, 0, None, ["ResAF", "ResNO", "ResRF"], n=5)
    per = {row[0]: row[1] for row in r.groupBy("resource").count().collect()}
    assert per and all(v <= 5 for v in per.values())


def test_count_compare_keeps_candidate_only_resources(spark, lines):
    from logledger.sources.counts import parse_count_lines
    c = parse_count_lines(lines("A - 5", "B - 7", "C - 1"))
    d = parse_count_lines(lines("A - 6", "B - 7", "D - 1"))
    r = {x.resource: (x.control_count, x.candidate_count, x.difference) for x in rc.count_compare(c, d).collect()}
    assert r == {"A": (5, 6, "      +1"), "B": (7, 7, "      +0"), "D": (None, 1, "      +1")}


def test_count_totals_excludes_prefixes(spark, lines):
    from logledger.sources.counts import parse_count_lines
    c = parse_count_lines(lines("Asset - 5", "MXThing - 100", "PublishedX - 3"))
    d = parse_count_lines(lines("Asset - 8", "MXThing - 1"))
    r = rc.count_totals(c, d).first()
    assert (r.control_total, r.candidate_total, r.diff) == (5, 8, 3)


def test_size_compare_is_outer(spark, lines):
    from logledger.sources.counts import parse_count_lines
    envs = {"a": parse_count_lines(lines("X - 1", "Y - 2")), "b": parse_count_lines(lines("Y - 3")),
            "c": parse_count_lines(lines("Z - 4"))}
    r = {x.resource: tuple(x)[1:] for x in rc.size_compare(envs).collect()}
    assert r == {"X": (1, None, None), "Y": (2, 3, None), "Z": (None, None, 4)}


def test_totals_rows_are_parsed_counts(spark):
    li = t(spark, SF_SMALL, "lineitem")
    c, d = rd.resolver_detail_lines(li, "control"), rd.resolver_detail_lines(li, "candidate")
    rep = {r.resource: r for r in rc.resolver_drift(c, d, (0, None), count_only=True, totals=True).collect()}
    tot = rep.pop(rc.TOTAL)
    assert (tot.control_sum, tot.candidate_sum) == (extract_resolver_raw(c).count(),
                                                    extract_resolver_raw(d, "candidate").count())
    assert tot.control_sum == sum(r.control_sum for r in rep.values())
    sc, sd = _state_logs(spark)
    g = rc.state_crosstab_all(sc, sd, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE, totals=True)
    row = g.filter(F.col("grouping") == "total").first()
    assert (row.control_sum, row.candidate_sum) == (
        rc.states_in_range(sc, "control", STATE_CONTROL_RANGE).count(),
        rc.states_in_range(sd, "candidate", STATE_CANDIDATE_RANGE).count())
