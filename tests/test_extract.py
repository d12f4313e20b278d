"""Extraction of the log layouts: sample lines, dialects, quirks kept on purpose."""

from pyspark.sql import functions as F

from logledger.operators.extract import (extract_access, extract_groups, extract_resolver_raw,
                                         extract_resolver_tagged, extract_states)

ACCESS = ('64.242.88.10 - - [07/Mar/2004:16:05:49 -0800] "GET /twiki/bin/edit/Main/Double_bounce_sender'
          '?topicparent=Main.ConfigurationVariables HTTP/1.1" 401 12846')


def test_access_sample_line(lines):
    r = extract_access(lines(ACCESS, "garbage line", ACCESS.replace("12846", "-"))).collect()
    assert len(r) == 1
    assert r[0]["ip_address"] == "64.242.88.10" and r[0]["date_time"] == "07/Mar/2004:16:05:49 -0800"
    assert r[0]["method"] == "GET" and r[0]["response_code"] == 401 and r[0]["content_size"] == 12846


def test_access_pattern_is_anchored(lines):
    assert extract_access(lines("x " + ACCESS)).count() == 0


def test_state_dialects_and_listener_digits(lines):
    ctl = lines("[listener-6] - NOPUBLISH MXNormalizedVideoWorkGrouping 907775007 (25639385494) - (root only)",
                "[listener-14] - PUBLISH series_credits 907775007 (25639385549) - x",
                "[listener-4] - PUBLISH series_credits-907775007 (25639385549) - x")
    r = extract_states(ctl, "control").collect()
    assert [(x.resource, x.state, x.rovi_id, x.pub_id) for x in r] == [
        ("MXNormalizedVideoWorkGrouping", "NOPUBLISH", 907775007, 25639385494)]
    assert extract_states(ctl, "control", listener_digits=2).count() == 1
    cand = extract_states(ctl, "candidate").collect()
    assert [(x.resource, x.rovi_id) for x in cand] == [("series_credits", 907775007)]


def test_resolver_samples(lines):
    df = lines(
        "INFO [listener-14] - RESOLVE Schedule 4554157995 (10946172201 replacing 10753465678) , 3 dirty size: 2024b",
        "INFO [listener-12] - RESOLVE MXNormalizedVideoWorkGrouping 4627609353 (26757872957 replacing empty) , 4 dirty",
        "INFO [listener-11] - RESOLVE CreativeWork-4135328300 (10998951460 replacing 10998951386) , 0 dirty [ x ]")
    r = extract_resolver_raw(df, "control").orderBy("pub_id").collect()
    assert [(x.resource, x.rovi_id, x.pub_id, x.old_pub_id, x.state, x.dirty_size) for x in r] == [
        ("Schedule", 4554157995, 10946172201, "10753465678", "update", 3),
        ("MXNormalizedVideoWorkGrouping", 4627609353, 26757872957, "empty", "new", 4)]
    c = extract_resolver_raw(df, "candidate").collect()
    assert [(x.resource, x.rovi_id, x.dirty_size) for x in c] == [("CreativeWork", 4135328300, 0)]


def test_resolver_resource_list_equals_exact_names(lines):
    df = lines("RESOLVE Asset 1 (10 replacing empty) , 5 dirty",
               "RESOLVE AssetX 2 (11 replacing empty) , 6 dirty",
               "RESOLVE Award 3 (12 replacing 9) , 7 dirty")
    got = sorted(r.resource for r in extract_resolver_raw(df, "control", ["Asset", "Award"]).collect())
    assert got == ["Asset", "Award"]


def test_tagged_measures(lines):
    df = lines("RESOLVE Asset 1 (10 replacing empty) , 5 dirty")
    a = extract_resolver_tagged(df, "control").first()
    b = extract_resolver_tagged(df, "control", count_only=True).first()
    assert (a.control_n, a.candidate_n, b.control_n) == (5, 0, 1)


def test_overflowing_digits_give_null(lines):
    df = lines("RESOLVE Asset 99999999999999999999999 (10 replacing empty) , 5 dirty")
    assert extract_resolver_raw(df, "control").first().rovi_id is None


def test_one_regex_pass_matches_rlike_extract(spark):
    """The single-pass rewrite keeps exactly the lines rlike accepts, with the
    same groups as regexp_extract (search semantics, first match)."""
    from logledger.operators.extract import RESOLVER_PATTERN
    pat = RESOLVER_PATTERN % (r"\w+", " ")
    vals = ["RESOLVE A 1 (2 replacing 3) , 4 dirty RESOLVE B 5 (6 replacing 7) , 8 dirty",
            "noise RESOLVE A 1 (2 replacing empty) , 4 dirty\ttail", "RESOLVE A 1 (2 replacing) , 4 dirty",
            "", "RESOLVE  A 1 (2 replacing 3) , 4 dirty", "x RESOLVE A 1 (2 replacing 3) , 4 dirty"]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    names = ["g1", "g2", "g3", "g4", "g5"]
    fast = sorted(tuple(r) for r in extract_groups(df, pat, names).collect())
    ref = df.filter(F.col("value").rlike(pat)).select(
        *[F.regexp_extract("value", pat, i + 1).alias(n) for i, n in enumerate(names)])
    assert fast == sorted(tuple(r) for r in ref.collect())
    assert len(fast) == 3


def test_second_resolution_on_a_line_counts_if_only_that_one_is_wanted(lines):
    log = lines("RESOLVE A 1 (2 replacing 3) , 4 dirty RESOLVE B 5 (6 replacing empty) , 7 dirty")
    got = extract_resolver_raw(log, "control", ["B"]).collect()
    assert [(r.resource, r.rovi_id, r.dirty_size, r.state) for r in got] == [("B", 5, 7, "new")]
    assert extract_resolver_raw(log, "control", ["C.*"]).count() == 0


def test_large_dirty_sizes_stay_in_the_sums(lines):
    import pytest
    from logledger.plans import reconcile as rc
    log = lines("RESOLVE A 1 (2 replacing 3) , 3000000000 dirty", "RESOLVE A 1 (2 replacing 3) , 5 dirty")
    assert rc.resolver_drift(log, log.limit(0), (0, None)).first().control_sum == 3_000_000_005
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|overflow"):
        extract_resolver_raw(lines("RESOLVE A 1 (2 replacing 3) , 99999999999999999999 dirty"), "control").collect()
