"""Property tests: the column rules against plain-Python statements of them."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logledger.functions import drift_flag, signed_text
from logledger.functions.text import split_drop_trailing_empty


def py_signed(d: int) -> str:
    s = f"{'-' if d < 0 else '+'}{abs(d):,}"
    return s.rjust(8)


def py_flag(c: int, x: int) -> str:
    d = x - c
    if c <= 1000:
        return ""
    r = abs(d) / c
    if d < 0:
        return "==" if r > 0.25 else "=" if r > 0.125 else ""
    return "++" if r > 0.25 else "+" if r > 0.125 else ""


longs = st.integers(min_value=-(2**62), max_value=2**62)


@settings(max_examples=1, deadline=None)
@given(st.lists(longs, min_size=200, max_size=200))
def test_signed_text_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d long")
    got = [r[0] for r in df.select(signed_text("d")).collect()]
    assert got == [py_signed(v) for v in values]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**7), st.integers(0, 10**7)), min_size=300, max_size=300))
def test_flag_matches_python(spark, pairs):
    pairs = pairs + [(8000, 9000), (8000, 10000), (8000, 7000), (8000, 6000), (1000, 5000), (1001, 5000)]
    df = spark.createDataFrame(pairs, "c long, x long")
    got = [r[0] for r in df.select(drift_flag(F.col("c"), F.col("x") - F.col("c"))).collect()]
    assert got == [py_flag(c, x) for c, x in pairs]


def py_split(s: str, sep: str) -> list[str]:
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="ab|", max_size=8), min_size=100, max_size=100))
def test_split_matches_java_semantics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(split_drop_trailing_empty("s", r"\|")).collect()]
    assert got == [py_split(v, "|") for v in values]


word = st.text(alphabet="abcXYZ_019", min_size=1, max_size=12)
digits = st.integers(min_value=0, max_value=10**15)
record = st.tuples(word, digits, digits, st.one_of(st.just("empty"), digits.map(str)),
                   st.integers(0, 10**6), st.text(alphabet="ab :[]-", max_size=10))


@settings(max_examples=1, deadline=None)
@given(st.lists(record, min_size=200, max_size=200))
def test_resolver_lines_round_trip(spark, recs):
    from logledger.operators.extract import extract_resolver_raw
    for side, sep in (("control", " "), ("candidate", "-")):
        lines = [f"{noise}INFO [listener-3] - RESOLVE {r}{sep}{i} ({p} replacing {o}) , {d} dirty size: 1b"
                 for r, i, p, o, d, noise in recs]
        lines += ["INFO poll only", f"RESOLVE broken{sep}1 (2 replacing) , 3 dirty"]     # must be dropped
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        got = sorted(tuple(x) for x in extract_resolver_raw(df, side).collect())
        want = sorted((r, i, p, o, "new" if o == "empty" else "update", d) for r, i, p, o, d, _ in recs)
        assert got == want


state_rec = st.tuples(st.integers(0, 29), st.sampled_from(["PUBLISH", "NOPUBLISH", "UNPUBLISH"]), word,
                      digits, digits)


@settings(max_examples=1, deadline=None)
@given(st.lists(state_rec, min_size=200, max_size=200))
def test_state_lines_round_trip_and_listener_rule(spark, recs):
    from logledger.operators.extract import extract_states
    for side, sep in (("control", " "), ("candidate", "-")):
        lines = [f"2017-01-31 [listener-{n}] - {s} {r}{sep}{i} ({p}) - (root only)" for n, s, r, i, p in recs]
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        got = sorted(tuple(x) for x in extract_states(df, side).collect())
        want = sorted((i, r, s, p) for n, s, r, i, p in recs if n < 10)      # one-digit listeners only
        assert got == want


access_rec = st.tuples(
    st.datetimes(min_value=__import__("datetime").datetime(1990, 1, 1),
                 max_value=__import__("datetime").datetime(2030, 12, 31)).map(lambda d: d.replace(microsecond=0)),
    st.integers(-12, 14), st.sampled_from([0, 30, 45]), st.sampled_from(["GET", "POST"]),
    st.text(alphabet="abc/?=&._", min_size=1, max_size=15), st.integers(100, 599), st.integers(0, 10**12))


@settings(max_examples=1, deadline=None)
@given(st.lists(access_rec, min_size=200, max_size=200))
def test_access_lines_time_and_fields(spark, recs):
    import datetime as dtm
    from logledger.plans.reports import access_records
    lines, want = [], []
    for local, hh, mm, method, endpoint, status, size in recs:
        sign = "-" if hh < 0 else "+"
        off = f"{sign}{abs(hh):02d}{mm:02d}"
        stamp = local.strftime("%d/%b/%Y:%H:%M:%S")
        lines.append(f'10.1.2.3 - - [{stamp} {off}] "{method} /{endpoint} HTTP/1.1" {status} {size}')
        delta = dtm.timedelta(hours=abs(hh), minutes=mm) * (-1 if sign == "-" else 1)
        want.append(("/" + endpoint, local - delta, status, size))
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted((r.endpoint, r.dt, r.response_code, r.content_size) for r in access_records(df).collect())
    assert got == sorted(want)


def py_packed(kind: str, key: int) -> int:
    code = {"st": 523, "cl": 313}.get(kind, 320)
    v = (code << 40) | (key & 0xFFFFFFFFFFFFFFFF if key < 0 else key)     # sign-extended key
    return v - (1 << 64) if v >= (1 << 63) else v


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(-(2**31), 2**31 - 1), min_size=200, max_size=200))
def test_packed_id_matches_python(spark, keys):
    from logledger.functions.ids import packed_id
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = df.select(packed_id("st", "k"), packed_id("cl", "k"), packed_id("ct", "k")).collect()
    assert [tuple(r) for r in got] == [(py_packed("st", k), py_packed("cl", k), py_packed("ct", k)) for k in keys]
