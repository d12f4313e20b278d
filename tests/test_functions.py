"""Golden values of the column functions."""

from pyspark.sql import functions as F

from logledger.functions import drift_flag, log_time_to_utc, packed_id, signed_text
from logledger.functions.text import split_drop_trailing_empty


def test_signed_text_golden(spark):
    df = spark.createDataFrame([(0,), (2851,), (-103507,), (123456789,), (None,)], "d long")
    got = [r[0] for r in df.select(signed_text("d")).collect()]
    assert got == ["      +0", "  +2,851", "-103,507", "+123,456,789", None]


def test_flag_golden(spark):
    cases = [(603194, 761213, "++"), (156419, 52912, "=="), (7920, 6310, "="),
             (429918, 510894, "+"), (64638, 67489, ""), (43, 56, ""), (0, 0, "")]
    df = spark.createDataFrame([(c, x) for c, x, _ in cases], "c long, x long")
    got = [r[0] for r in df.select(drift_flag(F.col("c"), F.col("x") - F.col("c"))).collect()]
    assert got == [f for _, _, f in cases]


def test_flag_boundaries_are_strict(spark):
    # exactly 12.5 % and 25 % are not above the thresholds
    df = spark.createDataFrame([(8000, 9000), (8000, 10000), (8000, 7000), (8000, 6000)], "c long, x long")
    got = [r[0] for r in df.select(drift_flag(F.col("c"), F.col("x") - F.col("c"))).collect()]
    assert got == ["", "+", "", "="]


def test_packed_id(spark):
    df = spark.createDataFrame([(7,), (-1,), (None,)], "k int")
    r = df.select(packed_id("cl", "k").alias("cl"), packed_id("st", "k").alias("st"),
                  packed_id("ct", "k").alias("ct")).collect()
    assert r[0]["cl"] == 344147139493895
    assert r[0]["st"] == (523 << 40) | 7
    assert r[0]["ct"] == (320 << 40) | 7
    assert r[1]["cl"] == -1            # sign-extended key overwrites the type bits
    assert r[2]["cl"] is None


def test_access_time_is_zone_independent(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        df = spark.createDataFrame([("07/Mar/2004:16:05:49 -0800",), ("07/Mar/2004:16:05:49 +0530",),
                                    ("32/Foo/2004:16:05:49 +0530",)], "t string")
        got = [r[0] for r in df.select(log_time_to_utc("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2004, 3, 8, 0, 5, 49), dt.datetime(2004, 3, 7, 10, 35, 49), None]


def test_split_drops_only_trailing_empty(spark):
    df = spark.createDataFrame([("a|b|",), ("a||b",), ("a|b||",), ("x",)], "s string")
    got = [r[0] for r in df.select(split_drop_trailing_empty("s", r"\|")).collect()]
    assert got == [["a", "b"], ["a", "", "b"], ["a", "b"], ["x"]]


def test_zip_to_int_udf_from_sql(spark):
    from logledger.functions.udfs import register_zip_to_int
    register_zip_to_int(spark)
    texts = ["01001", "99950", "x1", "12.5", "12.0", "1e3", "99999999999", "2147483647", "-2147483648", "2147483648", "+7",
             " 42 ", "", "-", None]
    df = spark.createDataFrame([(x,) for x in texts], "zip string")
    df.createOrReplaceTempView("zip_udf_test")
    got = spark.sql("SELECT zip_to_int(zip) AS a, try_cast(zip AS INT) AS b FROM zip_udf_test").collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert [r.a for r in got][:4] == [1001, 99950, None, None]
