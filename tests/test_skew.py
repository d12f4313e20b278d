"""A resource holding most of the lines: reports stay whole and exact."""

from pyspark.sql import functions as F

from logledger.operators.extract import extract_resolver_raw
from logledger.plans import reconcile as rc


def _lines(spark, side: str):
    sep = " " if side == "control" else "-"
    n = 30_000
    # two thirds of all lines belong to ResHot; sizes differ on the candidate side
    df = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.lit("ResHot")).otherwise(F.concat(F.lit("Res"), (F.col("id") % 7).cast("string")))
        .alias("r"), F.col("id"))
    dirty = F.col("id") % 50 if side == "control" else (F.col("id") * 7) % 53
    return df.select(F.concat(F.lit("INFO [listener-1] - RESOLVE "), F.col("r"), F.lit(sep), F.col("id").cast("string"),
                              F.lit(" ("), (F.col("id") + 10_000).cast("string"), F.lit(" replacing empty) , "),
                              dirty.cast("string"), F.lit(" dirty")).alias("value"))


def test_hot_resource_top_n_and_totals(spark):
    c, d = _lines(spark, "control"), _lines(spark, "candidate")
    top = rc.matched_differences(c, d, 0, None, ["ResHot", "Res1"], n=25).toPandas()
    assert set(top.groupby("resource").size()) == {25}
    # brute force with pandas on the same extracted rows
    a = extract_resolver_raw(c, "control", ["ResHot", "Res1"]).toPandas()
    b = extract_resolver_raw(d, "candidate", ["ResHot", "Res1"]).toPandas()
    j = a.merge(b, on=["pub_id", "resource", "rovi_id", "old_pub_id"], suffixes=("_c", "_d"))
    j["ad"] = (j["dirty_size_d"] - j["dirty_size_c"]).abs()
    want = (j.sort_values(["resource", "ad", "rovi_id"], ascending=[True, False, True])
            .groupby("resource").head(25))
    assert sorted(zip(top.resource, top.rovi_id)) == sorted(zip(want.resource, want.rovi_id))
    drift = {r.resource: (r.control_sum, r.candidate_sum)
             for r in rc.resolver_drift(c, d, (0, None), totals=True).collect()}
    assert drift[rc.TOTAL] == (int(sum(i % 50 for i in range(30_000))), int(sum((i * 7) % 53 for i in range(30_000))))
    assert drift["ResHot"][0] == int(sum(i % 50 for i in range(30_000) if i % 3 != 0))


def test_one_sided_hot_key_is_split(spark):
    """A third of the control rows have one key: no task of the join holds them all."""
    n = 60_000
    rows = spark.range(0, n, 1, 12).select(
        F.lit("ResHot").alias("resource"), F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("rovi_id"),
        F.xxhash64("id").alias("pub_id"), F.lit("empty").alias("old_pub_id"), F.lit("new").alias("state"),
        F.xxhash64("id", F.lit(1)).alias("dirty_size")).checkpoint()
    other = rows.filter("rovi_id % 2 = 0 and rovi_id <> -7")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = rc.one_sided_keys(rows, other, None, None, "new", ["ResHot"])
        placed = got.withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    one_sided = sum(1 for i in range(n) if i % 3 == 0 or i % 2 == 1)
    per_task, in_tasks = placed.groupby("task").size(), placed[placed.rovi_id == -7].groupby("task").size()
    assert per_task.sum() == one_sided and in_tasks.sum() == n // 3
    assert len(in_tasks) >= 4 and max(in_tasks) < n // 3 // 2 and max(per_task) < one_sided // 2


def test_one_sided_keys_with_nulls_and_repeats(spark, lines):
    c = lines("RESOLVE A 1 (1 replacing empty) , 3 dirty", "RESOLVE A 1 (2 replacing empty) , 4 dirty",
              "RESOLVE A 2 (3 replacing empty) , 5 dirty", "RESOLVE A 99999999999999999999 (4 replacing empty) , 6 dirty")
    d = lines("RESOLVE A-1 (5 replacing empty) , 3 dirty", "RESOLVE A-3 (6 replacing empty) , 7 dirty",
              "RESOLVE A-3 (7 replacing empty) , 8 dirty")
    got = sorted(((r.rovi_id, r.control_pub_id, r.candidate_pub_id) for r in rc.one_sided_keys(c, d, None, None, "new", ["A"]).collect()),
                 key=repr)
    assert got == sorted([(2, 3, None), (3, None, 6), (3, None, 7), (None, 4, None)], key=repr)


def test_hot_values_and_join(spark):
    """A hot value is spread, its rows of the other side replicated, and all others are shipped once."""
    from logledger.operators.joins import hot_join, hot_values
    big = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 10 == 1, 9).when(F.col("id") % 10 == 3, None).otherwise(
            F.col("id")).alias("size"), "id")
    other = spark.createDataFrame([(k, f"v{k}") for k in [*range(0, 300, 3), 5, 5, 9, 5 * 10**9]] + [(None, "n")], "price long, v string")
    assert hot_values(big, "size", 0.05) == {5: 12, 9: 3}     # of 36,000 rows that have a size: 20,001 and 4,001
    assert hot_values(big.limit(0), "size", 0.05) == {} and hot_values(big.filter("size is null"), "size", 0.5) == {}
    for how in ("inner", "left"):
        got = hot_join(big, other, "size", "price", 0.05, how)
        want = big.join(other, big["size"] == other["price"], how)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert sorted(map(tuple, hot_join(big, other, "size", "price", 0.9).collect())) == sorted(
        map(tuple, big.join(other, big["size"] == other["price"]).collect()))
    # with the broadcast join off, the pairs of the hot value come from several tasks
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = {r["p"]: r["count"] for r in hot_join(big, other, "size", "price", 0.05).filter("size = 5").select(
            F.spark_partition_id().alias("p")).groupBy("p").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(tasks.values()) == 40_002 and len(tasks) >= 4 and max(tasks.values()) <= 20_000


def test_salted_joins_are_never_broadcast(spark):
    """The planner takes the replicated side for as small as its source: a broadcast would hold every replica."""
    from logledger.operators.joins import hot_join, salted_join
    big = spark.range(2_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("size"), "id")
    other = spark.createDataFrame([(k, f"v{k}") for k in [7, 7, 9, 11]] + [(None, "n")], "price long, v string")
    for how in ("inner", "left"):
        want = sorted(map(tuple, big.join(other, big["size"] == other["price"], how).collect()), key=repr)
        for join in (lambda: salted_join(big, other, "size", "price", 64, how), lambda: hot_join(big, other, "size", "price", 0.1, how)):
            found = join()
            assert sorted(map(tuple, found.collect()), key=repr) == want
            assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
