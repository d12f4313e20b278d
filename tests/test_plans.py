"""Physical-plan properties the reports rely on at scale (via explain output)."""

import contextlib
import io
import re

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_top_n_per_group_limits_before_shuffle(spark):
    p = plan(E.queries()["matched_diff_topn"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 2          # partial (map side) + final


def test_drift_is_partial_aggregate_over_pruned_scans(spark):
    p = plan(E.queries()["resolver_drift"](spark, SF_SMALL))
    assert "partial_sum" in p
    assert "Join" not in p                           # sides meet in a union, not a join
    assert "l_extendedprice" not in p and "l_shipdate" not in p
    assert p.count("regexp_replace(") == 2           # one regex evaluation per side


def test_topk_is_take_ordered_with_pushed_filter(spark):
    p = plan(E.queries()["topk_count_ge60"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert "IsNotNull(value), GreaterThanOrEqual(value,60.0)]" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_crosstab_groupings_share_one_aggregate(spark):
    p = plan(E.queries()["state_crosstab"](spark, SF_SMALL))
    nodes = re.findall(r"^\(\d+\) (\w+)", p, re.M)
    assert "Expand" in nodes and nodes.count("HashAggregate") == 2   # partial + final, once


def test_one_sided_joins_rows_to_partial_masks(spark):
    p = plan(E.queries()["one_sided_keys"](spark, SF_SMALL))
    assert "Window" not in p and "partial_bit_or" in p
    assert "Join type: Inner" in p                  # a join that AQE can split, or broadcast by its size
    assert "regexp_replace(" not in p               # the logs were scanned once, by the checkpoint


def test_bucketed_match_has_no_exchange_below_the_join(spark):
    p = plan(E.queries()["matched_diff_bucketed"](spark, SF_SMALL))
    tree = p[:p.index("\n(1) ")]
    join = next(i for i, line in enumerate(tree.splitlines()) if "SortMergeJoin" in line)
    assert "Exchange" not in "\n".join(tree.splitlines()[join:])
    assert p.count("Bucketed: true") == 2 and "In(resource" in p


def test_counts_come_from_footers(spark):
    for name, pushed in (("table_counts", "COUNT(*)"), ("table_nonnull_counts", "COUNT(l_orderkey)")):
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert f"PushedAggregation: [{pushed}]" in p and p.count("PushedAggregation: [COUNT(") == 14
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")   # the caller's session reads as before


def test_one_user_lookup_has_no_product(spark):
    from logledger.plans import recommend as rm
    from logledger.queries import ratings
    model = rm.als_estimator(rank=3, max_iter=1).fit(ratings(spark, SF_SMALL))
    user = model.userFactors.first()["id"]
    top = rm.recommend_one(model, user, 5)
    assert "Cartesian" not in plan(top) and "NestedLoop" not in plan(top)
    want = [r for r in rm.recommend_all(model, 5).filter(f"user_id = {user}").collect()]
    assert [r.movie_id for r in top.collect()] == [r.movie_id for r in sorted(want, key=lambda r: r["rank"])]
    assert rm.recommend_one(model, -5, 5).count() == 0


def test_top_n_needs_no_limit_on_n(spark):
    from logledger.operators.topk import top_n_per_group
    df = spark.range(20_000).selectExpr("id % 2 as g", "id * 7919 % 20011 as v")
    got = top_n_per_group(df, ["g"], ["v"], 1500).toPandas()
    want = df.toPandas().sort_values("v").groupby("g").head(1500)
    assert sorted(map(tuple, got[["g", "v"]].values.tolist())) == sorted(map(tuple, want[["g", "v"]].values.tolist()))
