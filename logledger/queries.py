"""Named queries over the driver tables and their DuckDB oracle SQL.

Every query reads the parquet tables of ``sf_dir`` (or data Spark derives
from them) and returns a DataFrame.  ``ORACLE[name]`` states the same result
directly on the tables in SQL, following the fixture rules of
``logledger.sources.render`` - it never goes through the rendered text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logledger.plans import overlays as ov
from logledger.plans import reconcile as rc
from logledger.plans import reports as rp
from logledger.session import scratch_path, table_path
from logledger.sources import counts as cn
from logledger.sources import files as fl
from logledger.sources import ratings_files as ml
from logledger.sources import render as rd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
TABLE_KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
              "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
              "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id",
              "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id",
              "labels": "doc_id", "conversations": "conv_id"}

# Report parameters used by the registered queries.
STATE_CONTROL_RANGE = (rd.STATE_PUB_BASE, None)
STATE_CANDIDATE_RANGE = (rd.STATE_PUB_BASE + 100, None)
DRIFT_SHARED = (rd.RESOLVER_PUB_BASE, rd.RESOLVER_PUB_BASE + 99_999)
DRIFT_CONTROL = (rd.RESOLVER_PUB_BASE + 100_000, None)
DRIFT_CANDIDATE = (rd.RESOLVER_PUB_BASE + 200_000, None)
DRIFT_SHARED_ONLY = (rd.RESOLVER_PUB_BASE + 1_000, None)
DETAIL_RESOURCES = ["ResAF", "ResNO", "ResRF"]
DETAIL_TOP = 50
ONE_SIDED_STATE = "update"
MIN_POP = 9000
POP_STATE = "NATION_3"
FLIGHT_TOP = 10

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# --- SQL fragments ---------------------------------------------------------
def sql_signed(x: str) -> str:
    """DuckDB text equal to Java's ``%,+8d`` (width 8, never cut)."""
    txt = f"((CASE WHEN ({x}) < 0 THEN '-' ELSE '+' END) || printf('%,d', abs({x})))"
    return f"(CASE WHEN length({txt}) >= 8 THEN {txt} ELSE lpad({txt}, 8, ' ') END)"


def sql_flag(c: str, d: str) -> str:
    return (f"(CASE WHEN {c} > 1000 THEN (CASE WHEN {d} < 0 THEN "
            f"(CASE WHEN abs({d}) / {c} > 0.25 THEN '==' WHEN abs({d}) / {c} > 0.125 THEN '=' ELSE '' END) "
            f"ELSE (CASE WHEN {d} / {c} > 0.25 THEN '++' WHEN {d} / {c} > 0.125 THEN '+' ELSE '' END) END) "
            f"ELSE '' END)")


SQL_STATES = """
state_rows AS (
  SELECT o_orderkey AS rovi_id,
         lower(replace(substr(o_orderpriority, 3), ' ', '_')) AS resource,
         CASE o_orderstatus WHEN 'O' THEN 'PUBLISH' WHEN 'F' THEN 'NOPUBLISH' WHEN 'P' THEN 'UNPUBLISH' END AS state,
         25000000000 + o_orderkey AS pub_id, o_orderkey, o_custkey
  FROM orders WHERE o_orderstatus IN ('O', 'F', 'P') AND o_custkey % 12 < 10),
ctl AS (SELECT * FROM state_rows WHERE o_orderkey % 17 <> 0 AND pub_id >= 25000000000),
cand AS (SELECT * FROM state_rows WHERE o_orderkey % 13 <> 0 AND pub_id >= 25000000100),
tagged AS (SELECT resource, state, 1 AS c, 0 AS d FROM ctl UNION ALL SELECT resource, state, 0, 1 FROM cand)
"""

SQL_RESOLVER = """
res_rows AS (
  SELECT 'Res' || l_returnflag || l_linestatus AS resource, l_orderkey AS rovi_id,
         10000000000 + l_orderkey * 10 + l_linenumber AS pub_id,
         CASE WHEN l_linenumber % 3 = 0 THEN 'empty'
              ELSE CAST(10000000000 + l_orderkey * 10 + l_linenumber - 1 AS VARCHAR) END AS old_pub_id,
         CASE WHEN l_linenumber % 3 = 0 THEN 'new' ELSE 'update' END AS state,
         CAST(trunc(l_quantity) AS BIGINT) AS d, l_orderkey, l_suppkey
  FROM lineitem)
"""

SQL_DRIFT_CAND = """CASE resource WHEN 'ResAF' THEN d * 2 WHEN 'ResAO' THEN CAST(floor(d * 6 / 5) AS BIGINT)
  WHEN 'ResNO' THEN CAST(floor(d * 4 / 5) AS BIGINT) WHEN 'ResRF' THEN CAST(floor(d / 2) AS BIGINT)
  WHEN 'ResRO' THEN d + 1 ELSE d END"""

SQL_DETAIL = """
det_ctl AS (SELECT resource, rovi_id, pub_id, old_pub_id, state, d FROM res_rows WHERE l_orderkey % 3 <> 0),
det_cand AS (SELECT resource, rovi_id, pub_id, old_pub_id, state,
                    CAST(d + CASE WHEN l_orderkey % 5 = 0 THEN (l_suppkey % 7) * 6 ELSE 0 END AS BIGINT) AS d
             FROM res_rows WHERE l_orderkey % 4 <> 0)
"""


def _drift_sql(ctl_where: str, cand_where: str, ctl_measure: str, cand_measure: str,
               rows: str = "res_rows", ctl_rows: str | None = None, cand_rows: str | None = None) -> str:
    return f"""
WITH {SQL_RESOLVER.strip()}, {SQL_DETAIL.strip()},
u AS (SELECT resource, {ctl_measure} AS c, 0 AS x FROM {ctl_rows or rows} WHERE {ctl_where}
      UNION ALL SELECT resource, 0, {cand_measure} FROM {cand_rows or rows} WHERE {cand_where}),
s AS (SELECT resource, CAST(sum(c) AS BIGINT) AS control_sum, CAST(sum(x) AS BIGINT) AS candidate_sum
      FROM u GROUP BY resource)
SELECT resource, control_sum, candidate_sum,
       {sql_signed('candidate_sum - control_sum')} AS difference,
       {sql_flag('control_sum', '(candidate_sum - control_sum)')} AS flag
FROM s"""


# --- R11 flights -----------------------------------------------------------
def _flights(spark, sf_dir, source):
    if source == "events":
        return rd.flights_from_events(t(spark, sf_dir, "events"))
    if source == "orders":
        return rd.flights_from_orders(t(spark, sf_dir, "orders"))
    return rd.routes(t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem"))


def _flight_query(name, source, report, sql):
    @query(name, sql)
    def q(spark, sf_dir):
        return rp.flight_report(_flights(spark, sf_dir, source), report, FLIGHT_TOP)
    return q


_flight_query("topk_count", "events", "departures", """
SELECT user_id AS origin, count(*) AS total_departures FROM events WHERE year(ts) >= 1990
GROUP BY user_id ORDER BY total_departures DESC, origin LIMIT 10""")
_flight_query("topk_count_ge15", "events", "delays_ge15", """
SELECT user_id AS origin, count(*) AS total_delays_ge15 FROM events WHERE year(ts) >= 1990 AND value >= 15
GROUP BY user_id ORDER BY total_delays_ge15 DESC, origin LIMIT 10""")
_flight_query("topk_count_ge60", "events", "delays_ge60", """
SELECT user_id AS origin, count(*) AS total_delays_ge60 FROM events WHERE year(ts) >= 1990 AND value >= 60
GROUP BY user_id ORDER BY total_delays_ge60 DESC, origin LIMIT 10""")
_flight_query("topk_flagged_by_key", "orders", "cancellations_by_origin", """
SELECT o_custkey AS origin, count(*) AS total_cancellations FROM orders
WHERE year(o_orderdate) >= 1990 AND o_orderstatus = 'F'
GROUP BY o_custkey ORDER BY total_cancellations DESC, origin LIMIT 10""")
_flight_query("topk_flagged_by_quarter", "orders", "cancellations_by_quarter", """
SELECT CAST(quarter(o_orderdate) AS INTEGER) AS quarter, count(*) AS total_cancellations FROM orders
WHERE year(o_orderdate) >= 1990 AND o_orderstatus = 'F'
GROUP BY 1 ORDER BY total_cancellations DESC, quarter LIMIT 10""")
_flight_query("topk_pair_count", "routes", "routes", """
SELECT o_custkey % 25 AS origin, l_suppkey % 25 AS dest, count(*) AS total_flights
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) >= 1990
GROUP BY 1, 2 ORDER BY total_flights DESC, origin, dest LIMIT 10""")


# --- R12 population, sources and catalogue ---------------------------------
SQL_ZIPS = """zips AS (
  SELECT printf('%05d', c_custkey) AS zip, c_mktsegment AS city, CAST(trunc(c_acctbal) AS BIGINT) AS pop,
         n_name AS state, c_acctbal AS loc_0, CAST(n_nationkey AS DOUBLE) AS loc_1
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def zips(spark, sf_dir) -> DataFrame:
    z = rd.zips_rows(t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation"))
    return z.withColumnRenamed("_id", "zip")


@query("filter_sort", f"""
WITH {SQL_ZIPS} SELECT state, city, zip, pop FROM zips WHERE pop > {MIN_POP}""")
def q_filter_sort(spark, sf_dir):
    return rp.populous_zips(zips(spark, sf_dir), MIN_POP)


@query("group_sum_sort", f"""
WITH {SQL_ZIPS} SELECT state, CAST(sum(pop) AS BIGINT) AS sum_pop,
  CAST(row_number() OVER (ORDER BY sum(pop) DESC, state) AS INTEGER) AS position FROM zips GROUP BY state""")
def q_group_sum_sort(spark, sf_dir):
    return positioned(rp.state_population(zips(spark, sf_dir)))


SQL_CITY = f"""
WITH {SQL_ZIPS} SELECT city, count(zip) AS num_zips, CAST(sum(pop) AS BIGINT) AS population,
  CAST(row_number() OVER (ORDER BY sum(pop) DESC, city) AS INTEGER) AS position
FROM zips WHERE state = '{POP_STATE}' GROUP BY city"""


@query("group_count_sum_df", SQL_CITY)
def q_city_df(spark, sf_dir):
    return positioned(rp.city_population(zips(spark, sf_dir), POP_STATE))


@query("group_count_sum_sql", SQL_CITY)
def q_city_sql(spark, sf_dir):
    zips(spark, sf_dir).createOrReplaceTempView("zips_view")
    return positioned(rp.city_population_sql(spark, "zips_view", POP_STATE))


@query("json_roundtrip", f"""
WITH {SQL_ZIPS} SELECT zip, city, pop, state, loc_0, loc_1 FROM zips""")
def q_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "zips-json")
    rd.zips_rows(t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")).write.json(path)
    z = fl.read_json_typed(spark, path)
    return z.select("zip", "city", "pop", "state", F.col("loc")[0].alias("loc_0"),
                    F.col("loc")[1].alias("loc_1"))


def _managed_zips(spark, sf_dir) -> str:
    """A managed table: its files are the warehouse's.  The name is new, so nothing of an earlier run is in its way."""
    from logledger.sinks import cache_table, save_table
    name = f"zips_{uuid.uuid4().hex}"
    save_table(zips(spark, sf_dir), name)
    cache_table(spark, name)
    return name


def positioned(report: DataFrame) -> DataFrame:
    """A sorted report of few rows with the place of each row, as it comes out."""
    placed = report.withColumn("_id", F.monotonically_increasing_id())
    return placed.withColumn("position", F.row_number().over(Window.orderBy("_id"))).drop("_id")


@query("table_roundtrip", f"""
WITH {SQL_ZIPS} SELECT state, city, zip, pop FROM zips""")
def q_table_roundtrip(spark, sf_dir):
    return fl.read_table(spark, _managed_zips(spark, sf_dir)).select("state", "city", "zip", "pop")


@query("udf_sorted", f"""
WITH {SQL_ZIPS} SELECT city, CAST(zip AS INTEGER) AS zip_int FROM zips""")
def q_udf_sorted(spark, sf_dir):
    name = _managed_zips(spark, sf_dir)
    rp.register_zip_to_int(spark)
    return spark.sql(f"SELECT city, zip_to_int(zip) AS zip_int FROM {name} ORDER BY zip_int")


@query("catalog_table_counts", " UNION ALL ".join(
    f"SELECT 'c_{n}' AS resource, count(*) AS count FROM {n}" for n in TABLES))
def q_catalog_table_counts(spark, sf_dir):
    """Row count of every table of a database of the catalogue (external tables over the given files)."""
    spark.sql("CREATE DATABASE IF NOT EXISTS counted")
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS counted.c_{name}")
        spark.catalog.createTable(f"counted.c_{name}", path=table_path(sf_dir, name), source="parquet")
    return cn.catalog_table_counts(spark, "counted")


# Fixed value: the new user's own ratings (movie id, rating) and the user id.
NEW_USER = -1  # no customer has a negative key
NEW_USER_RATINGS = [(1, 5.0), (2, 4.0), (3, 1.0), (4, 3.0), (5, 5.0), (6, 2.0), (7, 4.0),
                    (8, 1.0), (9, 3.0), (10, 5.0), (11, 2.0), (12, 4.0), (13, 3.0), (14, 1.0),
                    (15, 5.0), (16, 2.0), (17, 4.0), (18, 3.0), (19, 2.0), (20, 5.0)]


def new_user_ratings(spark) -> DataFrame:
    return fl.inline_rows(spark, [(NEW_USER, m, float(r)) for m, r in NEW_USER_RATINGS],
                          "user_id int, movie_id int, rating float")


_VALUES = ", ".join(f"({m}, {r})" for m, r in NEW_USER_RATINGS)


@query("inline_rows_sort", f"""
WITH mine(movie_id, rating) AS (VALUES {_VALUES})
SELECT CAST(movie_id AS INTEGER) AS movie_id, p_name AS title, CAST(rating AS FLOAT) AS rating,
  CAST(row_number() OVER (ORDER BY rating DESC, movie_id) AS INTEGER) AS position
FROM mine JOIN part ON p_partkey = movie_id""")
def q_inline_rows_sort(spark, sf_dir):
    mine = new_user_ratings(spark)
    part = t(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("movie_id"),
                                           F.col("p_name").alias("title"))
    # 20 literal rows: a fixed-size build side
    j = part.join(F.broadcast(mine), "movie_id")
    return positioned(j.select("movie_id", "title", "rating").orderBy(F.col("rating").desc(), "movie_id"))


# --- R13 access log ---------------------------------------------------------
SQL_ACCESS = """access AS (
  SELECT '-' AS client_identd, CASE WHEN event_id % 10 = 3 THEN 0 ELSE event_id END AS content_size,
         date_trunc('second', ts) + INTERVAL 8 HOUR AS dt, '/' || event_type AS endpoint,
         '10.0.0.' || CAST(user_id % 250 AS VARCHAR) AS ip_address,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS response_code
  FROM events WHERE event_id % 11 <> 0)"""


@query("access_extract", f"WITH {SQL_ACCESS} SELECT * FROM access")
def q_access_extract(spark, sf_dir):
    return rp.access_records(rd.access_lines(t(spark, sf_dir, "events")))


@query("access_value_join", f"""
WITH {SQL_ACCESS}
SELECT p_partkey AS item_id, p_brand AS brand, ip_address, endpoint, content_size,
       CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month
FROM part JOIN access ON CASE WHEN p_partkey = 1 THEN 0 ELSE p_partkey * 5 END = content_size""")
def q_access_value_join(spark, sf_dir):
    return rp.access_value_join(rd.access_lines(t(spark, sf_dir, "events")),
                                rd.price_list(t(spark, sf_dir, "part")))


# --- R1 / R2 state logs -----------------------------------------------------
def _state_logs(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    return rd.state_lines(o, "control"), rd.state_lines(o, "candidate")


@query("state_counts_control", f"""
WITH {SQL_STATES.strip()} SELECT resource, state, count(*) AS count,
  CAST(row_number() OVER (ORDER BY resource, state) AS INTEGER) AS position FROM ctl GROUP BY resource, state""")
def q_state_counts_control(spark, sf_dir):
    c, _ = _state_logs(spark, sf_dir)
    return positioned(rc.state_counts(c, "control", STATE_CONTROL_RANGE))


_LISTED_STATES = ["PUBLISH", "UNPUBLISH"]


@query("state_list", f"""
WITH {SQL_STATES.strip()} SELECT rovi_id, resource, state, pub_id FROM ctl WHERE state IN ('PUBLISH', 'UNPUBLISH')""")
def q_state_list(spark, sf_dir):
    """The rows of one side whose state is in a list."""
    c, _ = _state_logs(spark, sf_dir)
    rows = rc.states_in_range(c, "control", STATE_CONTROL_RANGE, states=_LISTED_STATES)
    return rows.select("rovi_id", "resource", "state", "pub_id")


@query("state_counts_candidate", f"""
WITH {SQL_STATES.strip()} SELECT resource, state, count(*) AS count FROM cand GROUP BY resource, state""")
def q_state_counts_candidate(spark, sf_dir):
    _, d = _state_logs(spark, sf_dir)
    return rc.state_counts(d, "candidate", STATE_CANDIDATE_RANGE)


@query("state_crosstab", f"""
WITH {SQL_STATES.strip()}
SELECT CASE WHEN grouping(resource) = 1 THEN 'state' WHEN grouping(state) = 1 THEN 'resource'
            ELSE 'resource_state' END AS "grouping",
       resource, state, CAST(sum(c) AS BIGINT) AS control_sum, CAST(sum(d) AS BIGINT) AS candidate_sum
FROM tagged GROUP BY GROUPING SETS ((state), (resource), (resource, state))""")
def q_state_crosstab(spark, sf_dir):
    c, d = _state_logs(spark, sf_dir)
    return rc.state_crosstab_all(c, d, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE)


def _crosstab_query(name, by, keys):
    @query(name, f"""
WITH {SQL_STATES.strip()}
SELECT {keys}, CAST(sum(c) AS BIGINT) AS control_sum, CAST(sum(d) AS BIGINT) AS candidate_sum
FROM tagged GROUP BY {keys}""")
    def q(spark, sf_dir):
        c, d = _state_logs(spark, sf_dir)
        return rc.state_crosstab(c, d, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE, by)
    return q


_crosstab_query("state_crosstab_by_state", "state", "state")
_crosstab_query("state_crosstab_by_resource", "resource", "resource")


# --- R3 / R4 drift ----------------------------------------------------------
def _drift_logs(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    return rd.resolver_drift_lines(li, "control"), rd.resolver_drift_lines(li, "candidate")


def _detail_logs(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    return rd.resolver_detail_lines(li, "control"), rd.resolver_detail_lines(li, "candidate")


_SH = f"pub_id BETWEEN {DRIFT_SHARED[0]} AND {DRIFT_SHARED[1]}"


@query("resolver_drift", _drift_sql(f"{_SH} OR pub_id >= {DRIFT_CONTROL[0]}",
                                    f"{_SH} OR pub_id >= {DRIFT_CANDIDATE[0]}", "d", SQL_DRIFT_CAND))
def q_resolver_drift(spark, sf_dir):
    c, d = _drift_logs(spark, sf_dir)
    return rc.resolver_drift(c, d, DRIFT_SHARED, DRIFT_CONTROL, DRIFT_CANDIDATE)


@query("resolver_drift_count", _drift_sql(f"{_SH} OR pub_id >= {DRIFT_CONTROL[0]}",
                                          f"{_SH} OR pub_id >= {DRIFT_CANDIDATE[0]}", "1", "1",
                                          ctl_rows="det_ctl", cand_rows="det_cand"))
def q_resolver_drift_count(spark, sf_dir):
    c, d = _detail_logs(spark, sf_dir)
    return rc.resolver_drift(c, d, DRIFT_SHARED, DRIFT_CONTROL, DRIFT_CANDIDATE, count_only=True)


@query("resolver_drift_shared", _drift_sql(f"pub_id >= {DRIFT_SHARED_ONLY[0]}",
                                           f"pub_id >= {DRIFT_SHARED_ONLY[0]}", "d", SQL_DRIFT_CAND))
def q_resolver_drift_shared(spark, sf_dir):
    c, d = _drift_logs(spark, sf_dir)
    return rc.resolver_drift(c, d, DRIFT_SHARED_ONLY)


# --- R5 / R6 details --------------------------------------------------------
_RES_IN = ", ".join(f"'{r}'" for r in DETAIL_RESOURCES)


@query("matched_diff_topn", f"""
WITH {SQL_RESOLVER.strip()}, {SQL_DETAIL.strip()},
c AS (SELECT pub_id, resource, rovi_id, old_pub_id, d AS control_dirty_size FROM det_ctl
      WHERE resource IN ({_RES_IN}) AND pub_id >= {rd.RESOLVER_PUB_BASE}),
x AS (SELECT pub_id, resource, rovi_id, old_pub_id, d AS candidate_dirty_size FROM det_cand
      WHERE resource IN ({_RES_IN}) AND pub_id >= {rd.RESOLVER_PUB_BASE}),
j AS (SELECT * FROM c JOIN x USING (pub_id, resource, rovi_id, old_pub_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY resource
        ORDER BY abs(candidate_dirty_size - control_dirty_size) DESC, rovi_id, pub_id, old_pub_id,
                 control_dirty_size, candidate_dirty_size) AS rn FROM j)
SELECT resource, rovi_id, pub_id, old_pub_id, control_dirty_size, candidate_dirty_size,
       {sql_signed('candidate_dirty_size - control_dirty_size')} AS difference
FROM r WHERE rn <= {DETAIL_TOP}""")
def q_matched_diff_topn(spark, sf_dir):
    c, d = _detail_logs(spark, sf_dir)
    return rc.matched_differences(c, d, rd.RESOLVER_PUB_BASE, None, DETAIL_RESOURCES, DETAIL_TOP)


@query("matched_diff_bucketed", ORACLE["matched_diff_topn"])
def q_matched_diff_bucketed(spark, sf_dir):
    """The same report over rows landed in buckets of the matching key: the join needs no exchange."""
    from logledger.sources import landing as ld
    tables = {}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for log, dialect in zip(_detail_logs(spark, sf_dir), ("control", "candidate")):
        tables[dialect] = f"landed_{dialect}_{uuid.uuid4().hex}"
        ld.land_resolver_table(log, dialect, tables[dialect], buckets)
    return rc.matched_differences(spark.table(tables["control"]), spark.table(tables["candidate"]),
                                  rd.RESOLVER_PUB_BASE, None, DETAIL_RESOURCES, DETAIL_TOP, bucketed=True)


@query("one_sided_keys", f"""
WITH {SQL_RESOLVER.strip()}, {SQL_DETAIL.strip()},
c AS (SELECT resource, rovi_id, state, pub_id AS control_pub_id, d AS control_dirty_size FROM det_ctl
      WHERE resource IN ({_RES_IN}) AND rovi_id >= 0 AND state = '{ONE_SIDED_STATE}'),
x AS (SELECT resource, rovi_id, state, pub_id AS candidate_pub_id, d AS candidate_dirty_size FROM det_cand
      WHERE resource IN ({_RES_IN}) AND rovi_id >= 0 AND state = '{ONE_SIDED_STATE}')
SELECT resource, rovi_id, control_pub_id, control_dirty_size, candidate_pub_id, candidate_dirty_size
FROM c FULL OUTER JOIN x USING (resource, rovi_id, state)
WHERE control_dirty_size IS NULL OR candidate_dirty_size IS NULL""")
def q_one_sided_keys(spark, sf_dir):
    c, d = _detail_logs(spark, sf_dir)
    return rc.one_sided_keys(c, d, 0, -1, ONE_SIDED_STATE, DETAIL_RESOURCES)


@query("one_sided_keys_first", f"""
WITH {SQL_RESOLVER.strip()}, {SQL_DETAIL.strip()},
u AS (SELECT 0 AS flag, * FROM det_ctl UNION ALL SELECT 1, * FROM det_cand),
k AS (SELECT *, min(flag) OVER w <> max(flag) OVER w AS both_sides FROM u
      WHERE resource IN ({_RES_IN}) AND rovi_id >= 0 AND state = '{ONE_SIDED_STATE}'
      WINDOW w AS (PARTITION BY resource, rovi_id, state)),
r AS (SELECT *, row_number() OVER (PARTITION BY resource ORDER BY flag, pub_id, rovi_id, d) AS rn FROM k
      WHERE NOT both_sides)
SELECT resource, rovi_id, CASE WHEN flag = 0 THEN pub_id END AS control_pub_id,
       CASE WHEN flag = 1 THEN pub_id END AS candidate_pub_id,
       CAST(row_number() OVER (ORDER BY resource, rn) AS INTEGER) AS position FROM r WHERE rn <= 20""")
def q_one_sided_keys_first(spark, sf_dir):
    """The report as it is shown: the first rows of each resource, missing side first, then id."""
    c, d = _detail_logs(spark, sf_dir)
    top = rc.one_sided_keys(c, d, 0, -1, ONE_SIDED_STATE, DETAIL_RESOURCES, n=20)
    return positioned(top).drop("control_dirty_size", "candidate_dirty_size")


# --- R7 / R8 count files ----------------------------------------------------
def _count_file(spark, sf_dir, env):
    lines = cn.render_count_lines(rd.priority_counts(t(spark, sf_dir, "orders"), env))
    return cn.parse_count_lines(lines)


SQL_COUNTS = """
cc AS (SELECT CASE o_orderpriority WHEN '5-LOW' THEN 'MX5-LOW' ELSE o_orderpriority END AS resource,
              count(*) AS control_count FROM orders GROUP BY 1),
dc AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'Published' || o_orderpriority END AS resource,
              count(*) AS candidate_count FROM orders GROUP BY 1),
tc AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE 'Other' END AS resource,
              count(*) AS third_count FROM orders GROUP BY 1)"""


@query("count_compare", f"""
WITH {SQL_COUNTS.strip()}
SELECT dc.resource, cc.control_count, dc.candidate_count,
       {sql_signed('CASE WHEN cc.control_count IS NULL THEN dc.candidate_count ELSE dc.candidate_count - cc.control_count END')} AS difference
FROM cc RIGHT JOIN dc ON cc.resource = dc.resource""")
def q_count_compare(spark, sf_dir):
    return rc.count_compare(_count_file(spark, sf_dir, "control"), _count_file(spark, sf_dir, "candidate"))


@query("count_totals", f"""
WITH {SQL_COUNTS.strip()},
a AS (SELECT CAST(sum(control_count) AS BIGINT) AS control_total FROM cc
      WHERE NOT starts_with(resource, 'MX') AND NOT starts_with(resource, 'Published')),
b AS (SELECT CAST(sum(candidate_count) AS BIGINT) AS candidate_total FROM dc
      WHERE NOT starts_with(resource, 'MX') AND NOT starts_with(resource, 'Published'))
SELECT control_total, candidate_total, candidate_total - control_total AS diff FROM a, b""")
def q_count_totals(spark, sf_dir):
    return rc.count_totals(_count_file(spark, sf_dir, "control"), _count_file(spark, sf_dir, "candidate"))


@query("size_compare_n", f"""
WITH {SQL_COUNTS.strip()},
k AS (SELECT resource FROM cc UNION SELECT resource FROM dc UNION SELECT resource FROM tc)
SELECT k.resource, cc.control_count AS count_control, dc.candidate_count AS count_candidate,
       tc.third_count AS count_third
FROM k LEFT JOIN cc ON k.resource = cc.resource LEFT JOIN dc ON k.resource = dc.resource
       LEFT JOIN tc ON k.resource = tc.resource""")
def q_size_compare_n(spark, sf_dir):
    return rc.size_compare({env: _count_file(spark, sf_dir, env)
                            for env in ("control", "candidate", "third")})


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS resource, count(*) AS count FROM {n}" for n in TABLES))
def q_table_counts(spark, sf_dir):
    return cn.file_counts(spark, {n: table_path(sf_dir, n) for n in TABLES})


@query("table_nonnull_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS resource, count({TABLE_KEYS[n]}) AS count FROM {n}" for n in TABLES))
def q_table_nonnull_counts(spark, sf_dir):
    return cn.file_nonnull_counts(spark, {n: (table_path(sf_dir, n), TABLE_KEYS[n]) for n in TABLES})


# --- R9 / R10 overlays -------------------------------------------------------
SQL_OVERLAY = """o AS (
  SELECT p_size % 10 AS SHOWTYPE,
         (CASE WHEN starts_with(p_type, 'E') THEN 'EP' ELSE 'MV' END) || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS TMSID,
         CASE WHEN p_partkey % 97 = 0 THEN 'SHxxxxxxxxxx'
              ELSE 'SH' || lpad(CAST((p_partkey * 104729) % 10000000000 AS VARCHAR), 10, '0') END AS SERIESTMSID,
         CAST(p_partkey AS INTEGER) AS mfsid, p_partkey + 5000000 AS sourceProgramId, p_name AS TITLE
  FROM part),
ov AS (
  SELECT sourceProgramId AS rovi_id,
         CASE WHEN SHOWTYPE = 8 THEN 'movie_overlay' WHEN SHOWTYPE = 3 THEN 'other_overlay'
              WHEN SHOWTYPE = 5 THEN (CASE WHEN starts_with(TMSID, 'EP') THEN 'episode_overlay' ELSE 'series_overlay' END)
         END AS resource_type,
         mfsid, (CAST(320 AS BIGINT) << 40) | CAST(mfsid AS BIGINT) AS ct_numeric,
         TRY_CAST(substr(SERIESTMSID, 3, 10) AS INTEGER) AS coll_tmsid,
         (CAST(313 AS BIGINT) << 40) | CAST(TRY_CAST(substr(SERIESTMSID, 3, 10) AS INTEGER) AS BIGINT) AS cl_numeric,
         TITLE AS title
  FROM o)"""


@query("content_overlay", f"WITH {SQL_OVERLAY} SELECT * FROM ov")
def q_content_overlay(spark, sf_dir):
    return ov.content_overlays(rd.content_overlay_rows(t(spark, sf_dir, "part")))


@query("content_overlay_counts", f"WITH {SQL_OVERLAY} SELECT resource_type, count(*) AS count FROM ov GROUP BY 1")
def q_content_overlay_counts(spark, sf_dir):
    return ov.overlay_type_counts(ov.content_overlays(rd.content_overlay_rows(t(spark, sf_dir, "part"))))


@query("station_overlay", """
SELECT s_suppkey + 9000000 AS rovi_id, 'station_overlay' AS resource_type, CAST(s_suppkey AS INTEGER) AS mfsid,
       (CAST(523 AS BIGINT) << 40) | s_suppkey AS st_numeric FROM supplier""")
def q_station_overlay(spark, sf_dir):
    return ov.station_overlays(rd.station_overlay_rows(t(spark, sf_dir, "supplier")))


# --- ratings and movies -----------------------------------------------------
SQL_RATINGS = """pairs AS (
  SELECT DISTINCT CAST(o_custkey AS BIGINT) AS u, CAST(l_partkey AS BIGINT) AS i
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
rt AS (SELECT u, i, 1 + (4 * (u % 7 + 1) * (i % 5 + 1)) // 35 AS rating, (u * 31 + i * 17) % 10 AS b FROM pairs)"""


def ratings(spark, sf_dir) -> DataFrame:
    return rd.rating_pairs(t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders"))


@query("ratings_parse", f"""
WITH {SQL_RATINGS} SELECT CAST(u AS INTEGER) AS user_id, CAST(i AS INTEGER) AS movie_id,
CAST(rating AS FLOAT) AS rating FROM rt""")
def q_ratings_parse(spark, sf_dir):
    return ml.parse_ratings(rd.rating_lines(ratings(spark, sf_dir)))


@query("movies_parse", """
SELECT CAST(p_partkey AS INTEGER) AS movie_id, p_name AS title, 0 AS genre_pos, p_type AS genre FROM part
UNION ALL
SELECT CAST(p_partkey AS INTEGER), p_name, 1, p_brand FROM part WHERE p_partkey % 11 <> 0""")
def q_movies_parse(spark, sf_dir):
    m = ml.parse_movies(rd.movie_lines(t(spark, sf_dir, "part")))
    return m.select(F.col("id").alias("movie_id"), "title",
                    F.posexplode("genres").alias("genre_pos", "genre"))


@query("delimiter_convert", """
SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title,
       CASE WHEN p_partkey % 11 = 0 THEN p_type ELSE p_type || '|' || p_brand END AS genres FROM part""")
def q_delimiter_convert(spark, sf_dir):
    path = scratch_path(spark, "movies-csv")
    ml.movies_to_csv(ml.parse_movies(rd.movie_lines(t(spark, sf_dir, "part"))), path)
    return fl.read_csv(spark, path, schema="id int, title string, genres string")


@query("rating_baseline_rmse", f"""
WITH {SQL_RATINGS},
m AS (SELECT avg(rating) AS mu FROM rt WHERE b < 8)
SELECT round(any_value(mu), 6) AS train_mean,
       round(sqrt(avg(CASE WHEN b = 9 THEN (rating - mu) * (rating - mu) END)), 6) AS baseline_rmse,
       count(CASE WHEN b < 8 THEN 1 END) AS n_train, count(CASE WHEN b = 8 THEN 1 END) AS n_validation,
       count(CASE WHEN b = 9 THEN 1 END) AS n_test
FROM rt, m""")
def q_rating_baseline_rmse(spark, sf_dir):
    from logledger.plans.recommend import baseline_report
    return baseline_report(ratings(spark, sf_dir))


# --- one-pass and alternative paths (same results as above, other plans) ----
_FLIGHT_SQL_CONDS = {"departures": "TRUE", "delays_ge15": "value >= 15", "delays_ge60": "value >= 60"}


def _events_flights_all(spark, sf_dir):
    ev = rd.flights_from_events(t(spark, sf_dir, "events")).withColumn("dest", F.lit(None).cast("long"))
    return ev


@query("flight_tables_one_pass", " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{name}' AS report, user_id AS origin, count(*) AS total FROM events
        WHERE year(ts) >= 1990 AND {cond} GROUP BY user_id ORDER BY total DESC, origin LIMIT 10)"""
    for name, cond in _FLIGHT_SQL_CONDS.items()))
def q_flight_tables_one_pass(spark, sf_dir):
    """Three origin tables of the flight report from one grouping-sets pass."""
    reps = rp.flight_reports(_events_flights_all(spark, sf_dir), FLIGHT_TOP)
    cols = {"departures": "total_departures", "delays_ge15": "total_delays_ge15",
            "delays_ge60": "total_delays_ge60"}
    out = None
    for name, col in cols.items():
        part = reps[name].select(F.lit(name).alias("report"), "origin", F.col(col).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@query("flight_table_coalesced", ORACLE["topk_count"])
def q_flight_table_coalesced(spark, sf_dir):
    """Departures from two thirds of the scan's partitions, merged without a shuffle."""
    return rp.flight_reports(_events_flights_all(spark, sf_dir), FLIGHT_TOP, keep_fraction=2 / 3, cache=False)["departures"]


@query("state_report_all", f"""
WITH {SQL_STATES.strip()},
sides AS (SELECT 'control' AS side, resource, state FROM ctl UNION ALL SELECT 'candidate', resource, state FROM cand)
SELECT side, 'state' AS level, NULL AS resource, state, count(*) AS count FROM sides GROUP BY side, state
UNION ALL SELECT side, 'resource', resource, NULL, count(*) FROM sides GROUP BY side, resource
UNION ALL SELECT side, 'resource_state', resource, state, count(*) FROM sides GROUP BY side, resource, state""")
def q_state_report_all(spark, sf_dir):
    """R1's six tables (one grouping-sets pass) as one frame."""
    c, d = _state_logs(spark, sf_dir)
    rep = rc.state_report(c, d, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE)
    out = None
    for side in ("control", "candidate"):
        for level in ("state", "resource", "resource_state"):
            df = rep[f"{side}_by_{level}"]
            part = df.select(F.lit(side).alias("side"), F.lit(level).alias("level"),
                             (F.col("resource") if "resource" in df.columns else F.lit(None).cast("string")).alias("resource"),
                             (F.col("state") if "state" in df.columns else F.lit(None).cast("string")).alias("state"),
                             "count")
            out = part if out is None else out.unionByName(part)
    return out


_DRIFT_TOTALS_INNER = _drift_sql(f"{_SH} OR pub_id >= {DRIFT_CONTROL[0]}",
                                 f"{_SH} OR pub_id >= {DRIFT_CANDIDATE[0]}", "1", "1",
                                 ctl_rows="det_ctl", cand_rows="det_cand")
_DRIFT_TOTALS = _DRIFT_TOTALS_INNER.replace(
    "FROM s", f"""FROM (SELECT * FROM s UNION ALL
      SELECT '{rc.TOTAL}', CAST(sum(control_sum) AS BIGINT), CAST(sum(candidate_sum) AS BIGINT) FROM s) s""")


@query("resolver_drift_totals", _DRIFT_TOTALS)
def q_resolver_drift_totals(spark, sf_dir):
    c, d = _detail_logs(spark, sf_dir)
    return rc.resolver_drift(c, d, DRIFT_SHARED, DRIFT_CONTROL, DRIFT_CANDIDATE, count_only=True, totals=True)


@query("overlay_movie_samples", f"WITH {SQL_OVERLAY} SELECT * FROM ov WHERE resource_type = 'movie_overlay'")
def q_overlay_movie_samples(spark, sf_dir):
    return ov.overlay_samples(ov.content_overlays(rd.content_overlay_rows(t(spark, sf_dir, "part"))))


@query("access_value_join_salted", ORACLE["access_value_join"])
def q_access_value_join_salted(spark, sf_dir):
    return rp.access_value_join(rd.access_lines(t(spark, sf_dir, "events")),
                                rd.price_list(t(spark, sf_dir, "part")), salts=8)


@query("access_value_join_hot", ORACLE["access_value_join"])
def q_access_value_join_hot(spark, sf_dir):
    """Sizes with over a hundredth of the requests, found by a sketch, are spread; the rest joins once."""
    return rp.access_value_join(rd.access_lines(t(spark, sf_dir, "events")),
                                rd.price_list(t(spark, sf_dir, "part")), hot_share=0.01)


@query("resolver_drift_landed", ORACLE["resolver_drift"])
def q_resolver_drift_landed(spark, sf_dir):
    """The drift report over extracted rows landed once as parquet."""
    from logledger.sources import landing as ld
    c, d = _drift_logs(spark, sf_dir)
    pc, pd_ = scratch_path(spark, "landed-control"), scratch_path(spark, "landed-candidate")
    ld.land_resolver(c, "control", pc)
    ld.land_resolver(d, "candidate", pd_)
    return rc.resolver_drift(ld.read_landed(spark, pc), ld.read_landed(spark, pd_),
                             DRIFT_SHARED, DRIFT_CONTROL, DRIFT_CANDIDATE)


_STREAM_RANGE = (rd.RESOLVER_PUB_BASE, None)


@query("resolver_drift_stream", _drift_sql(f"pub_id >= {_STREAM_RANGE[0]}", f"pub_id >= {_STREAM_RANGE[0]}",
                                           "d", SQL_DRIFT_CAND))
def q_resolver_drift_stream(spark, sf_dir):
    """The drift report maintained by Structured Streaming over log folders:
    the rendered logs are written as text files, one available-now trigger
    processes them, and the query reads the report the stream wrote."""
    from logledger.streaming.drift import drift_stream, read_report, start_drift_to_table
    c, d = _drift_logs(spark, sf_dir)
    cdir, ddir = scratch_path(spark, "stream-control"), scratch_path(spark, "stream-candidate")
    out = scratch_path(spark, "stream-report")
    c.write.text(cdir)
    d.write.text(ddir)
    start_drift_to_table(drift_stream(spark, cdir, ddir, _STREAM_RANGE), out).awaitTermination()
    return read_report(spark, out)


@query("state_crosstab_totals", f"""
WITH {SQL_STATES.strip()}
SELECT CASE WHEN grouping(resource) = 1 AND grouping(state) = 1 THEN 'total'
            WHEN grouping(resource) = 1 THEN 'state' WHEN grouping(state) = 1 THEN 'resource'
            ELSE 'resource_state' END AS "grouping",
       resource, state, CAST(sum(c) AS BIGINT) AS control_sum, CAST(sum(d) AS BIGINT) AS candidate_sum
FROM tagged GROUP BY GROUPING SETS ((state), (resource), (resource, state), ())""")
def q_state_crosstab_totals(spark, sf_dir):
    """R2 with the parsed-row totals of both sides from the same aggregate."""
    c, d = _state_logs(spark, sf_dir)
    return rc.state_crosstab_all(c, d, STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE, totals=True)


@query("state_line_counts", f"""
WITH {SQL_STATES.strip()}, n AS (SELECT count(*) AS lines FROM orders),
s AS (SELECT 'control' AS side, (SELECT count(*) FROM state_rows WHERE o_orderkey % 17 <> 0) AS accepted,
        (SELECT count(*) FROM ctl) AS reported
      UNION ALL SELECT 'candidate', (SELECT count(*) FROM state_rows WHERE o_orderkey % 13 <> 0), (SELECT count(*) FROM cand))
SELECT side, lines, accepted, lines - accepted AS refused, reported FROM s, n""")
def q_state_line_counts(spark, sf_dir):
    """Lines read, accepted and refused, from the pass that writes the crosstab, beside the rows it reports."""
    from logledger.operators.extract import extract_states
    from logledger.operators.observe import observed
    logs = dict(zip(("control", "candidate"), _state_logs(spark, sf_dir)))
    seen = {side: observed(log, lambda rows, side=side: extract_states(rows, side)) for side, log in logs.items()}
    path = scratch_path(spark, "crosstab")
    rc.state_crosstab_all(seen["control"][0], seen["candidate"][0], STATE_CONTROL_RANGE, STATE_CANDIDATE_RANGE,
                          totals=True).write.parquet(path)
    total = spark.read.parquet(path).filter("grouping = 'total'")
    counts = {side: c.get() for side, (_, c) in seen.items()}
    parts = [total.select(F.lit(side).alias("side"), *[F.lit(n).cast("long").alias(k) for k, n in counts[side].items()],
                          F.coalesce(f"{side}_sum", F.lit(0)).alias("reported")) for side in logs]
    return parts[0].unionByName(parts[1])


# --- quarantine ----------------------------------------------------------------
def _quarantined(spark, lines, judge, columns) -> DataFrame:
    """Lines as text files, judged and landed in one pass; good rows and quarantined lines as read back."""
    from logledger.sources import quarantine as qr
    text, landed = scratch_path(spark, "lines"), scratch_path(spark, "judged")
    lines.write.text(text)
    qr.land_judged(judge(qr.read_lines_with_file(spark, text)), landed)
    bad = qr.read_quarantined(spark, landed).select(
        "line", F.col("file").contains(text.rpartition("/")[2]).alias("file_known"), "reason")
    return qr.read_good(spark, landed, columns).unionByName(bad, allowMissingColumns=True)


_NO_BAD = "CAST(NULL AS VARCHAR) AS line, CAST(NULL AS BOOLEAN) AS file_known, CAST(NULL AS VARCHAR) AS reason"


@query("ratings_quarantine", f"""
WITH {SQL_RATINGS}, l AS (SELECT *, u || '::' || i || '::' || CASE WHEN (u + i) % 23 = 0 THEN 'n/a' ELSE rating::VARCHAR END
  || CASE WHEN (u + i) % 19 = 0 THEN '' ELSE '::' || (978300000 + i) END AS line FROM rt)
SELECT CAST(u AS INTEGER) AS user_id, CAST(i AS INTEGER) AS movie_id, CAST(rating AS FLOAT) AS rating, {_NO_BAD}
FROM l WHERE (u + i) % 19 <> 0 AND (u + i) % 23 <> 0
UNION ALL SELECT NULL, NULL, NULL, line, TRUE, CASE WHEN (u + i) % 19 = 0 THEN 'not 4 fields' ELSE 'rating is no float' END
FROM l WHERE (u + i) % 19 = 0 OR (u + i) % 23 = 0""")
def q_ratings_quarantine(spark, sf_dir):
    from logledger.sources import quarantine as qr
    return _quarantined(spark, rd.broken_rating_lines(ratings(spark, sf_dir)), qr.judge_ratings, qr.RATING_COLUMNS)


@query("movies_quarantine", f"""
WITH l AS (SELECT *, CASE WHEN p_partkey % 19 = 0 THEN 'm' ELSE '' END || p_partkey || '::' || p_name AS head FROM part)
SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS title, p_type || '|' || p_brand AS genres, {_NO_BAD}
FROM l WHERE p_partkey % 19 <> 0 AND p_partkey % 23 <> 0
UNION ALL SELECT NULL, NULL, NULL, CASE WHEN p_partkey % 23 = 0 THEN head ELSE head || '::' || p_type || '|' || p_brand END,
  TRUE, CASE WHEN p_partkey % 23 = 0 THEN 'not 3 fields' ELSE 'id is no int' END
FROM l WHERE p_partkey % 19 = 0 OR p_partkey % 23 = 0""")
def q_movies_quarantine(spark, sf_dir):
    from logledger.sources import quarantine as qr
    found = _quarantined(spark, rd.broken_movie_lines(t(spark, sf_dir, "part")), qr.judge_movies, qr.MOVIE_COLUMNS)
    return found.withColumn("genres", F.when(F.col("genres").isNotNull(), F.array_join("genres", "|")))


@query("counts_quarantine", f"""
WITH l AS (SELECT o_custkey AS k, 'Customer' || o_custkey AS resource, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT resource, n AS count, {_NO_BAD} FROM l WHERE k % 19 <> 0 AND k % 23 <> 0
UNION ALL SELECT NULL, NULL, CASE WHEN k % 19 = 0 THEN resource ELSE resource || ' - many' END, TRUE,
  CASE WHEN k % 19 = 0 THEN 'not 2 fields' ELSE 'count is no bigint' END FROM l WHERE k % 19 = 0 OR k % 23 = 0""")
def q_counts_quarantine(spark, sf_dir):
    from logledger.sources import quarantine as qr
    return _quarantined(spark, rd.broken_count_lines(t(spark, sf_dir, "orders")), qr.judge_counts, qr.COUNT_COLUMNS)


# --- real files ---------------------------------------------------------------
@query("resolver_drift_files", ORACLE["resolver_drift"])
def q_resolver_drift_files(spark, sf_dir):
    """The drift report over text files, the candidate's gzipped, read in batch."""
    c, d = _drift_logs(spark, sf_dir)
    pc, pd_ = scratch_path(spark, "log-control"), scratch_path(spark, "log-candidate")
    c.write.text(pc)
    d.write.option("compression", "gzip").text(pd_)
    return rc.resolver_drift(fl.read_lines(spark, pc), fl.read_lines(spark, pd_), DRIFT_SHARED, DRIFT_CONTROL,
                             DRIFT_CANDIDATE)


@query("price_list_inferred", """
SELECT CAST(p_partkey AS INTEGER) AS item_id, p_name AS name, p_brand AS brand,
       CAST(CASE WHEN p_partkey = 1 THEN 0 ELSE p_partkey * 5 END AS INTEGER) AS price FROM part""")
def q_price_list_inferred(spark, sf_dir):
    """CSV with header and inferred types."""
    path = scratch_path(spark, "prices")
    rd.price_list(t(spark, sf_dir, "part")).write.option("header", True).csv(path)
    return fl.read_csv(spark, path)


@query("overlay_collection", f"""
WITH {SQL_OVERLAY}
SELECT rovi_id, resource_type, mfsid, ct_numeric, coll_tmsid, cl_numeric, title, CAST(NULL AS BIGINT) AS st_numeric
FROM ov UNION ALL
SELECT s_suppkey + 9000000, 'station_overlay', CAST(s_suppkey AS INTEGER), NULL, NULL, NULL, NULL,
       (CAST(523 AS BIGINT) << 40) | s_suppkey FROM supplier""")
def q_overlay_collection(spark, sf_dir):
    """Content overlays overwrite the lookup collection, station overlays are appended."""
    path = scratch_path(spark, "overlays")
    content = ov.content_overlays(rd.content_overlay_rows(t(spark, sf_dir, "part")))
    station = ov.station_overlays(rd.station_overlay_rows(t(spark, sf_dir, "supplier")))
    ov.save_overlays(content, None, "parquet", path)
    ov.save_overlays(content, None, "parquet", path)  # overwritten, not doubled
    ov.save_overlays(None, station, "parquet", path)
    return fl.read_format(spark, "parquet", path)


@query("overlay_collection_rerun", ORACLE["overlay_collection"].replace(
    "CAST(NULL AS BIGINT) AS st_numeric", "CAST(NULL AS BIGINT) AS st_numeric, 'content' AS run").replace(
    "| s_suppkey FROM supplier", "| s_suppkey, 'station' FROM supplier"))
def q_overlay_collection_rerun(spark, sf_dir):
    """Both jobs run twice, the station job first with half of its rows: one copy of each remains."""
    path = scratch_path(spark, "overlay-runs")
    content = ov.content_overlays(rd.content_overlay_rows(t(spark, sf_dir, "part")))
    station = ov.station_overlays(rd.station_overlay_rows(t(spark, sf_dir, "supplier")))
    ov.save_overlays(None, station.filter("mfsid % 2 = 0"), "parquet", path, run="station")
    for _ in range(2):
        ov.save_overlays(content, None, "parquet", path, run="content")
        ov.save_overlays(None, station, "parquet", path, run="station")
    return fl.read_format(spark, "parquet", path)
