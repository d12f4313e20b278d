"""Grouped, top-k and join reports over parquet, JSON, CSV and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logledger.functions.time import log_time_to_utc
from logledger.operators.aggregate import Reports
from logledger.operators.extract import extract_access
from logledger.operators.joins import hot_join, salted_join, spread
from logledger.operators.topk import top_counts, top_k
from logledger.sinks import coalesce_by_fraction


# R11 -----------------------------------------------------------------------
# name -> (group keys, condition on a flight or None, count column)
FLIGHT_TABLES = {
    "departures": (["origin"], None, "total_departures"),
    "delays_ge15": (["origin"], ("depdelay", ">=", 15), "total_delays_ge15"),
    "delays_ge60": (["origin"], ("depdelay", ">=", 60), "total_delays_ge60"),
    "cancellations_by_origin": (["origin"], ("cancelled", "==", 1), "total_cancellations"),
    "cancellations_by_quarter": (["quarter"], ("cancelled", "==", 1), "total_cancellations"),
    "routes": (["origin", "dest"], None, "total_flights"),
}


def _flight_cond(spec):
    if spec is None:
        return None
    c, op, v = spec
    return F.col(c) >= v if op == ">=" else F.col(c) == v


def _flight_base(flights: DataFrame, min_year: int) -> DataFrame:
    return flights.filter(F.col("year") >= min_year).select(
        "quarter", "origin", "dest", "depdelay", "cancelled")


def flight_report(flights: DataFrame, name: str, k: int = 10, min_year: int = 1990) -> DataFrame:
    """One flight table: filter (pushed to the scan), partial + final count,
    ``TakeOrderedAndProject``; ties cut by the key."""
    keys, cond, col = FLIGHT_TABLES[name]
    return top_counts(_flight_base(flights, min_year), keys, k, col, _flight_cond(cond))


def flight_reports(flights: DataFrame, k: int = 10, min_year: int = 1990,
                   keep_fraction: float | None = None, cache: bool = True) -> Reports:
    """Top-k departures, delays >= 15 / >= 60, cancellations by origin and by
    quarter, and busiest routes.

    One scan and one shuffle for all six tables (use :func:`flight_report`
    for a single table, which can push its filter into the scan): a grouping-sets aggregate over
    (origin), (quarter), (origin, dest) with conditional counts (partial
    aggregation before the shuffle), kept in memory (it has one row per key,
    not per flight) until the result's ``release()``.  Each table is a top-k of that aggregate; keys whose count
    is zero are left out, as a filter before counting would; ties are cut by
    the key.
    """
    base = _flight_base(flights, min_year)
    if keep_fraction is not None:
        base = coalesce_by_fraction(base, keep_fraction)
    agg = base.groupingSets([["origin"], ["quarter"], ["origin", "dest"]], "origin", "quarter", "dest").agg(
        F.count(F.lit(1)).alias("_all"),
        F.count(F.when(F.col("depdelay") >= 15, 1)).alias("_d15"),
        F.count(F.when(F.col("depdelay") >= 60, 1)).alias("_d60"),
        F.count(F.when(F.col("cancelled") == 1, 1)).alias("_cx"),
        F.grouping_id().alias("_g"))
    if cache:
        agg = agg.persist()
    by_origin, by_quarter, by_route = 3, 5, 2      # grouping_id over (origin, quarter, dest)

    def top(level, keys, measure, name):
        rows = agg.filter((F.col("_g") == level) & (F.col(measure) > 0)).select(
            *keys, F.col(measure).alias(name))
        return top_k(rows, [F.col(name).desc()], k, tie_break=list(keys))

    return Reports({
        "departures": top(by_origin, ["origin"], "_all", "total_departures"),
        "delays_ge15": top(by_origin, ["origin"], "_d15", "total_delays_ge15"),
        "delays_ge60": top(by_origin, ["origin"], "_d60", "total_delays_ge60"),
        "cancellations_by_origin": top(by_origin, ["origin"], "_cx", "total_cancellations"),
        "cancellations_by_quarter": top(by_quarter, ["quarter"], "_cx", "total_cancellations"),
        "routes": top(by_route, ["origin", "dest"], "_all", "total_flights"),
    }, agg if cache else None)


# R12 -----------------------------------------------------------------------
def populous_zips(zips: DataFrame, min_pop: int, k: int | None = None) -> DataFrame:
    """Zips with population above ``min_pop``, largest first (ties by zip)."""
    df = zips.filter(F.col("pop") > min_pop).select("state", "city", "zip", "pop")
    order = [F.col("pop").desc(), F.col("zip")]
    return top_k(df, order, k) if k else df.orderBy(*order)


def state_population(zips: DataFrame, k: int | None = None) -> DataFrame:
    df = zips.groupBy("state").agg(F.sum("pop").cast("long").alias("sum_pop"))
    order = [F.col("sum_pop").desc(), F.col("state")]
    return top_k(df, order, k) if k else df.orderBy(*order)


def city_population(zips: DataFrame, state: str, k: int | None = None) -> DataFrame:
    """Cities of one state: number of zips and population, largest first."""
    df = zips.filter(F.col("state") == state).groupBy("city").agg(
        F.count("zip").alias("num_zips"), F.sum("pop").cast("long").alias("population"))
    order = [F.col("population").desc(), F.col("city")]
    return top_k(df, order, k) if k else df.orderBy(*order)


def city_population_sql(spark: SparkSession, view: str, state: str, k: int | None = None) -> DataFrame:
    """The same report as SQL text over a registered view."""
    lim = f" LIMIT {int(k)}" if k else ""
    return spark.sql(
        f"SELECT city, COUNT(zip) AS num_zips, CAST(SUM(pop) AS BIGINT) AS population "
        f"FROM {view} WHERE state = :state GROUP BY city "
        f"ORDER BY SUM(pop) DESC, city{lim}", args={"state": state})


def register_zip_to_int(spark: SparkSession, name: str = "zip_to_int") -> None:
    """SQL-callable ``zip_to_int(zip)`` (an Arrow-batched pandas UDF; the
    native equivalent is ``try_cast(zip AS INT)``)."""
    from logledger.functions.udfs import register_zip_to_int as reg
    reg(spark, name)


# R13 -----------------------------------------------------------------------
def access_records(lines: DataFrame) -> DataFrame:
    """Parsed access log with the time as UTC wall time ``dt``."""
    log = extract_access(lines)
    return log.select("client_identd", "content_size", log_time_to_utc("date_time").alias("dt"),
                      "endpoint", "ip_address", "response_code")


def access_value_join(lines: DataFrame, prices: DataFrame, price_col: str = "price",
                      keep: tuple[str, ...] = ("item_id", "brand"), salts: int | None = None,
                      partitions: int | None = None, hot_share: float | None = None) -> DataFrame:
    """Access records joined to a price list where price == content size, with
    year and month of the request.

    A hot size is a skewed partition: AQE's skew-join split handles it in the
    sort-merge plan, and the planner broadcasts the price list when its
    estimated size is small.  ``salts`` forces a salted join instead (hot sizes
    spread over that many tasks, the price list replicated per salt);
    ``hot_share`` finds the sizes that hold more than that share of the requests
    first, in a pass over the log, and salts these only;
    ``partitions`` deals the records first, for one-file logs whose sizes meet
    many prices.
    """
    log = access_records(lines)
    if partitions:
        log = spread(log, partitions)
    if salts:
        j = salted_join(log, prices, "content_size", price_col, salts)
    elif hot_share:
        j = hot_join(log, prices, "content_size", price_col, hot_share)
    else:
        j = prices.join(log, prices[price_col] == log["content_size"], "inner")
    return j.select(*keep, "ip_address", "endpoint", "content_size",
                    F.year("dt").alias("year"), F.month("dt").alias("month"))
