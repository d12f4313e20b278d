"""Log, catalogue, zip, flight and rating inputs rendered from the driver tables.

The reconciled logs, count files, catalogue files, zips, flights and rating
files of the original jobs are not shipped.  Each renderer derives the same
shape from a driver table with Spark (so its size follows the table), and the
jobs then read it back through the real extraction path.  The rules below are
the fixture recipes; ``logledger.queries`` states the same rules in SQL for
the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixture constants (our own choice; the oracle SQL repeats them).
# ---------------------------------------------------------------------------
STATE_PUB_BASE = 25_000_000_000          # state log: pub_id = base + o_orderkey
RESOLVER_PUB_BASE = 10_000_000_000       # resolver log: base + orderkey*10 + linenumber
STATE_CONTROL_GAP, STATE_CANDIDATE_GAP = 17, 13     # every n-th order from a listener of two digits
LISTENERS = 12                           # listeners 0..11; 10 and 11 fail the 1-digit test
DETAIL_CONTROL_GAP, DETAIL_CANDIDATE_GAP = 3, 4     # every n-th order in a line that is not a resolution
DETAIL_BUMP_EVERY, DETAIL_BUMP_SUPP, DETAIL_BUMP_STEP = 5, 7, 6
ACCESS_OFFSET = "-0800"
ACCESS_BAD_EVERY = 11                    # every 11th event has size '-' (line dropped)
ACCESS_IPS = 250
ACCESS_HOT_EVERY, ACCESS_HOT_REST, HOT_SIZE = 10, 3, 0  # a tenth of the requests have one size
PRICE_STEP = 5                           # price = part key * 5: about one request each


def _state_word(status: Column) -> Column:
    return (F.when(status == "O", "PUBLISH").when(status == "F", "NOPUBLISH")
            .when(status == "P", "UNPUBLISH"))


def _state_resource(priority: Column) -> Column:
    return F.lower(F.regexp_replace(F.substr(priority, F.lit(3)), " ", "_"))


def state_lines(orders: DataFrame, side: str) -> DataFrame:
    """Publish-state log lines of one side from ``orders``, one per order.

    Every gap-th order comes from listener 10 or later, which extraction
    refuses: that is how the sides come to differ."""
    gap = STATE_CONTROL_GAP if side == "control" else STATE_CANDIDATE_GAP
    sep = " " if side == "control" else "-"
    listener = F.col("o_custkey") % LISTENERS + F.when(F.col("o_orderkey") % gap == 0, 10).otherwise(0)
    line = _text("2017-02-06 10:00:00,123 INFO  [listener-", listener, "] - ",
                 _state_word(F.col("o_orderstatus")), " ", _state_resource(F.col("o_orderpriority")),
                 sep, F.col("o_orderkey"), " (", F.col("o_orderkey") + F.lit(STATE_PUB_BASE),
                 ") transform done")
    return orders.select(line.alias("value"))


def _text(*parts) -> Column:
    """Concatenation of literals and columns (numbers as decimal text); null if
    any part is null.  Cheaper per row than a format string."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _resolver_line(side: str, resource: Column, orderkey: Column, pub: Column,
                   old: Column, dirty: Column, listener: Column, verb: Column | None = None) -> Column:
    sep = " " if side == "control" else "-"
    return _text("INFO [listener-", listener, "] - ", F.lit("RESOLVE ") if verb is None else verb, resource, sep,
                 orderkey, " (", pub, " replacing ", old, ") , ", dirty, " dirty entries merged")


def _resolver_parts(li: DataFrame) -> dict[str, Column]:
    pub = (F.lit(RESOLVER_PUB_BASE) + F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return {
        "resource": F.concat(F.lit("Res"), F.col("l_returnflag"), F.col("l_linestatus")),
        "orderkey": F.col("l_orderkey"),
        "pub": pub,
        "old": F.when(F.col("l_linenumber") % 3 == 0, F.lit("empty")).otherwise((pub - 1).cast("string")),
        "dirty": F.col("l_quantity").cast("int"),
        "listener": F.col("l_suppkey") % 16,
    }


# Candidate dirty size per resource in the drift logs (control size d):
# AF doubles, AO grows by a fifth, NO shrinks by a fifth, RF halves,
# RO gains one per line, NF is unchanged.
def _drift_candidate_dirty(resource: Column, d: Column) -> Column:
    return (F.when(resource == "ResAF", d * 2)
            .when(resource == "ResAO", F.floor(d * 6 / 5).cast("int"))
            .when(resource == "ResNO", F.floor(d * 4 / 5).cast("int"))
            .when(resource == "ResRF", F.floor(d / 2).cast("int"))
            .when(resource == "ResRO", d + 1)
            .otherwise(d))


def resolver_drift_lines(lineitem: DataFrame, side: str) -> DataFrame:
    """Resolver lines for the drift report: both sides carry every row; the
    candidate's dirty sizes drift per resource (see ``_drift_candidate_dirty``)."""
    p = _resolver_parts(lineitem)
    dirty = p["dirty"] if side == "control" else _drift_candidate_dirty(p["resource"], p["dirty"])
    return lineitem.select(_resolver_line(side, p["resource"], p["orderkey"], p["pub"],
                                          p["old"], dirty, p["listener"]).alias("value"))


def resolver_detail_lines(lineitem: DataFrame, side: str) -> DataFrame:
    """Resolver lines for the detail reports, one per row: each side postpones a
    different set of orders (extraction drops those lines), and the
    candidate's size grows on every 5th order."""
    gap = DETAIL_CONTROL_GAP if side == "control" else DETAIL_CANDIDATE_GAP
    verb = F.when(F.col("l_orderkey") % gap == 0, "POSTPONE ").otherwise("RESOLVE ")
    p = _resolver_parts(lineitem)
    dirty = p["dirty"]
    if side == "candidate":
        dirty = dirty + F.when(F.col("l_orderkey") % DETAIL_BUMP_EVERY == 0,
                               (F.col("l_suppkey") % DETAIL_BUMP_SUPP) * DETAIL_BUMP_STEP).otherwise(0)
    return lineitem.select(_resolver_line(side, p["resource"], p["orderkey"], p["pub"],
                                          p["old"], dirty, p["listener"], verb).alias("value"))


def access_lines(events: DataFrame) -> DataFrame:
    """Access-log lines from ``events`` (time written as local time at -0800)."""
    hot = F.col("event_id") % ACCESS_HOT_EVERY == ACCESS_HOT_REST
    size = F.when(F.col("event_id") % ACCESS_BAD_EVERY == 0, F.lit("-")).when(
        hot, F.lit(str(HOT_SIZE))).otherwise(F.col("event_id").cast("string"))
    line = _text("10.0.0.", F.col("user_id") % ACCESS_IPS, " - - [",
                 F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), " " + ACCESS_OFFSET + '] "GET /',
                 F.col("event_type"), ' HTTP/1.1" ',
                 F.when(F.col("event_type") == "error", 500).otherwise(200), " ", size)
    return events.select(line.alias("value"))


def price_list(part: DataFrame) -> DataFrame:
    """Price list keyed by part, one price each; part 1 has the requests' hot size."""
    price = F.when(F.col("p_partkey") == 1, HOT_SIZE).otherwise(F.col("p_partkey") * PRICE_STEP).cast("int")
    return part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
                       F.col("p_brand").alias("brand"), price.alias("price"))


# count files ---------------------------------------------------------------
def priority_counts(orders: DataFrame, env: str) -> DataFrame:
    """(resource, count) per order priority for one environment; every order counts somewhere.

    control: ``5-LOW`` is kept under a name with the prefix ``MX``; candidate:
    orders with an odd key are under names with ``Published``; third: orders
    whose key is no multiple of 3 are under ``Other``.
    """
    name = F.col("o_orderpriority")
    if env == "control":
        resource = F.when(name == "5-LOW", F.concat(F.lit("MX"), name)).otherwise(name)
    elif env == "candidate":
        resource = F.when(F.col("o_orderkey") % 2 == 0, name).otherwise(F.concat(F.lit("Published"), name))
    elif env == "third":
        resource = F.when(F.col("o_orderkey") % 3 == 0, name).otherwise(F.lit("Other"))
    else:
        raise ValueError(env)
    return orders.groupBy(resource.alias("resource")).agg(F.count(F.lit(1)).alias("count"))


# catalogue -----------------------------------------------------------------
SERIES_MULT, SERIES_MOD, SERIES_BAD_EVERY = 104_729, 10_000_000_000, 97
PROGRAM_BASE, STATION_BASE = 5_000_000, 9_000_000


def content_overlay_rows(part: DataFrame) -> DataFrame:
    """Content overlay catalogue (its original column names) from ``part``."""
    key = F.col("p_partkey")
    series = F.when(key % SERIES_BAD_EVERY == 0, F.lit("SHxxxxxxxxxx")).otherwise(
        F.concat(F.lit("SH"), F.lpad(((key * SERIES_MULT) % SERIES_MOD).cast("string"), 10, "0")))
    tms = F.concat(F.when(F.col("p_type").startswith("E"), F.lit("EP")).otherwise(F.lit("MV")),
                   F.lpad(key.cast("string"), 10, "0"))
    return part.select((F.col("p_size") % 10).alias("SHOWTYPE"), tms.alias("TMSID"),
                       series.alias("SERIESTMSID"), key.cast("int").alias("mfsid"),
                       (key + PROGRAM_BASE).alias("sourceProgramId"), F.col("p_name").alias("TITLE"))


def station_overlay_rows(supplier: DataFrame) -> DataFrame:
    return supplier.select((F.col("s_suppkey") + STATION_BASE).alias("sourceStationId"),
                           F.col("s_suppkey").cast("int").alias("mfsid"))


# zips and flights ----------------------------------------------------------
def zips_rows(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Zip-code rows: state = nation, city = market segment, pop = int balance.

    ``nation`` is a fixed 25-row dimension, so it is broadcast."""
    c = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    key = F.col("c_custkey").cast("string")
    return c.select(F.when(F.length(key) < 5, F.lpad(key, 5, "0")).otherwise(key).alias("_id"),
                    F.col("c_mktsegment").alias("city"),
                    F.array(F.col("c_acctbal"), F.col("n_nationkey").cast("double")).alias("loc"),
                    F.col("c_acctbal").cast("long").alias("pop"),
                    F.col("n_name").alias("state"))


def flights_from_events(events: DataFrame) -> DataFrame:
    """Departures: origin = user, delay = value (minutes)."""
    return events.select(F.year("ts").alias("year"), F.quarter("ts").alias("quarter"),
                         F.col("user_id").alias("origin"), F.col("event_type").alias("dest"),
                         F.col("value").alias("depdelay"), F.lit(0).alias("cancelled"))


def flights_from_orders(orders: DataFrame) -> DataFrame:
    """Flights: origin = customer, quarter of the order date, cancelled = status F."""
    return orders.select(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"),
                         F.col("o_custkey").alias("origin"), F.lit(None).cast("long").alias("dest"),
                         F.lit(0.0).alias("depdelay"),
                         F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("cancelled"))


ROUTES = 25


def routes(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Flights on routes (customer mod 25, supplier mod 25), one per line item."""
    j = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    return j.select(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"),
                    (F.col("o_custkey") % ROUTES).alias("origin"),
                    (F.col("l_suppkey") % ROUTES).alias("dest"),
                    F.lit(0.0).alias("depdelay"), F.lit(0).alias("cancelled"))


# ratings and movies --------------------------------------------------------
def rating_value(user: Column, item: Column) -> Column:
    """Planted rating 1..5: ``1 + (4*(user%7+1)*(item%5+1)) div 35``."""
    return (F.lit(1) + F.floor((F.lit(4) * (user % 7 + 1) * (item % 5 + 1)) / F.lit(35))).cast("int")


def rating_pairs(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (user_id, movie_id, rating) from who bought which part."""
    j = lineitem.select("l_orderkey", "l_partkey").join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = j.select(F.col("o_custkey").cast("int").alias("user_id"),
                     F.col("l_partkey").cast("int").alias("movie_id")).distinct()
    return pairs.withColumn("rating", rating_value(F.col("user_id"), F.col("movie_id")))


def rating_lines(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.concat_ws(
        "::", F.col("user_id").cast("string"), F.col("movie_id").cast("string"),
        F.col("rating").cast("string"), (F.lit(978300000) + F.col("movie_id")).cast("string")
    ).alias("value"))


SHORT_EVERY, WORD_EVERY = 19, 23         # broken lines: a field is missing, or a word stands for a number


def broken_rating_lines(ratings: DataFrame) -> DataFrame:
    """:func:`rating_lines` with some broken: every 19th sum of ids lacks its time, every 23rd has no rating."""
    both = F.col("user_id") + F.col("movie_id")
    good = F.concat_ws("::", F.col("user_id").cast("string"), F.col("movie_id").cast("string"),
                       F.when(both % WORD_EVERY == 0, F.lit("n/a")).otherwise(F.col("rating").cast("string")))
    return ratings.select(F.when(both % SHORT_EVERY == 0, good).otherwise(
        F.concat(good, F.lit("::"), (F.lit(978300000) + F.col("movie_id")).cast("string"))).alias("value"))


MOVIE_TRAILING_EVERY = 11


def movie_lines(part: DataFrame) -> DataFrame:
    """``id::title::type|brand``; every 11th part ends its genres with a bare ``|``."""
    genres = F.when(F.col("p_partkey") % MOVIE_TRAILING_EVERY == 0,
                    F.concat(F.col("p_type"), F.lit("|"))).otherwise(
        F.concat_ws("|", F.col("p_type"), F.col("p_brand")))
    return part.select(F.concat_ws("::", F.col("p_partkey").cast("string"), F.col("p_name"),
                                   genres).alias("value"))


def broken_movie_lines(part: DataFrame) -> DataFrame:
    """:func:`movie_lines` with some broken: every 19th id has a letter before it, every 23rd no genres."""
    key = F.col("p_partkey")
    head = F.concat(F.when(key % SHORT_EVERY == 0, F.lit("m")).otherwise(F.lit("")), key.cast("string"))
    return part.select(F.when(key % WORD_EVERY == 0, F.concat_ws("::", head, F.col("p_name"))).otherwise(
        F.concat_ws("::", head, F.col("p_name"), F.concat_ws("|", F.col("p_type"), F.col("p_brand")))).alias("value"))


def broken_count_lines(orders: DataFrame) -> DataFrame:
    """A count line per customer; every 19th has no count, every 23rd a count of words."""
    key = F.col("o_custkey")
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("string").alias("n"))
    name = F.concat(F.lit("Customer"), key.cast("string"))
    return counts.select(F.when(key % SHORT_EVERY == 0, name).when(key % WORD_EVERY == 0, F.concat(name, F.lit(" - many")))
                         .otherwise(F.concat(name, F.lit(" - "), F.col("n"))).alias("value"))


def split_bucket(user: Column, item: Column) -> Column:
    """Deterministic split bucket 0..9 of a rating: (user*31 + item*17) % 10."""
    return (user.cast("long") * 31 + item.cast("long") * 17) % 10
