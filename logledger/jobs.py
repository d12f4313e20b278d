"""spark-submit entry points with the argument lists of the original jobs.

    spark-submit -m logledger.jobs <job> <args...>     (or python -m logledger.jobs)

Each job reads its files, builds the report DataFrames and shows them.
Bounds use the original conventions (``-1`` upper = open).
"""

from __future__ import annotations

import os
import sys

if __package__ in (None, ""):      # run as a file: spark-submit logledger/jobs.py <job> ...
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from logledger.operators.extract import extract_resolver_raw, extract_states
from logledger.operators.filters import open_upper
from logledger.operators.observe import observed
from logledger.plans import overlays as ov
from logledger.plans import reconcile as rc
from logledger.plans import recommend as rm
from logledger.plans import reports as rp
from logledger.session import build_session, remove_scratch
from logledger.sources import counts as cn
from logledger.sources import files as fl
from logledger.sources.landing import RESOLVER_SCHEMA, STATE_SCHEMA, read_landed
from logledger.sources import ratings_files as ml

SHOW = 500


def _show(title: str, df, n: int = SHOW) -> None:
    print(title)
    df.show(n, truncate=False)


LANDED = "parquet:"
CONTENT_COLUMNS = {"SHOWTYPE": "int", "TMSID": "string", "SERIESTMSID": "string", "mfsid": "int",
                   "sourceProgramId": "long", "TITLE": "string"}
PRICE_COLUMNS = {"price": "int", "x": "double", "y": "double", "z": "double"}
STATION_COLUMNS = {"sourceStationId": "long", "mfsid": "int"}


def _side(spark, path, schema=None):
    """Raw log lines, or ``parquet:<folder>`` for rows landed by land-resolver /
    land-states (works the same on any file system)."""
    if path.startswith(LANDED):
        return read_landed(spark, path[len(LANDED):], schema or RESOLVER_SCHEMA)
    return fl.read_lines(spark, path)


def _rng(lo, hi):
    return (int(lo), open_upper(int(hi)))


def states(spark, control, candidate, *b):
    """Per-side state counts (bounds optional)."""
    c, d = _side(spark, control, STATE_SCHEMA), _side(spark, candidate, STATE_SCHEMA)
    cr, dr = (_rng(b[0], b[1]), _rng(b[2], b[3])) if len(b) >= 4 else (None, None)
    report = rc.state_report(c, d, cr, dr)
    for name, df in report.items():
        _show(name, df)
    report.release()


def states_crosstab(spark, control, candidate, cl, cu, dl, du):
    """R2: side-by-side counts by state, resource, resource+state, state+resource."""
    sides = {"control": _side(spark, control, STATE_SCHEMA), "candidate": _side(spark, candidate, STATE_SCHEMA)}
    seen = {s: observed(df, lambda lines, s=s: extract_states(lines, s)) for s, df in sides.items()}
    # all groupings from one pass over the logs; the small result is cached
    allg = rc.state_crosstab_all(seen["control"][0], seen["candidate"][0], _rng(cl, cu), _rng(dl, du), totals=True).persist()
    allg.count()
    for side, (_, counts) in seen.items():
        print(f"{side}:", counts.get())
    _show("parsed rows per side", allg.filter(F.col("grouping") == "total").select("control_sum", "candidate_sum"))
    for by, level in (("state", "state"), ("resource", "resource"),
                      ("resource_state", "resource_state"), ("state_resource", "resource_state")):
        keys = rc.STATE_GROUPINGS[by]
        _show(f"by {by}", allg.filter(F.col("grouping") == level)
              .select(*keys, "control_sum", "candidate_sum").orderBy(*keys))
    allg.unpersist()


def resolver_drift(spark, control, candidate, lower, upper, cl, cu, dl, du, count_only="false"):
    """Drift per resource (shared range or per-side ranges)."""
    sides = {"control": _side(spark, control), "candidate": _side(spark, candidate)}
    seen = {s: observed(df, lambda lines, s=s: extract_resolver_raw(lines, s)) for s, df in sides.items()}
    _show("drift by resource", rc.resolver_drift(
        seen["control"][0], seen["candidate"][0], _rng(lower, upper),
        _rng(cl, cu), _rng(dl, du), count_only.lower() == "true", totals=True))
    for side, (_, counts) in seen.items():
        print(f"{side}:", counts.get())


def resolver_shared(spark, control, candidate, lower, upper, count_only="false"):
    """Drift per resource in one shared range."""
    _show("drift by resource", rc.resolver_drift(
        _side(spark, control), _side(spark, candidate), _rng(lower, upper),
        count_only=count_only.lower() == "true", totals=True))


def resolver_details(spark, control, candidate, lower, upper, *resources, n=50):
    """The n largest matched discrepancies per resource."""
    _show("top discrepancies", rc.matched_differences(
        _side(spark, control), _side(spark, candidate), int(lower),
        open_upper(int(upper)), list(resources), n))


def resolver_one_sided(spark, control, candidate, lower, upper, state, *resources, n=SHOW):
    """Entries resolved on one side only, n per resource shown."""
    _show("one-sided entries", rc.one_sided_keys(
        _side(spark, control), _side(spark, candidate), int(lower), int(upper),
        state, list(resources), n))


def count_compare(spark, control, candidate, name, include_totals="false"):
    """Count files of two environments."""
    c = cn.parse_count_lines(fl.read_lines(spark, control))
    d = cn.parse_count_lines(fl.read_lines(spark, candidate))
    if include_totals.lower() == "true":
        _show("totals", rc.count_totals(c, d))
    _show(f"{name} count by resource", rc.count_compare(c, d))


def size_compare(spark, *named_paths):
    """name=path pairs of count files -> one wide table."""
    envs = dict(p.split("=", 1) for p in named_paths)
    _show("sizes by resource", rc.size_compare(
        {k: cn.parse_count_lines(fl.read_lines(spark, v)) for k, v in envs.items()}))


def content_overlays(spark, csv, out, fmt="parquet"):
    """Categorise, pack ids, count per type, write (overwrite)."""
    o = ov.content_overlays(fl.read_csv(spark, csv, columns=CONTENT_COLUMNS))
    _show("count by type", ov.overlay_type_counts(o))
    ov.save_overlays(o, None, fmt, out, run="content")


def station_overlays(spark, csv, out, fmt="parquet"):
    """Station ids packed and added; run again, the job replaces what it added."""
    ov.save_overlays(None, ov.station_overlays(fl.read_csv(spark, csv, columns=STATION_COLUMNS)), fmt, out, run="station")


def flights(spark, path):
    """Top-10 flight reports over parquet."""
    report = rp.flight_reports(fl.read_parquet(spark, path), 10, keep_fraction=2 / 3)
    for name, df in report.items():
        _show(name, df, 10)
    report.release()


def zips(spark, path, state="CA", min_pop="40000"):
    """Population reports, SQL twin, managed table, SQL UDF, catalogue."""
    from logledger import sinks
    z = fl.read_json_typed(spark, path)
    _show("population above", rp.populous_zips(z, int(min_pop), 10), 10)
    _show("states by population", rp.state_population(z, 10), 10)
    _show("cities", rp.city_population(z, state, 10), 10)
    z.createOrReplaceTempView("zips_table")
    _show("cities (SQL)", rp.city_population_sql(spark, "zips_table", state, 10), 10)
    spark.sql("DROP TABLE IF EXISTS zips_managed")
    sinks.save_table(z, "zips_managed")  # a managed table: dropping it above removed its files
    sinks.cache_table(spark, "zips_managed")
    rp.register_zip_to_int(spark)
    _show("zip_to_int", spark.sql("SELECT city, zip_to_int(zip) AS zip_int FROM zips_managed ORDER BY zip_int"), 10)
    _show("tables", sinks.list_tables(spark))


def weblog(spark, log, prices):
    """Access log joined to a price list by size = price."""
    names = spark.read.option("header", True).csv(prices).columns  # the header line only, types are known
    price_list = fl.read_csv(spark, prices, columns={c: k for c, k in PRICE_COLUMNS.items() if c in names})
    keep = tuple(c for c in ("x", "y", "z") if c in names)
    j = rp.access_value_join(fl.read_lines(spark, log), price_list, keep=keep)
    _show("archive ready", j, 10)


def _ml_inputs(spark, ratings, personal, movies):
    r = ml.read_ratings(spark, ratings)
    p = ml.read_ratings(spark, personal)
    m = ml.read_movies(spark, movies).select(F.col("id").alias("movie_id"), "title", "genres")
    return r, p, m


def _blocks(spark) -> int:
    """Width of the factorisation: ``--conf spark.logledger.als.blocks=`` about as many as the cluster has cores."""
    return int(spark.conf.get("spark.logledger.als.blocks", str(rm.BLOCKS)))


def recommend(spark, ratings, personal, movies, user="0"):
    """Tuned ALS, test gain, the unrated movies of the user, best first."""
    r, p, m = _ml_inputs(spark, ratings, personal, movies)
    report, recs = rm.recommender_job(r, m, p, int(user), k=None, blocks=_blocks(spark))
    _show("grid", report)
    _show("recommendations", recs, 50)


def recommend_source(spark, fmt, ratings, personal, movies, out, user="0"):
    """The recommender over any data-source format, result written back."""
    _show("written", rm.recommender_from_source(
        spark, fmt, ratings, personal, movies, out, int(user), blocks=_blocks(spark)))


def recommend_coldstart(spark, ratings, personal, movies, user="0", other="6001"):
    """Cold-start drop, grid, both kinds of top 10 for the new user and an existing one."""
    r, p, m = _ml_inputs(spark, ratings, personal, movies)
    for name, df in rm.coldstart_job(r, p, m, [int(user), int(other)], blocks=_blocks(spark)).items():
        _show(name, df)


def recommend_cv(spark, ratings, personal, movies, out_dir, user="0"):
    """10-fold CV, all-user top 10 as CSV, CV model saved and reloaded."""
    r, p, m = _ml_inputs(spark, ratings, personal, movies)
    table, mine = rm.cross_validated_job(r, p, m, int(user), f"{out_dir}/recommendations",
                                         f"{out_dir}/cv-model", blocks=_blocks(spark))
    _show("cross validation", table)
    _show("user", mine)


def land_resolver(spark, lines, side, out):
    """Parse resolver lines once into parquet partitioned by resource; every
    reconciliation job accepts the landed folder in place of raw logs."""
    from logledger.sources.landing import land_resolver as land
    land(fl.read_lines(spark, lines), side, out)


def land_states(spark, lines, side, out):
    """Parse publish-state lines once into parquet partitioned by resource."""
    from logledger.sources.landing import land_states as land
    land(fl.read_lines(spark, lines), side, out)


def convert_delimited(spark, movies, out):
    """K10: '::' movie file -> CSV with header (titles with commas quoted)."""
    ml.movies_to_csv(ml.read_movies(spark, movies), out)


JOBS = {name.replace("_", "-"): fn for name, fn in list(globals().items())
        if callable(fn) and getattr(fn, "__module__", "") == __name__ and not name.startswith("_")
        and name not in ("main",)}


def main(argv: list[str] | None = None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in JOBS:
        print("jobs: " + ", ".join(sorted(JOBS)))
        sys.exit(2)
    spark = build_session()
    try:
        JOBS[argv[0]](spark, *argv[1:])
    finally:
        remove_scratch(spark)


if __name__ == "__main__":
    main()
