"""Two-environment reconciliation reports (control vs candidate).

Inputs are line tables (column ``value``) of each side, or the extracted rows
landed by ``logledger.sources.landing``; outputs are report DataFrames.
Ranges are inclusive ``(lower, upper)`` tuples, ``None`` = open.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.functions.flags import drift_flag
from logledger.functions.text import signed_text
from logledger.operators.aggregate import Reports, group_count, side_sums
from logledger.operators.extract import (extract_resolver_raw, extract_resolver_tagged,
                                         extract_states, is_lines, tag_side)
from logledger.operators.filters import open_upper, within, within_any
from logledger.operators.topk import top_n_per_group
from logledger.sources.landing import MATCH_KEYS

Range = tuple[int | None, int | None]

# R1 ------------------------------------------------------------------------
STATE_GROUPINGS = {"state": ["state"], "resource": ["resource"],
                   "resource_state": ["resource", "state"], "state_resource": ["state", "resource"]}


def states_in_range(lines: DataFrame, side: str, rng: Range | None = None,
                    listener_digits: int = 1, states: Sequence[str] | None = None) -> DataFrame:
    """One side's state rows in the pub_id range, optionally only some states."""
    df = extract_states(lines, side, listener_digits)
    if rng:
        df = df.filter(within("pub_id", *rng))
    return df.filter(F.col("state").isin(list(states))) if states else df


def state_counts(lines: DataFrame, side: str, rng: Range | None = None, by: str = "resource_state",
                 listener_digits: int = 1) -> DataFrame:
    """Row count of one side's states per grouping, sorted by the grouping keys."""
    keys = STATE_GROUPINGS[by]
    return group_count(states_in_range(lines, side, rng, listener_digits), keys).orderBy(*keys)


def state_report(control: DataFrame, candidate: DataFrame, control_range: Range | None = None,
                 candidate_range: Range | None = None, listener_digits: int = 1,
                 cache: bool = True) -> Reports:
    """The six tables of the per-side state summary (by state, by resource, by
    both, for each side) from one scan of each log and one grouping-sets
    aggregate; the aggregate (one row per key) is kept in memory until the
    result's ``release()``."""
    c = states_in_range(control, "control", control_range, listener_digits).withColumn("side", F.lit("control"))
    d = states_in_range(candidate, "candidate", candidate_range, listener_digits).withColumn(
        "side", F.lit("candidate"))
    g = c.unionByName(d).groupingSets(
        [["side", "state"], ["side", "resource"], ["side", "resource", "state"]],
        "side", "resource", "state").agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_g"))
    if cache:
        g = g.persist()
    level = {"state": 2, "resource": 1, "resource_state": 0}   # grouping_id over (side, resource, state)
    out = {}
    for side in ("control", "candidate"):
        for by, gid in level.items():
            keys = STATE_GROUPINGS[by]
            out[f"{side}_by_{by}"] = (g.filter((F.col("_g") == gid) & (F.col("side") == side))
                                      .select(*keys, "count").orderBy(*keys))
    return Reports(out, g if cache else None)


# R2 ------------------------------------------------------------------------
def tagged_states(control: DataFrame, candidate: DataFrame, control_range: Range | None,
                  candidate_range: Range | None, listener_digits: int = 1) -> DataFrame:
    """Both sides as one table with side indicator columns (a union, no shuffle)."""
    c = tag_side(states_in_range(control, "control", control_range, listener_digits), "control")
    d = tag_side(states_in_range(candidate, "candidate", candidate_range, listener_digits), "candidate")
    return c.unionByName(d)


def state_crosstab(control: DataFrame, candidate: DataFrame, control_range: Range | None = None,
                   candidate_range: Range | None = None, by: str = "resource_state",
                   listener_digits: int = 1) -> DataFrame:
    """Side-by-side state counts (control_sum, candidate_sum) for one grouping."""
    keys = STATE_GROUPINGS[by]
    t = tagged_states(control, candidate, control_range, candidate_range, listener_digits)
    return side_sums(t, keys).orderBy(*keys)


def state_crosstab_all(control: DataFrame, candidate: DataFrame, control_range: Range | None = None,
                       candidate_range: Range | None = None, listener_digits: int = 1,
                       totals: bool = False) -> DataFrame:
    """All groupings of the crosstab from one scan and one aggregate (grouping sets).

    ``grouping`` names the level (state / resource / resource_state); the key
    not in that level is null.  The state-then-resource table is the
    resource_state level in another order.  ``totals`` adds a ``total`` row:
    the number of parsed rows per side, from the same pass.
    """
    t = tagged_states(control, candidate, control_range, candidate_range, listener_digits)
    sets = [["state"], ["resource"], ["resource", "state"]] + ([[]] if totals else [])
    g = t.groupingSets(sets, "resource", "state").agg(
        F.sum("control_n").cast("long").alias("control_sum"),
        F.sum("candidate_n").cast("long").alias("candidate_sum"),
        F.grouping_id().alias("_gid"))
    level = (F.when(F.col("_gid") == 1, "resource").when(F.col("_gid") == 2, "state")
             .when(F.col("_gid") == 3, "total").otherwise("resource_state"))
    return (g.select(level.alias("grouping"), "resource", "state", "control_sum", "candidate_sum")
            .orderBy("grouping", "resource", "state"))


# R3 / R4 -------------------------------------------------------------------
TOTAL = "(total)"


def resolver_drift(control: DataFrame, candidate: DataFrame, shared: Range | None,
                   control_range: Range | None = None, candidate_range: Range | None = None,
                   count_only: bool = False, totals: bool = False) -> DataFrame:
    """Per-resource dirty-size (or line-count) sums of both sides, signed
    difference text and severity flag.

    A line is kept when its pub_id is in the shared range or in its side's own
    range.  Hot resources only meet the partial (map-side) aggregate, so the
    shuffle carries one row per resource per task.  ``totals`` adds a
    ``(total)`` row over all resources (in count mode: the parsed line count
    of each side) from the same aggregate.
    """
    c = extract_resolver_tagged(control, "control", count_only).filter(
        within_any("pub_id", shared, control_range))
    d = extract_resolver_tagged(candidate, "candidate", count_only).filter(
        within_any("pub_id", shared, candidate_range))
    u = c.unionByName(d)
    if totals:
        s = u.groupingSets([["resource"], []], "resource").agg(
            F.sum("control_n").cast("long").alias("control_sum"),
            F.sum("candidate_n").cast("long").alias("candidate_sum"),
            F.grouping_id().alias("_g"))
        s = s.withColumn("resource", F.when(F.col("_g") == 1, F.lit(TOTAL)).otherwise(F.col("resource")))
    else:
        s = side_sums(u, ["resource"])
    diff = F.col("candidate_sum") - F.col("control_sum")
    return (s.select("resource", "control_sum", "candidate_sum",
                     signed_text(diff).alias("difference"),
                     drift_flag(F.col("control_sum"), diff).alias("flag"))
            .orderBy("resource"))


# R5 ------------------------------------------------------------------------
def matched_differences(control: DataFrame, candidate: DataFrame, lower: int | None,
                        upper: int | None, resources: Sequence[str], n: int | None = 50,
                        bucketed: bool = False) -> DataFrame:
    """Entries resolved on both sides (same pub_id, resource, rovi_id, old id)
    whose dirty sizes differ most, first ``n`` per resource by |difference|.

    One join and one windowed top-n for all resources; the join key holds the
    publication id, so a hot resource spreads over all partitions.  Rows landed
    in buckets of that key (``logledger.sources.landing.land_resolver_table``)
    meet where they lie: ``bucketed`` asks for the merge join, which needs no
    exchange of either side.
    """
    def side(lines, dialect, name):
        return (extract_resolver_raw(lines, dialect, resources)
                .filter(within("pub_id", lower, upper))
                .select(*MATCH_KEYS, F.col("dirty_size").alias(name)))

    a, b = side(control, "control", "control_dirty_size"), side(candidate, "candidate", "candidate_dirty_size")
    j = (a.hint("merge") if bucketed else a).join(b, MATCH_KEYS, "inner")
    diff = F.col("candidate_dirty_size") - F.col("control_dirty_size")
    j = j.withColumn("_diff", diff)
    top = top_n_per_group(j, ["resource"],
                          [F.abs("_diff").desc(), "rovi_id", "pub_id", "old_pub_id",
                           "control_dirty_size", "candidate_dirty_size"], n)
    return (top.select("resource", "rovi_id", "pub_id", "old_pub_id", "control_dirty_size",
                       "candidate_dirty_size", signed_text("_diff").alias("difference"))
            .orderBy("resource", F.abs(F.col("candidate_dirty_size") - F.col("control_dirty_size")).desc(),
                     "rovi_id", "pub_id"))


# R6 ------------------------------------------------------------------------
def one_sided_keys(control: DataFrame, candidate: DataFrame, lower: int | None, upper: int | None,
                   state: str, resources: Sequence[str], n: int | None = None) -> DataFrame:
    """Entries (resource, rovi_id, state) resolved on one side only.

    Equivalent to a full outer join keeping rows with a missing side: a mask of
    the sides that have a key is aggregated (partially before the shuffle), and
    the rows are joined to the keys of one side.  That join is the only exchange
    of rows, and one that AQE can split, so a key with a large part of the log
    is not one task's work; keys repeated on both sides cannot multiply rows.
    Rows and masks are two readings of the same extraction: raw lines are
    scanned once, and the rows that fit the filters checkpointed.

    Control-only rows (flag 0) come first.  With ``n``, the first n rows of each
    resource in order; without, all rows, unsorted: the result is as large as
    what differs.
    """
    keys = ["resource", "rovi_id", "state"]

    def side(lines, dialect, flag):
        return (extract_resolver_raw(lines, dialect, resources)
                .filter(within("rovi_id", lower, open_upper(upper)) & (F.col("state") == state))
                .select(*keys, "pub_id", "dirty_size", F.lit(flag).alias("flag")))

    both = side(control, "control", 0).unionByName(side(candidate, "candidate", 1))
    if is_lines(control) or is_lines(candidate):
        both = both.checkpoint()
    masks = both.groupBy(*keys).agg(F.bit_or(F.col("flag") + 1).alias("_sides")).filter("_sides < 3")
    masks = masks.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
    # one mask a key, so no row is repeated (a semi join would go below the union and aggregate the masks twice)
    both = both.join(masks, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
    only = lambda c, flag: F.when(F.col("flag") == flag, F.col(c))
    both = both.select(
        "resource", "rovi_id", "flag",
        only("pub_id", 0).alias("control_pub_id"), only("dirty_size", 0).alias("control_dirty_size"),
        only("pub_id", 1).alias("candidate_pub_id"), only("dirty_size", 1).alias("candidate_dirty_size"))
    order = ["flag", "control_pub_id", "candidate_pub_id", "rovi_id"]
    if n is not None:
        both = top_n_per_group(both, ["resource"], order, n).orderBy("resource", *order)
    return both.drop("flag")


# R7 / R8 -------------------------------------------------------------------
EXCLUDED_PREFIXES = ("MX", "Published")


def count_compare(control_counts: DataFrame, candidate_counts: DataFrame) -> DataFrame:
    """Per-resource counts of both environments; every candidate resource is
    kept (right outer), a missing control count makes the difference the
    candidate count."""
    c = control_counts.select("resource", F.col("count").alias("control_count"))
    d = candidate_counts.select("resource", F.col("count").alias("candidate_count"))
    j = c.join(d, ["resource"], "right_outer")
    diff = F.when(F.col("control_count").isNull(), F.col("candidate_count")).otherwise(
        F.col("candidate_count") - F.col("control_count"))
    return (j.select("resource", "control_count", "candidate_count", signed_text(diff).alias("difference"))
            .orderBy("resource"))


def count_totals(control_counts: DataFrame, candidate_counts: DataFrame,
                 exclude_prefixes: Sequence[str] = EXCLUDED_PREFIXES) -> DataFrame:
    """One row: total count per environment without excluded resource prefixes,
    and their difference.  Both totals come from one aggregate."""
    keep = F.lit(True)
    for p in exclude_prefixes:
        keep = keep & ~F.col("resource").startswith(p)
    u = (control_counts.select("count", F.lit(0).alias("_s"), "resource")
         .unionByName(candidate_counts.select("count", F.lit(1).alias("_s"), "resource"))
         .filter(keep))
    t = u.agg(F.sum(F.when(F.col("_s") == 0, F.col("count"))).cast("long").alias("control_total"),
              F.sum(F.when(F.col("_s") == 1, F.col("count"))).cast("long").alias("candidate_total"))
    return t.withColumn("diff", F.col("candidate_total") - F.col("control_total"))


def size_compare(envs: Mapping[str, DataFrame], value: str = "count") -> DataFrame:
    """Wide table ``resource, <value>_<env>...`` over any number of environments.

    Same rows as a chain of full outer joins on resource (null where an
    environment lacks the resource), computed as one union and one aggregate.
    """
    names = list(envs)
    u = None
    for i, name in enumerate(names):
        part = envs[name].select("resource", F.col(value).alias("_v"), F.lit(i).alias("_e"))
        u = part if u is None else u.unionByName(part)
    aggs = [F.sum(F.when(F.col("_e") == i, F.col("_v"))).cast("long").alias(f"{value}_{name}")
            for i, name in enumerate(names)]
    return u.groupBy("resource").agg(*aggs).orderBy("resource")
