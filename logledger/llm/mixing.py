"""Mixing sources to target weights by weighted fair queueing.

Every source gets a target of tokens.  Its documents are shuffled, once per
epoch, and each copy gets a virtual finish time: the tokens of its source up
to and including it, divided by the source's target.  Sorting all copies of
all sources by finish time serves the sources in proportion to their targets;
the mix is that order, cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logledger.llm.common import n_words, prefix_sums

WEIGHTS = (3, 1, 2)
SHARE, EPOCHS = 1.5, 2
BUCKET = 10_000
SEED = 9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from one row (source, source_size) per source.

    Sources in code point order, null last, have the ``weights`` in turn.
    Their targets share ``share`` of all sizes by weight; no target exceeds
    ``most`` times its source's size, and the excess is reshared by weight
    until none does.  So target = min(most * size, level * weight) for one level:
    with sources by most * size / weight, the level is what is left for the
    first source that it doesn't fill.  The table has a row per source, so one
    task orders it.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    kinds = F.array(*[F.lit(w) for w in weights])
    w = sizes.withColumn("_w", F.get(kinds, F.pmod(turn, F.lit(len(weights)))).cast("double"))
    w = w.withColumn("_cap", F.col("source_size").cast("double") * most)
    by_fill = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    before, rest = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    everywhere = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("_level", (F.sum("source_size").over(everywhere) * F.lit(share)
                                - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(rest))
    w = w.withColumn("_first", F.when(F.col("_cap") / F.col("_w") >= F.col("_level"), F.col("_level")))
    w = w.withColumn("_first", F.first("_first", ignorenulls=True).over(everywhere))
    return w.select("source", "source_size", F.least(
        F.col("_cap"), F.coalesce(F.col("_first") * F.col("_w"), F.col("_cap"))).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
        seed: int = SEED, bucket: int = BUCKET, row: str | None = None) -> DataFrame:
    """One row per copy in reach: uid, key, source, size, source_size, target, epoch, finish, served, taken_copy.

    ``size`` is the number of words, ``finish`` the virtual finish time,
    ``served`` the words of the mix up to and including the copy, and
    ``taken_copy`` whether that is within the budget, the sum of the targets.
    ``uid`` names the row of ``docs``: its value of the column ``row``, which must
    be unique, or else a number given here.

    The order is total (finish time, source, epoch, hash of the key, key, text),
    so reruns agree, also on files split in another way.  Where a source has
    several rows of a key, the text and a number among the rows that are equal
    are hashed with the key; equal rows can change places.  A null text has size 0; documents of size 0 finish with
    their predecessor and are served if the budget lasts.  Null sources form a
    source of their own, repeated rows are documents of their own, null keys
    are allowed, an empty table gives an empty result.  Only the key, source
    and text are read; other columns don't matter.

    No task sees a whole source: the running sums go over hash buckets of
    about ``bucket`` copies, whatever the keys.
    """
    uid = F.col(row) if row else F.monotonically_increasing_id()
    sized = docs.select(F.col(key).alias("_key"), F.col(source).cast("string").alias("source"),
                        n_words(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("_text"), uid.alias("uid"))
    sized = sized.checkpoint()
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    targets = source_targets(sums.select("source", "source_size"), weights, share, epochs).alias("t")
    sums = sums.select(F.col("source").alias("_s"), "_docs").alias("s")
    plan = targets.join(sums, F.expr("source <=> _s")).drop("_s")
    plan = plan.withColumnRenamed("source", "_s").checkpoint()
    known = _apart(sized, bucket).join(plan, F.expr("source <=> _s")).drop("_s")
    copies = known.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), "epoch", "_apart", "_key").cast("binary")), 1, 13)
    unit = F.conv(digits, 16, 10).cast("long") / float(1 << 52)
    copies = copies.withColumn("_r", unit)
    copies = copies.withColumn("_b", F.col("epoch") + F.floor(
        F.col("_r") * F.ceil(F.col("_docs") / bucket)) / F.ceil(F.col("_docs") / bucket))
    ties = ["_key", "_apart", "uid"]
    run = prefix_sums(copies, ["source"], "_b", ["epoch", "_r", *ties], "size", "_run")
    run = run.withColumn("finish", F.when(F.col("target") > 0, F.col("_run") / F.col("target")).otherwise(
        F.col("epoch") + F.col("_r")))
    # the budget's end is at time 1, or a document past it: cut the times into slices of about a bucket
    total = plan.agg(F.coalesce(F.sum("_docs"), F.lit(0)).alias("n"),
                     F.coalesce(F.sum("target"), F.lit(0.0)).alias("budget")).first()
    slices = max(1, int(total["n"] * epochs // bucket))
    run = run.withColumn("_slice", F.floor(F.col("finish") * slices))
    served = prefix_sums(run, [], "_slice", ["finish", F.col("source").asc_nulls_last(), "epoch", "_r", *ties],
                         "size", "served")
    return served.select("uid", F.col("_key").alias(key), "source", "size", "source_size", "target", "epoch",
                         "finish", "served", (F.col("served") <= F.lit(total["budget"])).alias("taken_copy"))


def _apart(sized: DataFrame, bucket: int) -> DataFrame:
    """Adds ``_apart``: 0 where a source has one row of the key, else the text's hash and the row's number among equals.

    Equal rows are numbered by buckets, so no task sees all of them.
    """
    texts = sized.groupBy(F.col("_key").alias("_k"), F.col("source").alias("_s"), F.col("_text").alias("_t")).agg(
        F.count("*").alias("_equal"))
    many = texts.groupBy("_k", "_s").agg(F.sum("_equal").alias("_rows")).filter("_rows > 1").drop("_rows")
    equals = sized.join(texts.filter("_equal > 1"), F.expr("_key <=> _k and source <=> _s and _text = _t"))
    equals = equals.select("_k", "_s", "_t", F.col("uid").alias("_u"), F.lit(1).alias("_one"), F.pmod(
        F.xxhash64("uid"), F.ceil(F.col("_equal") / bucket)).alias("_b"))
    numbers = prefix_sums(equals, ["_k", "_s", "_t"], "_b", ["_u"], "_one", "_number").select("_u", "_number")
    known = sized.join(many.withColumn("_many", F.lit(True)), F.expr("_key <=> _k and source <=> _s"), "left")
    known = known.drop("_k", "_s").join(numbers, F.expr("uid = _u"), "left")
    return known.withColumn("_apart", F.when(F.col("_many"), F.concat_ws(
        "/", "_text", F.coalesce("_number", F.lit(1)))).otherwise("0")).drop("_many", "_number", "_u", "_text")


def in_order(mixed: DataFrame) -> DataFrame:
    """The copies that the mix takes, range-sorted by finish time: partitions in turn, sorted inside, are the mix."""
    order = ["finish", F.col("source").asc_nulls_last(), "epoch", "served"]
    return mixed.filter("taken_copy").repartitionByRange(*order).sortWithinPartitions(*order)


def taken(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document of the mix's input: key, source, size, source_size, target, copies, taken (words)."""
    return (mixed.groupBy("uid", key, "source", "size", "source_size", "target")
            .agg(F.count_if("taken_copy").alias("copies"),
                 F.sum(F.when(F.col("taken_copy"), F.col("size")).otherwise(0)).alias("taken")))


def oracle(docs: str = "documents") -> str:
    """DuckDB SQL of :func:`taken` with the default parameters, for documents whose keys differ."""
    weights = "[" + ", ".join(str(w) for w in WEIGHTS) + "]"
    return f"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> ''))::BIGINT AS size FROM {docs}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size::DOUBLE * {EPOCHS} AS cap, {weights}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1)
    % {len(WEIGHTS)}]::DOUBLE AS w FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE * {SHARE}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source
      NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT level FROM l WHERE cap / w >= level ORDER BY cap / w, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM f) * w, cap)) AS target FROM l),
c AS (SELECT d.*, source_size, target, epoch, ('0x' || substr(md5(concat_ws(':', {SEED}, epoch, 0, doc_id)), 1, 13))::BIGINT
      / {float(1 << 52)!r}::DOUBLE AS r FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, range({EPOCHS}) AS e(epoch)),
v AS (SELECT *, CASE WHEN target > 0 THEN (sum(size) OVER (PARTITION BY source ORDER BY epoch, r
      ROWS UNBOUNDED PRECEDING))::DOUBLE / target ELSE epoch + r END AS finish FROM c),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, r ROWS UNBOUNDED PRECEDING) AS served FROM v)
SELECT doc_id, size, source, source_size, target,
  sum(CASE WHEN served <= (SELECT sum(target) FROM t) THEN size ELSE 0 END)::BIGINT AS taken
FROM g GROUP BY doc_id, size, source, source_size, target"""
