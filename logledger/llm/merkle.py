"""Merkle manifest of a dataset: leaves, subroots, root and proofs by concatenated-level strings.

Every row is a leaf, the hash of its fields.  The leaves of a group ascend by
key; every ``FAN`` consecutive nodes become their hash until one remains, the
group's subroot, and the subroots become the root in the same way.  A block of
``FAN ** DEPTH`` aligned nodes keeps each of its levels as one string of hex
digests: parents are hashes of its substrings of fixed width, and the
substrings beside a node are its siblings.  The blocks' tops are the nodes of
the next round, so the rounds grow with the logarithm of a group, and no task
holds more than a block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the manifest: digests are lowercase hex of SHA-256, runs have three nodes.
WIDTH, FAN = 64, 3
DEPTH = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``_pos``: the row's number, from 0, in its ``group`` by ``order``, which must be total.

    Rows are range-partitioned by (group, order), written, and numbered inside
    each partition; what comes before in the group is added from counts per
    (partition, group), of which a group has as many as partitions.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = ranged.withColumns({"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id().bitwiseAND(
        (1 << 33) - 1)}).checkpoint()
    counts = ranged.groupBy("_part", F.col(group).alias("_og")).agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    earlier = Window.partitionBy("_og").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_op"), "_og", (
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = ranged.join(offsets, (F.col("_part") == F.col("_op")) & F.col(group).eqNullSafe(F.col("_og")))
    return placed.withColumn("_pos", F.col("_seq") + F.col("_shift")).drop("_part", "_seq", "_op", "_og", "_shift")


def _level_up(level: str) -> Column:
    """The hashes of a level's runs, as one string."""
    run = FAN * WIDTH
    return F.expr(f"array_join(transform(sequence(0, (length({level}) - 1) div {run}),"
                  f" i -> sha2(substring({level}, i * {run} + 1, {run}), 256)), '')")


def _blocks(nodes: DataFrame, group: str, items: list[str]) -> DataFrame:
    """One row per block of nodes (group, _pos, _hash, items): _block, _items, _more, _l0 .. _lDEPTH.

    ``_more`` tells whether the group has other blocks.  A level of one node
    ends a group of one block: the levels above repeat it.
    """
    size = FAN ** DEPTH
    member = F.struct("_pos", "_hash", *items)
    blocks = nodes.groupBy(group, F.expr(f"_pos div {size}").alias("_block")).agg(
        F.sort_array(F.collect_list(member)).alias("_items"))
    most = blocks.groupBy(F.col(group).alias("_mg")).agg((F.max("_block") > 0).alias("_more"))
    blocks = blocks.join(most, F.col(group).eqNullSafe(F.col("_mg"))).drop("_mg")
    blocks = blocks.withColumn("_l0", F.array_join("_items._hash", ""))
    for j in range(DEPTH):
        going = F.col("_more") | (F.length(f"_l{j}") > WIDTH)
        blocks = blocks.withColumn(f"_l{j + 1}", F.when(going, _level_up(f"_l{j}")).otherwise(F.col(f"_l{j}")))
    return blocks.checkpoint()


def _siblings(place: str) -> list[tuple[str, Column, Column]]:
    """(condition, left, right) of the node number ``place`` of a block for each level that is hashed further."""
    found = []
    for j in range(DEPTH):
        at = f"(({place}) div {FAN ** j})"
        left = F.expr(f"substring(_l{j}, cast(({at} - {at} % {FAN}) * {WIDTH} + 1 as int), cast({at} % {FAN} * {WIDTH} as int))")
        right = F.expr(f"substring(_l{j}, cast(({at} + 1) * {WIDTH} + 1 as int),"
                       f" cast(({FAN - 1} - {at} % {FAN}) * {WIDTH} as int))")
        found.append((f"_more or length(_l{j}) > {WIDTH}", left, right))
    return found


def _segments(place: str) -> Column:
    """The levels above a node of a block as an array of (l, r): its siblings before and after it."""
    levels = [F.when(F.expr(going), F.struct(left.alias("l"), right.alias("r"))) for going, left, right in _siblings(place)]
    return F.filter(F.array(*levels), lambda s: s.isNotNull())


def forest(nodes: DataFrame, group: str, items: list[str]) -> tuple[DataFrame, DataFrame]:
    """(lowest blocks with ``_path``, roots) of the trees over nodes (group, _pos, _hash, items).

    ``_path`` holds the sibling segments from the block's top to the group's
    root; ``roots`` has (group, _root) for every group.
    """
    rounds = [_blocks(nodes, group, items)]
    while not rounds[-1].filter("_more").isEmpty():
        tops = rounds[-1].filter("_more").select(group, F.col("_block").alias("_pos"), F.col(f"_l{DEPTH}").alias("_hash"))
        rounds.append(_blocks(tops, group, []))
    roots = reduce(DataFrame.unionByName, [r.filter("not _more").select(group, F.col(f"_l{DEPTH}").alias("_root"))
                                           for r in rounds])
    none = F.array().cast("array<struct<l:string,r:string>>")
    below = rounds[-1].withColumn("_path", none)
    for lower in reversed(rounds[:-1]):
        place = F.posexplode("_items").alias("_i", "_item")
        above = below.select(group, "_block", "_more", "_path", *[f"_l{j}" for j in range(DEPTH + 1)], place)
        above = above.select(F.col(group).alias("_pg"), F.expr(f"_block * {FAN ** DEPTH} + _i").alias("_pb"),
                             F.concat(_segments("_i"), F.col("_path")).alias("_up"))
        below = lower.join(above, F.col(group).eqNullSafe(F.col("_pg")) & (F.col("_block") == F.col("_pb")), "left")
        below = below.withColumn("_path", F.coalesce("_up", none)).drop("_pg", "_pb", "_up")
    return below, roots


def _fold(path: Column, start: Column) -> Column:
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def manifest(rows: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS,
             tampered: list[Column] | None = None) -> DataFrame:
    """One row per row of ``rows``: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` gives the fields of the rows as they are found later, in the
    order of ``fields`` (default: unchanged); ``folded_root`` folds their hash
    with the siblings of the untampered tree, ``verified`` tells whether that
    is the root.  A proof is the hash of the siblings, level by level from the
    leaf to the root, left to right; without any sibling, of the empty string.

    Nulls are fields of their own (``-``) and form a group of their own, first
    in order; null keys come first in their group.  Rows of one key are ordered
    by their leaves, equal rows are leaves of their own and can change places.
    Texts of any length are hashed whole; an empty table gives an empty result;
    other columns don't matter.
    """
    now = leaf_hash([F.col(c) for c in fields])
    later = leaf_hash(tampered) if tampered else now
    leaves = rows.select(F.col(key).alias("_key"), F.col(group).alias("_group"), now.alias("_hash"),
                         F.nullif(later, now).alias("_later"), F.monotonically_increasing_id().alias("_uid")).checkpoint()
    placed = positions(leaves, "_group", ["_key", "_hash", "_uid"])
    blocks, subroots = forest(placed, "_group", ["_key", "_later"])
    one = subroots.select(F.lit(0).alias("_all"), F.col("_group").alias("_member"), F.col("_root").alias("_hash"))
    tops, roots = forest(positions(one, "_all", ["_member"]), "_all", ["_member"])
    root = roots.first()
    above = tops.select(*[c for c in tops.columns if c != "_items"], F.posexplode("_items").alias("_i", "_item"))
    above = above.select(F.col("_item._member").alias("_member"), F.col("_item._hash").alias("_subroot"),
                         F.concat(_segments("_i"), F.col("_path")).alias("_up"))
    whole = blocks.join(above, F.col("_group").eqNullSafe(F.col("_member")))
    whole = whole.withColumn("_path", F.concat("_path", "_up")).drop("_up", "_member", "_group")
    each = whole.select(*[c for c in whole.columns if c != "_items"], F.posexplode("_items").alias("_i", "_item"))
    node, beside = F.coalesce("_item._later", "_item._hash"), []
    for going, left, right in _siblings("_i"):
        node = F.when(F.expr(going), F.sha2(F.concat(left, node, right), 256)).otherwise(node)
        beside += [left, right]
    # the levels of a block that has ended have one node, so no siblings
    proof = F.concat(*beside, F.array_join(F.transform("_path", lambda s: F.concat(s["l"], s["r"])), ""))
    out = each.select(F.col("_item._key").alias(key), F.col("_item._hash").alias("leaf"), F.col("_subroot").alias("subroot"),
                      F.lit(root["_root"] if root else None).cast("string").alias("root"),
                      F.sha2(proof, 256).alias("proof_sha256"), _fold(F.col("_path"), node).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_newlines(key: str = "doc_id", text: str = "text", fields: tuple[str, ...] = FIELDS) -> list[Column]:
    """``fields`` with the newlines deleted from the text where 2 divides the CRC-32 of the decimal key."""
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    cut = F.when(chosen, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))
    return [cut if c == text else F.col(c) for c in fields]


def oracle(rows: str = "documents") -> str:
    """DuckDB SQL of :func:`manifest` over ``documents``, tampered by :func:`without_newlines`."""
    part = lambda c: f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(text if c == "text" else c) for c in FIELDS) + ")"
    up = lambda name, g: (f"SELECT {g}, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3)"  # noqa: E731
                          f" FROM {name} WHERE n > 1 GROUP BY {g}, lvl, pos // 3")
    return f"""
WITH RECURSIVE steps(i, k, v) AS (SELECT i, 0, i::BIGINT FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8),
d AS (SELECT *, row_number() OVER () AS uid, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) % 2 = 1 AS chosen FROM {rows}, crc),
l AS (SELECT uid, doc_id, source, {leaf('text')} AS leaf, {leaf("CASE WHEN chosen THEN replace(text, chr(10), '') ELSE text END")} AS later FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS n FROM l),
t(source, lvl, pos, h, n) AS (SELECT source, 0, pos, leaf, n FROM p UNION ALL {up('t', 'source')}),
s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(g, lvl, pos, h, n) AS (SELECT 0, 0, pos, subroot, n FROM s UNION ALL {up('u', 'g')}),
tr AS (SELECT source, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL),
ur AS (SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL),
f(uid, source, lvl, pos, node, sib) AS (SELECT uid, source, 0, pos, later, '' FROM p UNION ALL
  SELECT uid, f.source, f.lvl + 1, pos // 3,
    sha256(array_to_string(hs[1:pos % 3], '') || node || array_to_string(hs[pos % 3 + 2:3], '')),
    sib || array_to_string(hs[1:pos % 3], '') || array_to_string(hs[pos % 3 + 2:3], '')
  FROM f JOIN tr ON f.source IS NOT DISTINCT FROM tr.source AND f.lvl = tr.lvl AND pos // 3 = run),
fs AS (SELECT uid, source, arg_max(node, lvl) AS node, arg_max(sib, lvl) AS sib FROM f GROUP BY ALL),
g(uid, subroot, lvl, pos, node, sib) AS (SELECT uid, subroot, 0, pos, node, sib FROM fs JOIN s ON fs.source IS NOT DISTINCT FROM s.source
  UNION ALL SELECT uid, subroot, g.lvl + 1, pos // 3,
    sha256(array_to_string(hs[1:pos % 3], '') || node || array_to_string(hs[pos % 3 + 2:3], '')),
    sib || array_to_string(hs[1:pos % 3], '') || array_to_string(hs[pos % 3 + 2:3], '')
  FROM g JOIN ur ON g.lvl = ur.lvl AND pos // 3 = run),
gs AS (SELECT uid, subroot, arg_max(node, lvl) AS node, arg_max(sib, lvl) AS sib FROM g GROUP BY ALL)
SELECT doc_id, leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(sib) AS proof_sha256, node AS folded_root,
  node = (SELECT h FROM u WHERE n = 1) AS verified FROM gs JOIN l USING (uid)"""
