"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

Patterns give candidate spans.  A candidate's value is hashed, and each hash
is counted by the distinct repositories and owners that hold it: a value that
several owners hold, or several repositories of one owner, is a copied example;
one that few keep to themselves and that looks random is taken for live.  Base
patterns are always reported; the looser pattern ``opaque`` is reported only
where its value is live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kind, pattern, group of the value, least length of the value, text without which nothing matches.
KINDS = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
               r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("opaque", r"[A-Za-z0-9+/_-]{24,}", 0, 24),
]
BASE = [k[0] for k in KINDS[:3]]
NAMES = [k[0] for k in KINDS]
# Opaque values mix all of these; live values of the base kinds use so many different characters, not digits alone.
MIXED = ("[a-z]", "[A-Z]", "[0-9]")
LEAST_CHARS = 8
# Random opaque values seldom repeat a character and often change between classes; paths, addresses and names in
# mixed case repeat letters and keep to a class.  Two characters drawn from a value are equal once in EQUAL draws at
# most, and of its characters two in FIRSTS at least begin a run of their class.
CLASSES = "[a-z]+|[A-Z]+|[0-9]+|[+/_-]+"
EQUAL, FIRSTS = 25, 5
MOST_OWNERS, MOST_REPOS = 2, 2
MASK = "[SECRET]"


def _gate(text: Column, kind: str, pattern: str) -> Column:
    """Cheap condition that holds for every text with a match."""
    if kind == "assign":
        return F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    if kind == "access":
        return F.contains(text, F.lit("AKIA"))
    return F.rlike(text, F.lit(pattern))


def text_key(text: Column) -> Column:
    """Tells texts with the same document id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: Column | None = None,
               repo: Column | None = None) -> DataFrame:
    """One row per candidate: _key, _text, _owner, _repo, kind (number), start, end, value.

    Null, empty and blank texts have none, null keys, owners and repositories
    are kept, repeated rows are candidates each, an empty table gives an empty
    result, other columns are ignored.

    Positions are code points, the end exclusive.  Matches of a kind are
    leftmost and don't overlap; the pieces between them give the positions by
    a running sum over the document's own matches.
    """
    owner = F.lit("") if owner is None else owner
    repo = F.lit("") if repo is None else repo
    d = docs.select(F.col(key).alias("_key"), text_key(F.col(text)).alias("_text"), owner.cast("string").alias("_owner"),
                    repo.cast("string").alias("_repo"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    d = d.withColumn("_row", F.monotonically_increasing_id())
    found = []
    for i, (kind, pattern, _, _) in enumerate(KINDS):
        lengths = F.transform(F.split("_t", pattern, -1), F.length)
        found.append(F.when(_gate(F.col("_t"), kind, pattern), F.struct(
            F.lit(i).alias("kind"), F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)).alias("m"),
            lengths.alias("gap"))))
    names = ["_row", "_key", "_text", "_owner", "_repo"]
    by_kind = d.select(*names, F.explode(F.array_compact(F.array(*found))).alias("f"))
    each = by_kind.select(*names, "f.kind", F.posexplode(F.arrays_zip("f.m", "f.gap")).alias("pos", "z"))
    each = each.filter("z.m is not null").select(*names, "kind", "pos", F.col("z.m").alias("m"),
                                                 (F.col("z.gap") + F.length("z.m")).alias("step"))
    so_far = Window.partitionBy("_row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("end", F.sum("step").over(so_far))
    value, least = F.col("m"), F.lit(0)
    for i, (_, pattern, group, n) in enumerate(KINDS):
        if group:
            value = F.when(F.col("kind") == i, F.regexp_extract("m", pattern, group)).otherwise(value)
        least = F.when(F.col("kind") == i, F.lit(n)).otherwise(least)
    mixed = F.lit(True)
    for c in MIXED:
        mixed = mixed & F.rlike("m", F.lit(c))
    return (each.withColumn("value", value).filter(F.length("value") >= least)
            .filter((F.col("kind") != NAMES.index("opaque")) | mixed)
            .select(*names[1:], "kind", (F.col("end") - F.length("m")).alias("start"), "end", "value"))


def looks_live(kind: Column, value: Column) -> Column:
    """Whether a value looks like a random one of its kind, in whole numbers."""
    chars = F.split(value, "")
    distinct, n = F.array_distinct(chars), F.length(value).cast("long")
    times = lambda c: (F.length(value) - F.length(F.replace(value, c, F.lit("")))).cast("long")
    equal = F.aggregate(distinct, F.lit(0).cast("long"), lambda a, c: a + times(c) * (times(c) - 1))
    runs = F.size(F.regexp_extract_all(value, F.lit(CLASSES), F.lit(0)))
    opaque = (EQUAL * equal <= n * (n - 1)) & (FIRSTS * runs >= 2 * n)
    plain = (F.size(distinct) >= LEAST_CHARS) & ~F.rlike(value, F.lit("^[0-9]+$"))
    return F.when(kind == NAMES.index("opaque"), opaque).otherwise(plain)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners): repositories belong to owners; a null owner or repository counts as one.

    Occurrences are aggregated per (hash, owner, repository) before anything
    is gathered by hash, so a value that is copied everywhere stays cheap.
    """
    places = found.groupBy("hash", "_owner", "_repo").agg(F.count("*").alias("n_found"))
    owners = places.groupBy("hash", "_owner").agg(F.count("*").alias("n_repos"), F.sum("n_found").alias("n_found"))
    return owners.groupBy("hash").agg(F.sum("n_repos").alias("n_repos"), F.count("*").alias("n_owners"),
                                      F.sum("n_found").alias("n_found"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: Column | None = None,
         repo: Column | None = None, most_owners: int = MOST_OWNERS, most_repos: int = MOST_REPOS) -> DataFrame:
    """One row per reported span: _key, _text, kind, start, end, hash, n_repos, n_owners, n_found, live.

    ``hash`` is the SHA-256 of the value, so no value is kept.  ``live``: at
    most ``most_owners`` owners hold the value, in ``most_repos`` repositories
    in all at most, and it :func:`looks_live`.  How often a repository holds it
    (``n_found``) doesn't decide.  Null and empty texts have no spans;
    repeated rows of a document count each for frequencies and give each span
    once; an empty table gives an empty result; other columns are ignored.
    """
    found = candidates(docs, key, text, owner, repo)
    random = looks_live(F.col("kind"), F.col("value"))
    found = found.select("_key", "_text", "_owner", "_repo", "kind", "start", "end",
                         F.sha2("value", 256).alias("hash"), random.alias("_random")).checkpoint()
    known = found.drop("_owner", "_repo").distinct().join(ownership(found), "hash")
    known = known.withColumn("live", F.col("_random") & (F.col("n_owners") <= most_owners)
                             & (F.col("n_repos") <= most_repos)).drop("_random")
    return known.filter(F.col("live") | (F.col("kind") < len(BASE)))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def summarize(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_assign, n_access, n_hex, n_live, n_example, base_spans, spans.

    A row for every row of ``docs``, repeated ones and null keys included; null
    texts and those without spans have zeros and empty strings.  Other columns
    of ``docs`` are ignored.
    """
    place = F.struct("start", "kind", "end")
    base = F.col("kind") < len(BASE)
    counts = [F.count_if(F.col("kind") == i).alias(f"n_{n}") for i, n in enumerate(BASE)]
    per_doc = spans.groupBy("_key", "_text").agg(
        *counts, F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"),
        _joined(F.collect_list(F.when(base, place))).alias("base_spans"), _joined(F.collect_list(place)).alias("spans"))
    d = docs.select(F.col(key).alias("_k"), text_key(F.col(text)).alias("_x"))
    joined = d.join(per_doc, F.expr("_k <=> _key and _x = _text"), "left")
    zero = [f"n_{n}" for n in [*BASE, "live", "example"]]
    return joined.select(F.col("_k").alias(key), *[F.coalesce(c, F.lit(0)).alias(c) for c in zero],
                         *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")])


def redact(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every live span of the text replaced by MASK; spans that overlap share one mask.

    All rows and columns stay, whatever their names; null and empty texts, and
    those without live spans, are as before.
    """
    live = (spans.filter("live").groupBy("_key", "_text")
            .agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("int").alias("start"),
                                                      F.col("end").cast("int").alias("end")))).alias("spans")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row = row.withColumn("x", text_key(F.col("row")[text]))
    joined = row.join(live, F.col("row")[key].eqNullSafe(F.col("_key")) & (F.col("x") == F.col("_text")), "left")
    t = F.col("row")[text]
    masked = F.aggregate(
        "spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(t, a["at"] + 1, s["start"] - a["at"]),
                                                   F.lit(MASK))).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at")),
        lambda a: F.concat(a["out"], F.substring(t, a["at"] + 1, F.length(t))))
    return joined.select(*[F.when(F.col("spans").isNull(), t).otherwise(masked).alias(c) if c == text else
                           F.col("row")[c].alias(c) for c in docs.columns])


def oracle(docs: str = "documents", owner: str = "source", repo: str = "lang") -> str:
    """DuckDB SQL of the summary: doc_id, counts, base_spans, spans."""
    def quoted(s: str) -> str:
        return s.replace("'", "''")

    parts = []
    for i, (_, pattern, group, least) in enumerate(KINDS):
        p = quoted(pattern)
        value = f"regexp_extract(m, '{p}', {group})"
        mixed = " AND ".join([f"length({value}) >= {least}",
                              *([f"regexp_matches(m, '{c}')" for c in MIXED] if i == len(BASE) else [])])
        chars, n = f"string_split({value}, '')", f"length({value})"
        random = f"len(list_distinct({chars})) >= {LEAST_CHARS} AND NOT regexp_full_match({value}, '[0-9]+')"
        if i == len(BASE):
            times = f"({n} - length(replace({value}, c, '')))"
            equal = f"list_sum(list_transform(list_distinct({chars}), lambda c: {times} * ({times} - 1)))"
            random = f"{EQUAL} * {equal} <= {n} * ({n} - 1) AND {FIRSTS} * len(regexp_extract_all({value}, '{CLASSES}')) >= 2 * {n}"
        parts.append(f"""SELECT rid, owner, repo, {i} AS kind, e - length(m) AS s, e, sha256({value}) AS hash,
  {random} AS random FROM (
  SELECT rid, owner, repo, m, sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY n) AS e FROM (
    SELECT rid, owner, repo, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(regexp_split_to_array(t, '{p}')) AS g,
      generate_subscripts(regexp_split_to_array(t, '{p}'), 1) AS n FROM x) WHERE m IS NOT NULL) WHERE {mixed}""")
    spans = "string_agg(['{}'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind)".format("', '".join(NAMES))
    return f"""
x AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {owner} AS owner,
  {repo} AS repo FROM {docs}),
f AS MATERIALIZED ({' UNION ALL '.join(parts)}),
o AS (SELECT hash, count(DISTINCT coalesce(owner, '')) AS n_owners,
  count(DISTINCT (coalesce(owner, ''), coalesce(repo, ''))) AS n_repos FROM f GROUP BY hash),
k AS (SELECT f.*, random AND n_owners <= {MOST_OWNERS} AND n_repos <= {MOST_REPOS} AS live FROM f JOIN o USING (hash)),
d AS (SELECT rid, {', '.join(f'count(*) FILTER (kind = {i}) AS n_{n}' for i, n in enumerate(BASE))},
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
  {spans} FILTER (kind < {len(BASE)}) AS base_spans, {spans} AS spans
  FROM k WHERE live OR kind < {len(BASE)} GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{n}, 0)::BIGINT AS n_{n}' for n in [*BASE, 'live', 'example'])},
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM x LEFT JOIN d USING (rid)"""
