"""Text-to-table extraction over a line table (column ``value``).

Each pattern is applied with *search* semantics (the first match anywhere in
the line, like ``Matcher.find``); a line that does not match is dropped.

One regex pass per line: the line is rewritten as ``\\n g1 \\n g2 ...`` by a
whole-line ``regexp_replace`` and split on ``\\n`` (inside a generator, so
the regex is evaluated once per line however many columns use the groups).  Lines produced by
``spark.read.text`` never contain a newline, so a leading newline marks a
match and no captured group can contain the separator.  This keeps the work
inside whole-stage codegen at one regex evaluation per row instead of one
``rlike`` plus one ``regexp_extract`` per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The line layouts of the logs being reconciled.  They must stay
# exactly as written for the same lines to be accepted and split the same way.
# ---------------------------------------------------------------------------
ACCESS_PATTERN = (r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] '
                  r'"(\S+) (\S+) (\S+)" (\d{3}) (\d+)')
STATE_PATTERN = r"\[listener\-\d{%d}\] - (PUBLISH|NOPUBLISH|UNPUBLISH) (\w+)%s(\d+) \((\d+)\)"
RESOLVER_PATTERN = r"RESOLVE (%s)%s(\d+) \((\d+) replacing (\w+)\) , (\d+) dirty"
NEW_MARK = "empty"          # old publication id of a first resolution
# separator between resource and id, per side
DIALECT_SEPARATOR = {"control": " ", "candidate": r"\-"}
SIDES = ("control", "candidate")


def _sep(dialect: str) -> str:
    try:
        return DIALECT_SEPARATOR[dialect]
    except KeyError:
        raise ValueError(f"dialect must be one of {SIDES}, got {dialect!r}")


def extract_groups(lines: DataFrame, pattern: str, names: Sequence[str],
                   col: str = "value", require: Sequence[str] | None = None) -> DataFrame:
    """Keep lines where ``pattern`` is found; one string column per group.

    ``require``: literals of which every matching line contains at least one.
    They are tested first with a plain substring search, so the regex only
    runs on candidate lines (most lines of a real log are something else).
    A necessary condition only - the result is the same with or without it.
    """
    n = len(names)
    body = pattern[1:] if pattern.startswith("^") else r".*?(?:" + pattern + ")"
    whole = r"(?s)^" + (r"(?:" + body + ")" if pattern.startswith("^") else body) + r".*$"
    replacement = "".join("\n$%d" % (i + 1) for i in range(n))
    # The split result is wrapped in a one-element array and exploded: the
    # generator's output is an attribute, so the optimizer can neither inline
    # the regex into every group column nor push the match test below it (each
    # would run the regex again).  The literal test gates the regex: a line
    # without a required literal gives a null array, which explodes to no row.
    # Plain expressions only (no lambdas), so the whole stage is code-generated.
    v = F.col(col)
    wrapped = F.array(F.split(F.regexp_replace(v, F.lit(whole), F.lit(replacement)), "\n"))
    if require:
        cond = None
        for lit in require:
            c = v.contains(lit)
            cond = c if cond is None else cond | c
        wrapped = F.when(cond, wrapped)
    out = (lines.select(F.explode(wrapped).alias("_p"))
           .filter((F.size("_p") == n + 1) & (F.col("_p")[0] == F.lit(""))))
    return out.select(*[F.col("_p")[i + 1].alias(nm) for i, nm in enumerate(names)])


def _long(c: str) -> Column:
    # digits that overflow a long give null rather than failing the job
    return F.expr(f"try_cast({c} as bigint)")


def _int(c: str) -> Column:
    return F.expr(f"try_cast({c} as int)")


# X1 ------------------------------------------------------------------------
ACCESS_COLUMNS = ["ip_address", "client_identd", "user_id", "date_time", "method",
                  "endpoint", "protocol", "response_code", "content_size"]


def extract_access(lines: DataFrame, col: str = "value") -> DataFrame:
    """Access-log lines -> 9 typed columns (``date_time`` stays text)."""
    g = extract_groups(lines, ACCESS_PATTERN, ACCESS_COLUMNS, col, require=['] "'])
    return g.select(*ACCESS_COLUMNS[:7],
                    _int("response_code").alias("response_code"),
                    _long("content_size").alias("content_size"))


# X2 / X3 / X4 --------------------------------------------------------------
def is_lines(df: DataFrame, col: str = "value") -> bool:
    """True for a raw line table, False for already extracted (landed) rows."""
    return df.columns == [col]


def extract_states(lines: DataFrame, dialect: str = "control",
                   listener_digits: int = 1, col: str = "value") -> DataFrame:
    """Publish-state lines -> (rovi_id, resource, state, pub_id).

    ``listener_digits`` is the exact digit count of the listener number
    (lines from listener 10+ are not accepted with the default of 1).
    Landed rows (see ``logledger.sources.landing``) pass through.
    """
    if not is_lines(lines, col):
        return lines.select("rovi_id", "resource", "state", "pub_id")
    pat = STATE_PATTERN % (listener_digits, _sep(dialect))
    g = extract_groups(lines, pat, ["state", "resource", "rovi_id", "pub_id"], col,
                       require=["[listener-"])
    return g.select(_long("rovi_id").alias("rovi_id"), "resource", "state",
                    _long("pub_id").alias("pub_id"))


def tag_side(df: DataFrame, side: str) -> DataFrame:
    """Add 1/0 indicator columns ``control_n`` / ``candidate_n`` for ``side``."""
    _sep(side)
    return df.withColumns({
        "control_n": F.lit(1 if side == "control" else 0),
        "candidate_n": F.lit(1 if side == "candidate" else 0)})


# X5 / X6 -------------------------------------------------------------------
RAW_RESOLVER_COLUMNS = ["resource", "rovi_id", "pub_id", "old_pub_id", "state", "dirty_size"]


def extract_resolver_raw(lines: DataFrame, dialect: str = "control",
                         resources: Sequence[str] | None = None,
                         col: str = "value") -> DataFrame:
    """Resolver lines -> (resource, rovi_id, pub_id, old_pub_id, state, dirty_size).

    ``state`` is ``new`` when the old id is the word ``empty``, else ``update``.
    ``resources`` keeps only the named resources: their names are in the
    pattern, so on a line with several resolutions the first wanted one counts.
    A dirty size beyond a long fails the job rather than leaving the sums.
    Landed rows pass through (the resource list becomes a partition filter
    there).
    """
    if not is_lines(lines, col):
        g = lines if resources is None else lines.filter(F.col("resource").isin(list(resources)))
        return g.select(*RAW_RESOLVER_COLUMNS)
    names = r"\w+" if resources is None else "|".join(rf"\Q{r}\E" for r in resources)
    pat = RESOLVER_PATTERN % (names, _sep(dialect))
    literal_sep = " " if dialect == "control" else "-"
    # with a resource list only lines naming one of them can match
    require = ([f"RESOLVE {r}{literal_sep}" for r in resources] if resources is not None
               else ["RESOLVE "])
    g = extract_groups(lines, pat, ["resource", "rovi_id", "pub_id", "old_pub_id", "dirty_size"], col,
                       require=require)
    return g.select(
        "resource", _long("rovi_id").alias("rovi_id"), _long("pub_id").alias("pub_id"),
        "old_pub_id",
        F.when(F.col("old_pub_id") == NEW_MARK, "new").otherwise("update").alias("state"),
        F.col("dirty_size").cast("bigint").alias("dirty_size"))


def extract_resolver_tagged(lines: DataFrame, side: str, count_only: bool = False,
                            col: str = "value") -> DataFrame:
    """Resolver lines -> (resource, rovi_id, pub_id, state, control_n, candidate_n).

    The measure on the line's own side is the dirty size, or 1 per line with
    ``count_only``; the other side's measure is 0.
    """
    raw = extract_resolver_raw(lines, side, None, col)
    m = F.lit(1).cast("bigint") if count_only else F.col("dirty_size")
    zero = F.lit(0).cast("bigint")
    return raw.select("resource", "rovi_id", "pub_id", "state",
                      (m if side == "control" else zero).alias("control_n"),
                      (m if side == "candidate" else zero).alias("candidate_n"))
