"""Quality rules by weak supervision, in DataFrame operations only.

Rules vote that a text is good (1) or bad (-1) or abstain (0).  The votes'
error rates are not given: expectation-maximisation over the table of vote
patterns estimates, for each rule, how often it votes good on good and on bad
texts, and the share of good texts.  The posterior probability of being good
then decides, instead of demanding that every rule passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.llm.common import GAP, GAP_CHARS, words

WINDOW = 5
ROUNDS = 25

# Name, SQL that holds for a bad vote, SQL that holds for a good vote.
RULES = [
    ("word_length", "word_chars < 2 * n_words OR word_chars > 16 * n_words",
     "word_chars >= 3 * n_words AND word_chars <= 10 * n_words"),
    ("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    ("marks", "50 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    ("lines", "100 * n_dup_lines > 30 * n_lines", "n_dup_lines = 0 AND n_lines >= 3"),
    ("windows", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    ("capitals", "100 * n_capitals > 35 * word_chars", "100 * n_capitals <= 15 * word_chars"),
    ("shouts", "100 * n_shouts > 20 * n_words", "100 * n_shouts <= 2 * n_words"),
]
NAMES = [r[0] for r in RULES]

# Starting rates of a good vote among good and among bad texts, and of good texts.
START_GOOD, START_BAD, START_PRIOR = 0.995, 0.75, 0.85
# What makes the votes supervision: a rule errs on few good texts and sees through some bad ones.
PRIOR_RANGE, GOOD_RANGE, BAD_RANGE = (0.5, 0.99), (0.9, 0.999), (0.05, 0.8)

BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def _count(text: Column, pattern: str) -> Column:
    """Characters of ``text`` in matches of ``pattern``."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _repeat_words(placed: Column) -> Column:
    """Words covered by windows that occur twice or more, from their sorted (hash, place) pairs.

    ``placed`` must be a plain column: the lambda looks at both neighbours of each pair.
    """
    same = lambda s, i: F.coalesce(s["h"] == F.get(placed, i)["h"], F.lit(False))
    marked = F.transform(placed, lambda s, i: F.when(same(s, i - 1) | same(s, i + 1), s["i"]))
    return F.aggregate(
        F.sort_array(F.array_compact(marked)),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n")),
        lambda acc: acc["n"])


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text column, plus the counts that the rules look at.

    Windows are compared by 64-bit hashes inside one text: among w windows two
    different ones meet with a probability below w * w / 2**65.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
             "n_shouts"]
    kept = [c for c in docs.columns if c != text and c.lower() not in names]
    d = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    d = d.select(*kept, words(F.col("_t")).alias("_w"),
                 F.length(F.regexp_replace("_t", GAP, "")).cast("long").alias("word_chars"),
                 _count(F.col("_t"), "[#*$%&|<>]+").alias("n_symbols"),
                 _count(F.col("_t"), "[A-Z]+").alias("n_capitals"),
                 _count(F.col("_t"), "!+").alias("n_shouts"),
                 F.filter(F.split("_t", "\n", -1), lambda x: F.btrim(x, F.lit(GAP_CHARS)) != "").alias("_l"))
    hashed = F.transform("_w", lambda w, i: F.xxhash64(w, *[F.get(F.col("_w"), i + k) for k in range(1, WINDOW)]))
    d = d.select(*kept, "word_chars", "n_symbols", "n_capitals", "n_shouts",
                 F.size("_w").cast("long").alias("n_words"), F.size("_l").cast("long").alias("n_lines"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 F.when(F.size("_w") > WINDOW, F.slice(hashed, F.lit(1), F.size("_w") - (WINDOW - 1))).alias("_h"))
    counts = [*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    more = ["n_lines", "n_capitals", "n_shouts"]
    d = d.select(*counts, *more, F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_p"))
    repeat = F.when(F.col("_p").isNull(), F.lit(0)).otherwise(_repeat_words(F.col("_p")))
    return d.select(*counts, repeat.cast("long").alias("n_repeat_words"), *more)


def vote_sql(bad: str, good: str) -> str:
    return f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


def posterior_sql(prior: str, good: list[str], bad: list[str]) -> str:
    """SQL of P(good | votes) from SQL of the rates; abstentions carry no weight."""
    odds = " + ".join([f"ln({prior}) - ln(1 - {prior})", *[
        f"CASE v_{n} WHEN 1 THEN ln({g}) - ln({b}) WHEN -1 THEN ln(1 - {g}) - ln(1 - {b}) ELSE 0e0 END"
        for n, g, b in zip(NAMES, good, bad, strict=True)]])
    return f"1e0 / (1e0 + exp(-greatest(-500e0, least(500e0, {odds}))))"


def _bounded(x: str, ends: tuple[float, float]) -> str:
    return f"least({ends[1]}e0, greatest({ends[0]}e0, {x}))"


def step_sql(p: str) -> list[str]:
    """SQL aggregates over vote patterns (n rows each, posterior ``p``): the next prior and rates."""
    rate = lambda name, w, ends: _bounded(
        f"(sum(CASE WHEN v_{name} = 1 THEN n * {w} ELSE 0e0 END) + 1e0)"
        f" / (sum(CASE WHEN v_{name} <> 0 THEN n * {w} ELSE 0e0 END) + 2e0)", ends)
    prior = _bounded(f"(sum(n * {p}) + 1e0) / (sum(n) + 2e0)", PRIOR_RANGE)
    return [f"{prior} AS prior", *[f"{rate(n, p, GOOD_RANGE)} AS g_{n}" for n in NAMES],
            *[f"{rate(n, f'(1e0 - {p})', BAD_RANGE)} AS b_{n}" for n in NAMES]]


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """Rates by expectation-maximisation over ``patterns`` (v_<rule>..., n).

    There are at most 3 ** len(RULES) patterns whatever the corpus; each round
    is one aggregate of them, and only its row of rates comes to the driver.
    """
    now = {"prior": START_PRIOR} | {f"g_{n}": START_GOOD for n in NAMES} | {f"b_{n}": START_BAD for n in NAMES}
    for _ in range(rounds):
        lit = {k: f"{v!r}D" for k, v in now.items()}
        p = posterior_sql(lit["prior"], [lit[f"g_{n}"] for n in NAMES], [lit[f"b_{n}"] for n in NAMES])
        now = patterns.withColumn("p", F.expr(p)).selectExpr(*step_sql("p")).first().asDict()
        if now["prior"] is None:
            raise ValueError("no vote patterns")
    return now


def judge(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, threshold: float = 0.5) -> DataFrame:
    """The documents' columns without the text, the counts, votes, ``quality`` (posterior),
    ``base_failed`` and ``kept``.

    A null text is an empty one.  An empty or blank text gets no votes and
    fails the base rule.  Repeated rows are judged alike, each on its own.  An
    empty table gives an empty result.  Columns of the input named like an
    output are replaced.  The counts are checkpointed, so texts are read once.
    """
    outs = {"quality", "base_failed", "kept", *[f"v_{n}" for n in NAMES]}
    counted = features(docs.drop(*[c for c in docs.columns if c.lower() in outs]), text)
    voted = counted.withColumns({f"v_{n}": F.expr(vote_sql(b, g)) for n, b, g in RULES}).checkpoint()
    patterns = voted.groupBy(*[f"v_{n}" for n in NAMES]).agg(F.count("*").alias("n")).coalesce(1).checkpoint()
    if not patterns.isEmpty():
        rates = {k: f"{v!r}D" for k, v in estimate(patterns, rounds).items()}
    else:
        rates = {"prior": "0.5D"} | {f"{s}_{n}": "0.5D" for s in "gb" for n in NAMES}
    p = posterior_sql(rates["prior"], [rates[f"g_{n}"] for n in NAMES], [rates[f"b_{n}"] for n in NAMES])
    return (voted.withColumn("quality", F.expr(p)).withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))


def oracle_cte(docs: str = "documents") -> str:
    """DuckDB CTEs for the same rows: ``judged`` holds the result per row number ``rid``."""
    ws = r"[\x20\x09-\x0D]+"
    votes = ", ".join(f"{vote_sql(b, g)} AS v_{n}" for n, b, g in RULES)
    first = ", ".join([f"{START_PRIOR}::DOUBLE AS prior", *[f"{START_GOOD}::DOUBLE AS g_{n}" for n in NAMES],
                       *[f"{START_BAD}::DOUBLE AS b_{n}" for n in NAMES]])
    rates = ("r.prior", [f"r.g_{n}" for n in NAMES], [f"r.b_{n}" for n in NAMES])
    steps = ",\n".join(
        f"r{i + 1} AS MATERIALIZED (SELECT {', '.join(step_sql('p'))} FROM (SELECT q.*, {posterior_sql(*rates)} AS p"
        f" FROM patterns q, r{i} r))" for i in range(ROUNDS))
    return f"""
texts AS MATERIALIZED (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM {docs}),
split_words AS (SELECT rid, list_filter(regexp_split_to_array(t, '{ws}'), lambda w: w <> '') AS w FROM texts),
windows AS (SELECT rid, i, list_aggregate(w[i:i + {WINDOW - 1}], 'string_agg', ' ') AS win
  FROM split_words, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS u(i)),
counted_windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM windows),
covered AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM counted_windows, range(0, {WINDOW}) AS o(k)
  WHERE c > 1 GROUP BY rid),
split_lines AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM texts),
counted AS (SELECT x.rid, x.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{ws}', '', 'g'))::BIGINT
    AS word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  len(l) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
  length(t) - length(replace(t, '!', '')) AS n_shouts
  FROM texts x JOIN split_words USING (rid) JOIN split_lines USING (rid) LEFT JOIN covered USING (rid)),
voted AS MATERIALIZED (SELECT *, {votes} FROM counted),
patterns AS MATERIALIZED (SELECT {', '.join(f'v_{n}' for n in NAMES)}, count(*) AS n FROM voted GROUP BY ALL),
r0 AS MATERIALIZED (SELECT {first}),
{steps},
judged AS (SELECT v.*, {BASE_FAILED} AS base_failed,
  NOT ({BASE_FAILED}) AND {posterior_sql(*rates)} >= 0.5 AS kept FROM voted v, r{ROUNDS} r)"""
