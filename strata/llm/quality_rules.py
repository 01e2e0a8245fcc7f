"""Quality rules judged per host: documents fail rules, hosts are rejected for their documents.

One pass over the texts counts what the rules need (:func:`measured`) and stores the
counts; texts are not read again. Rule failures are then added up by host, combined
before the shuffle, so a host with a third of all documents is one row per task. A
host's failure rate on a rule says little when it has few documents, so it is shrunk:
the rates of all hosts are taken as draws from a beta distribution whose mean and
spread are estimated from the hosts themselves (method of moments, the binomial noise
of each rate taken off), and a host's rate becomes the posterior mean
(alpha + failures) / (alpha + beta + documents). A host whose shrunk rate on some rule
exceeds ``HOST_LIMIT`` is rejected with all its documents. Verdicts are joined back to
the stored counts by a plain join, so Spark broadcasts the hosts if their stored size
allows and splits hot hosts otherwise. Everything is a DataFrame expression.

The repeated words of a text are found without leaving its row: hashes of its five-word
windows in one array; where two hashes are equal, the windows themselves are sorted and
compared, so hash collisions change nothing.

Defined results: a null text has no words (and fails the base rules); a null host is no
host, its documents are judged by the base rules alone; rows that repeat a doc_id, or
have none, are judged one by one and each counts for its host; further columns are
ignored; an empty table gives no rows. With one host, or hosts of one document each,
nothing can be learned about the spread: the weakest spread allowed is used, so single
documents are shrunk almost wholly to the mean of all hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stored, table

SPACE = " \t\n\x0b\f\r"
GAP = r"[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
HOST_LIMIT = 0.5          # a host is rejected above this shrunk failure rate
CORRELATION = (1e-4, 0.1)  # bounds of 1 / (alpha + beta + 1): a prior is worth 9 documents at least, so one alone never decides

#: rule → SQL condition over the counts of :func:`measured`; the first two are the base rules
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("few_words", "repeated_words")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines
    (lines with a word), all long."""
    names = {x.lower() for x in docs.columns}

    def fresh(name: str) -> str:
        while name.lower() in names:
            name = f"_{name}"
        return name

    body, words, lines, hashes, order, at = (fresh(f"_{x}") for x in ("body", "words", "lines", "hashes", "order", "at"))
    q = lambda x: f"`{x}`"
    one = docs.withColumn(body, F.coalesce(F.col(text).cast("string"), F.lit("")))
    two = one.withColumns({
        words: F.when(F.btrim(body, F.lit(SPACE)) == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.btrim(body, F.lit(SPACE)), GAP)),
        lines: F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""),
    })
    windows = f"greatest(size({q(words)}) - {WINDOW - 1}, 0)"
    three = two.withColumns({
        hashes: F.expr(f"CASE WHEN {windows} > 0 THEN "
                       f"transform(sequence(1, {windows}), i -> xxhash64(slice({q(words)}, i, {WINDOW}))) "
                       "ELSE cast(array() AS array<bigint>) END"),
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    })
    # windows with their places, sorted, only where some hash occurs twice
    four = three.withColumn(order, F.expr(
        f"CASE WHEN size(array_distinct({q(hashes)})) < size({q(hashes)}) THEN sort_array(transform({q(hashes)}, "
        f"(h, i) -> struct(h AS h, slice({q(words)}, i + 1, {WINDOW}) AS w, i AS i))) END"))
    same = lambda a, b: f"({q(order)}[{a}].h = {q(order)}[{b}].h AND {q(order)}[{a}].w = {q(order)}[{b}].w)"
    five = four.withColumn(at, F.expr(
        f"CASE WHEN {q(order)} IS NOT NULL THEN sort_array(transform(filter(sequence(0, size({q(order)}) - 1), "
        f"k -> (k > 0 AND {same('k', 'greatest(k - 1, 0)')}) OR "
        f"(k < size({q(order)}) - 1 AND {same('k', f'least(k + 1, size({q(order)}) - 1)')})), k -> {q(order)}[k].i)) END"))
    covered = F.expr(
        f"CASE WHEN {q(at)} IS NULL THEN 0L ELSE aggregate({q(at)}, struct({-WINDOW} AS last, 0L AS total), "
        f"(s, p) -> struct(p AS last, s.total + least({WINDOW}, p - s.last) AS total), s -> s.total) END")
    return five.withColumn("n_repeat_words", covered).drop(body, words, lines, hashes, order, at)


def host_rates(counts: DataFrame, host: str, rules: dict[str, str] = RULES) -> DataFrame:
    """Per host (null left out): ``n`` documents and the failures of each rule."""
    failed = [F.count_if(F.expr(rule)).alias(name) for name, rule in rules.items()]
    return (counts.filter(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
            .agg(F.count(F.lit(1)).alias("n"), *failed))


def beta_priors(hosts: DataFrame, rules: dict[str, str] = RULES) -> dict[str, tuple[float, float]]:
    """rule → (alpha, beta), by the method of moments over the hosts' rates.

    A rate of n documents has the variance m (1 - m) (1/n + r (1 - 1/n)) with m the mean
    and r = 1 / (alpha + beta + 1); r is solved from the observed squares."""
    of = lambda name: F.col(name) / F.col("n")
    sums = [x for name in rules for x in (F.sum(of(name)).alias(f"p_{name}"), F.sum(of(name) * of(name)).alias(f"q_{name}"))]
    row = hosts.agg(F.count(F.lit(1)).alias("h"), F.sum(1 / F.col("n")).alias("noise"), *sums).first()
    priors = {}
    for name in rules:
        h, low = row["h"], CORRELATION[0]
        mean = row[f"p_{name}"] / h if h else 0.0
        r = low
        if h > 1 and 0 < mean < 1 and h - row["noise"] > 1e-9:
            squares = max(0.0, row[f"q_{name}"] - h * mean * mean)
            r = (squares / (mean * (1 - mean) * (1 - 1 / h)) - row["noise"]) / (h - row["noise"])
        strength = 1 / min(max(r, low), CORRELATION[1]) - 1
        priors[name] = (mean * strength, (1 - mean) * strength)
    return priors


def host_verdicts(hosts: DataFrame, rules: dict[str, str] = RULES, limit: float = HOST_LIMIT) -> DataFrame:
    """host, n, the shrunk rate of each rule, rejected."""
    shrunk = {name: (F.lit(a) + F.col(name)) / (F.lit(a + b) + F.col("n")) for name, (a, b) in beta_priors(hosts, rules).items()}
    rated = hosts.select("host", "n", *[rate.alias(name) for name, rate in shrunk.items()])
    return rated.withColumn("rejected", F.greatest(*rules, F.lit(0.0)) > limit)


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, host_rejected, kept."""
    counts = stored(measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("_host"), F.col(text).alias("_text")),
                             "_text").drop("_text"), "quality-counts")
    hosts = stored(host_rates(counts, "_host"), "quality-hosts")
    rejected = host_verdicts(hosts).filter("rejected").select(F.col("host").alias("_rejected"))
    base = F.expr(" OR ".join(f"({RULES[name]})" for name in BASE))
    return (counts.join(rejected, F.col("_host") == F.col("_rejected"), "left")
            .withColumn("base_failed", base).withColumn("host_rejected", F.col("_rejected").isNotNull())
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
            .withColumnRenamed("_host", "host").drop("_rejected"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    space = r"[\x20\x09-\x0D]"
    sums = ", ".join(f"sum({name} / n) AS p_{name}, sum(({name} / n) * ({name} / n)) AS q_{name}" for name in RULES)
    solved = ", ".join(
        f"""p_{name} / h AS m_{name}, 1 / least({CORRELATION[1]}, greatest({CORRELATION[0]}, CASE
            WHEN h > 1 AND p_{name} > 0 AND p_{name} < h AND h - noise > 1e-9 THEN
            (greatest(0, q_{name} - p_{name} * p_{name} / h) / ((p_{name} / h) * (1 - p_{name} / h) * (1 - 1 / h)) - noise) / (h - noise)
            ELSE {CORRELATION[0]} END)) - 1 AS s_{name}""" for name in RULES)
    rejected = " OR ".join(f"(m_{name} * s_{name} + {name}) / (s_{name} + n) > {HOST_LIMIT}" for name in RULES)
    failures = ", ".join(f"count(*) FILTER (WHERE {rule}) AS {name}" for name, rule in RULES.items())
    base = " OR ".join(f"({RULES[name]})" for name in BASE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, list_filter(string_split_regex(t, '{space}+'), lambda x: x <> '') AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: NOT regexp_full_match(x, '{space}*')) AS ls FROM d),
words AS (SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM split),
windows AS (SELECT r, i, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p || ' ' || lead(w, 3) OVER p
                   || ' ' || lead(w, 4) OVER p AS g FROM words WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows WHERE g IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT j) AS n_repeat_words
            FROM (SELECT r, unnest(generate_series(i, i + {WINDOW - 1})) AS j FROM twice) GROUP BY r),
counts AS (SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
                  CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                  CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
                  CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
           FROM split LEFT JOIN covered USING (r)),
hosts AS (SELECT source, count(*) AS n, {failures} FROM counts WHERE source IS NOT NULL GROUP BY source),
sums AS (SELECT count(*) AS h, sum(1 / n) AS noise, {sums} FROM hosts),
priors AS (SELECT {solved} FROM sums),
rejected AS (SELECT source AS host FROM hosts, priors WHERE {rejected})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed,
       NOT ({base}) AND host IS NULL AS kept
FROM counts LEFT JOIN rejected ON source = host
"""


ORACLE = _oracle()
