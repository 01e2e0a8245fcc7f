"""Quality rules: counts against a plain restatement, shrinkage and verdicts of hosts, edge cases."""

import random
import re

import duckdb
import pytest

from strata.llm import quality_rules as Q

SCHEMA = "doc_id long, text string, source string, n_words string, kept int, host double"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, 0.5) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    gaps = [" ", "  ", "\n", "\t", "\x0b", "\r\n", "\x0c "]
    made = ["".join(r.choice(["a", "b", "é#", " ", "<p>", "\x1f", "𝒳"]) + r.choice(gaps) for _ in range(r.randrange(60))) for _ in range(60)]
    return [None, "", " \n\t", "one", "a b c d e a b c d e", "a a a a a a a", "x\nx\n x\nx \n\n\n", "a b c\u0085d"] + made


def test_counts_equal_a_plain_restatement(spark, texts):
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in Q.judged(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_equal_hashes_of_different_windows_change_nothing(spark, monkeypatch, texts):
    expr = Q.F.expr
    monkeypatch.setattr(Q.F, "expr", lambda s: expr(re.sub(r"xxhash64\((slice\([^()]*\))\)", r"pmod(xxhash64(\1), 3L)", s)))
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["n_repeat_words"] for r in Q.measured(docs).collect()}
    assert got == {i: plain(t)[-1] for i, t in enumerate(texts)}


def test_rows_equal_sql_with_nulls_repeated_ids_and_many_hosts(spark, texts):
    rows = [(None if i % 9 == 0 else i % 40, t, [None, "h1", "h2", "", "h3"][i % 5]) for i, t in enumerate(texts * 2)]
    good = " ".join(f"word{i}" for i in range(30))
    rows += [(1000 + i, good, f"h{i % 7}") for i in range(60)]
    docs = frame(spark, rows)
    documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841  (read by name)
    want = duckdb.sql(Q.ORACLE.replace("FROM documents)", "FROM (SELECT CAST(doc_id AS BIGINT) AS doc_id, text, source FROM documents))"))
    got = Q.judged(docs).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_small_hosts_are_shrunk_and_bad_hosts_go(spark):
    good = " ".join(f"word{i}" for i in range(30))
    symbols = good + " # # # # # #"
    rows = [(f"good{h}", good) for h in range(30) for _ in range(20)]
    rows += [("bad", symbols)] * 40 + [("bad", good)] * 4      # 40 of 44 fail: rejected with its clean documents
    rows += [("tiny", symbols)]                                 # one of one: shrunk towards the other hosts, stays
    rows += [("mixed", symbols)] * 8 + [("mixed", good)] * 32
    rows += [(None, symbols), (None, good), ("good1", "short")]
    docs = frame(spark, [(i, t, h) for i, (h, t) in enumerate(rows)])
    out = Q.judged(docs)
    assert {r["host"] for r in out.filter("host_rejected").select("host").distinct().collect()} == {"bad"}
    assert out.filter("host = 'bad' AND kept").count() == 0
    assert out.filter("host IS NULL AND kept").count() == 2
    assert out.filter("host = 'good1'").filter("NOT kept").count() == 1  # its own base rules
    rates = {r["host"]: r for r in Q.host_verdicts(Q.host_rates(Q.measured(docs), "source")).collect()}
    assert rates["good2"]["symbols"] < rates["mixed"]["symbols"] < rates["bad"]["symbols"] < 40 / 44
    assert rates["mixed"]["symbols"] != 0.2 and rates["tiny"]["symbols"] <= Q.HOST_LIMIT


def test_priors_find_the_spread_of_the_hosts(spark):
    r = random.Random(1)
    made = []
    for h in range(400):
        rate = r.betavariate(2, 8)
        n = r.randrange(20, 200)
        made.append((f"h{h}", n, sum(r.random() < rate for _ in range(n))))
    hosts = spark.createDataFrame(made, "host string, n long, symbols long")
    alpha, beta = Q.beta_priors(hosts, {"symbols": ""})["symbols"]
    assert 1.4 < alpha < 2.8 and 5.5 < beta < 11.5
    assert Q.beta_priors(hosts.filter("n < 0"), {"symbols": ""})["symbols"][0] == 0.0
    one = Q.beta_priors(hosts.limit(1), {"symbols": ""})["symbols"]
    assert sum(one) == pytest.approx(1 / Q.CORRELATION[0] - 1)


def test_empty_table_and_a_very_long_text(spark):
    assert Q.judged(frame(spark, [])).count() == 0
    line = " ".join(f"w{i}" for i in range(50_000))
    row = Q.judged(frame(spark, [(1, line + "\n" + line, "h")])).first()
    assert (row["n_words"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"]) == (100_000, 1, 100_000, True)
