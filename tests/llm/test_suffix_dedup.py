"""Suffix dedup against a table of all 100-byte strings, the loser tree against sorting, edge cases."""

import hashlib
import random

from strata.llm import suffix_dedup as S

SCHEMA = "doc_id long, text string"


def brute(rows):
    """Per doc_id (distinct ids) the removed spans."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - S.LENGTH + 1):
            s = raw[i:i + S.LENGTH]
            if s in seen:
                gone[i:i + S.LENGTH] = b"\1" * S.LENGTH
            seen.add(s)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(spark, rows, schema=SCHEMA):
    got = S.without_repeats(spark.createDataFrame(rows, schema)).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}


def texts(seed, n=60):
    r = random.Random(seed)
    say = lambda k: "".join(r.choice("abcdeé \n") for _ in range(k))
    shared = [say(k) for k in (95, 98, 101, 120, 150, 400)]
    rows = []
    for d in range(n):
        body = [say(r.choice([0, 3, 40, 200])) for _ in range(4)]
        for _ in range(r.choice([0, 1, 3])):
            s = r.choice(shared)
            a = r.choice([0, 0, 1, 5, 30])
            body.insert(r.randrange(len(body)), s[a:len(s) - r.choice([0, 0, 2, 9])])
        rows.append((d, "".join(body)))
    return rows


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = texts(seed)
        want = brute(rows)
        assert sum(v[1] > 0 for v in want.values()) > 10
        assert found(spark, rows) == want


def test_rows_without_an_id_and_texts_that_share_one_are_judged_by_themselves(spark):
    r = random.Random(12)
    say = lambda k: "".join(r.choice("abcdeé ") for _ in range(k))
    line = say(180)
    rows = [(1, "aaa " + line), (None, "bbb " + line), (None, "short, unrelated: " + say(50)), (None, None), (7, line + "x"), (7, say(90) + line),
            (7, line + "x"), (None, "ccc " + line), (None, "ccc " + line), (8, say(300)), (8, say(20)), (9, "ddd " + line), (5, None), (5, line)]
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    different = sorted({(i is None, i or 0, sha(t), t or "") for i, t in rows})
    want = brute([(n, t) for n, (*_, t) in enumerate(different)])
    by_text = {(None if none else i, h): want[n] for n, (none, i, h, _) in enumerate(different)}
    got = S.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(x.n_removed <= x.n_bytes for x in got)
    assert sorted((x.doc_id is None, x.doc_id or 0, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got) == sorted(
        (i is None, i or 0, *by_text[i, sha(t)]) for i, t in rows)


def test_periodic_and_copied_texts(spark):
    rows = [(5, "ab" * 300), (6, "x" * 500), (7, "x" * 99), (8, "x" * 100), (9, "abc" * 100 + "x" * 150), (10, "ab" * 300),
            (11, "the of " * 4000), (3, "the of " * 40), (12, "q" + "ab" * 60 + "q"), (13, "q" + "ab" * 60 + "q")]
    assert found(spark, rows) == brute(rows)


def test_defined_edge_cases(spark):
    long = "".join(random.Random(8).choices("abcdefgh", k=400))
    rows = [(1, None), (2, ""), (None, long), (4, long), (2**40, long[50:]), (-3, "z" + long[10:200])]
    assert found(spark, rows) == brute(rows)
    again = S.without_repeats(spark.createDataFrame([(1, long), (1, long), (2, long)], SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in again) == [(1, 0), (1, 0), (2, 400)]
    assert S.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, long, "a"), (2, long, "b")], SCHEMA + ", doc string")
    assert sorted((r.doc_id, r.n_removed) for r in S.without_repeats(clash).collect()) == [(1, 0), (2, 400)]


def test_text_longer_than_a_piece(spark, monkeypatch):
    r = random.Random(4)
    block = "".join(r.choice("abcdefgh") for _ in range(700_000))
    rows = [(1, block + "0" + block[:600_000]), (2, block[100:200] + "!" + block[500_000:])]
    assert found(spark, rows) == brute(rows)


def test_loser_tree_sorts_and_measures():
    r = random.Random(9)
    for k in (1, 2, 3, 7):
        runs, flat = [], []
        for _ in range(k):
            words = sorted(bytes(r.choice(b"ab") for _ in range(r.randint(30, 60)))[:100] for _ in range(r.randint(1, 40)))
            row = S.front_coded(0, [(w, b"", 0, 0) for w in words])
            runs.append(S.Run(row[2], row[3], row[7]))
            flat.append(words)
        out = [(flat[a][i], share) for a, i, share in S.LoserTree(runs)]
        assert [w for w, _ in out] == sorted(w for ws in flat for w in ws)
        for (a, _), (b, share) in zip(out, out[1:]):
            assert share == S.shared_from(a, b, 0)


def test_texts_are_stored_where_their_spans_come_to(spark):
    base = bytes(range(97, 123)) * 8
    docs = spark.createDataFrame([(i, f"{i:03d}" * i + base.decode() + "x" * i) for i in range(1, 7)], "doc_id long, text string")
    before = spark.sql("SHOW TABLES").count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = S.without_repeats(docs)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = sorted((r.doc_id, r.n_removed) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    scan = next(x for x in plan.split("SortMergeJoin") if "LeftOuter" in x[:60] and "FileScan parquet spark_catalog" in x)
    assert "Exchange" not in scan[:scan.index("FileScan parquet spark_catalog")] and "Bucketed: true" in scan
    assert [i for i, _ in rows] == [*range(1, 7)] and all(n >= 208 for _, n in rows[1:])
    assert spark.sql("SHOW TABLES").count() == before
