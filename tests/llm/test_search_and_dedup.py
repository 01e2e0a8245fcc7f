"""M-tree, cuckoo filters, line index and SimHash against plain restatements; edge cases."""

import random

import duckdb
import numpy as np
import pytest

from strata import llm
from strata.llm import line_dedup as L
from strata.llm import mtree as M
from strata.llm import simhash as S
from strata.llm.components import connected_components
from strata.llm.cuckoo import CuckooFilter
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    con.execute(llm.ORACLE[name])
    want, columns = con.fetchall(), None
    columns = [d[0] for d in con.execute(llm.ORACLE[name]).description]
    df = llm.QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_tree_search_is_exact_and_prunes():
    r = np.random.default_rng(2)
    centres = r.integers(-200, 200, (12, 6))
    points = np.concatenate([c + r.integers(-4, 5, (300, 6)) for c in centres]).astype(float)
    points[:500] = points[0]  # one vector very often
    ids = r.permutation(len(points))
    rows = __import__("pandas").DataFrame(list(M.MTree.build(points, ids).to_rows()))
    tree = M.MTree.from_rows(rows)
    computed = 0
    for q in range(0, len(points), 97):
        best, n = tree.search(int(ids[q]), points[q], 5)
        computed += n
        score = points @ points[q]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:5]
        assert best == [(score[i], ids[i]) for i in order]
    assert computed < 0.8 * len(points) * len(range(0, len(points), 97))


def test_top_k_edge_cases(spark):
    nan = float("nan")
    rows = [(0, [0.5, 0.5]), (50, [0.5, -1.0]), (1, [0.5, nan]), (2, None), (3, [0.1, None]), (None, [1.0, 1.0]),
            (4, [0.5, 0.5]), (5, [1.0]), (100, [2.0]), (6, [0.5, 0.5]), (6, [0.5, 0.5]), (150, [float("inf"), 0.0])]
    raw = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    from pyspark.sql import functions as F
    v = raw.filter(F.col("vec_id").isNotNull() & M.usable(F.col("embedding"))).select("vec_id", M.quantised(F.col("embedding")).alias("e"))
    got = sorted(tuple(x) for x in M.top_k(v, v.filter("vec_id % 50 = 0"), shard=2, block=1).collect())
    assert got == [(0, 1, 4, 32768), (0, 2, 6, 32768), (0, 3, 50, -16384), (50, 1, 0, -16384), (50, 2, 4, -16384),
                   (50, 3, 6, -16384), (100, 1, 5, 131072)]
    assert M.top_k(v.limit(0), v.limit(0)).count() == 0


def test_cuckoo_filter_holds_and_forgets():
    r = np.random.default_rng(1)
    keys = r.integers(0, 2**63, 30_000).astype(np.uint64)
    f = CuckooFilter.from_bytes(CuckooFilter.of(keys).to_bytes())
    assert f.contains(keys).all()
    assert f.contains(r.integers(0, 2**63, 30_000).astype(np.uint64)).mean() < 0.01
    f.delete(keys[:10_000])
    assert f.contains(keys[10_000:]).all() and f.contains(keys[:10_000]).mean() < 0.01
    assert f.insert(keys[:5_000]) and f.contains(keys[:5_000]).all()
    assert CuckooFilter.of(np.zeros(0, np.uint64)).contains(keys[:3]).sum() == 0


LINES = ["a line that is repeated", "  A Line That is repeated\t", "short", "only here and nowhere", "ünïcode line ÄB",
         "ünïcode line äb", "", "another repeated line\r", "another repeated line"]


def line_rows(seed, n=50, first=0):
    r = random.Random(seed)
    return [(first + d, "\n".join(r.choice([*LINES, f"unique text {d} {r.random()}"]) for _ in range(r.randint(0, 6))))
            for d in range(n)]


def lines_restated(rows):
    holders = {}
    for d, t in rows:
        for x in (t or "").split("\n"):
            if k := L.key_hash(x):
                holders.setdefault(k, set()).add(float("inf") if d is None else d)
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        me = float("inf") if d is None else d
        kept = [x for x in lines if not ((k := L.key_hash(x)) and len(holders[k]) > 1 and min(holders[k]) != me)]
        out[d] = (len(lines), len(lines) - len(kept), __import__("hashlib").sha256("\n".join(kept).encode()).hexdigest())
    return out


def decided(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect()}


def test_line_index_inserts_and_deletes(spark):
    def frame(rows):
        return spark.createDataFrame([(*r, 1, b"k") for r in rows], "doc_id long, text string, doc int, key binary")

    first, second = line_rows(1), line_rows(2, 30, 100)
    first += [(None, "a line that is repeated\nthe odd one"), (60, None), (61, "x" * 300_000 + "\n" + LINES[0])]
    index = L.LineIndex.build(frame(first), shards=3)
    assert decided(L.deduped(frame(first), index)) == lines_restated(first)
    both = index.insert(frame(second))
    assert decided(L.deduped(frame(first + second), both)) == lines_restated(first + second)
    assert sorted(map(tuple, both.insert(frame(second)).repeated().collect())) == sorted(map(tuple, both.repeated().collect()))
    back = both.delete(frame(second).select("doc_id"))
    assert decided(L.deduped(frame(first), back)) == lines_restated(first)
    gone = [r for r in first if r[0] is not None and r[0] % 2]
    less = back.delete(frame(gone).select("doc_id"))
    rest = [r for r in first if r not in gone]
    assert decided(L.deduped(frame(rest), less)) == lines_restated(rest)
    empty = frame(first).limit(0)
    assert L.deduped(empty, L.LineIndex.build(empty)).count() == 0


def test_hot_line_is_salted(spark, monkeypatch):
    monkeypatch.setattr(L, "REFS_PER_GROUP", 7)
    rows = [(d, "the very same line\n" + f"line number {d}") for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert decided(L.deduped(docs, L.LineIndex.build(docs, shards=2))) == lines_restated(rows)


def simhash_restated(rows):
    prints = [(float("inf") if d is None else d, S.fingerprint(t)) for d, t in rows]
    label = {d: d for d, _ in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints:
            for b, y in prints:
                if (x ^ y).bit_count() <= 3 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {d: label[float("inf") if d is None else d] for d, _ in rows}


def test_simhash_components(spark):
    r = random.Random(6)
    rows, base = [], [f"w{r.randint(0, 50)}" for _ in range(400)]
    for d in range(70):
        words = list(base) if d % 3 else [f"v{r.randint(0, 999)}" for _ in range(r.choice([0, 1, 2, 3, 80]))]
        for _ in range(d % 4):
            if words:
                words[r.randrange(len(words))] = "Changed"
        rows.append((d, r.choice([" ", "\n", "\t "]).join(words)))
    rows += [(None, rows[1][1]), (200, None), (201, " \n\x0b"), (202, "z" * 200_000)]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, fp int")
    want = {d: None if c == float("inf") else c for d, c in simhash_restated(rows).items()}
    for most in (None, 4):
        got = S.simhash_components(docs, most=most).collect()
        assert {x.doc_id: x.component_id for x in got} == want and len(got) == len(rows)
        assert all(x.fingerprint == "0" * 16 for x in got if x.doc_id in (200, 201))
    assert S.simhash_components(docs.limit(0)).count() == 0


def test_fingerprint_is_the_majority_of_xxh64_bits():
    import xxhash

    text = "The cat\tsat on THE mat the cat\x0bsat"
    words = text.encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert S.fingerprint(text) == want and S.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 300), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 200, 300: 200}
