"""Hard negatives: the search and its bounds against brute force, hot vectors, many shards, edge cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as H

SIZES = {"shard_values": 400, "sample": 64, "cell": 8}


def brute(rows, every=1, positives=5, negatives=10, low=30, high=90):
    """rows: (vec_id, label, whole numbers)."""
    out = []
    for a, label, q in rows:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, e)), i, other) for i, other, e in rows if i != a and len(e) == len(q)]
        for minus, p, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            fits = sorted(x for x in scored if x[2] != label and low * -minus <= -100 * x[0] <= high * -minus)
            out += [(a, p, rank, i, -minus, -s) for rank, (s, i, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, [float(v) for v in e]) for i, x, e in rows], "vec_id long, label long, e array<double>")


def mined(spark, rows, **more):
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % more.pop("every", 1) == 0, **{**SIZES, **more})
    return sorted(tuple(r) for r in got.collect())


def test_sums_come_in_falling_order():
    r = np.random.default_rng(3)
    a, b = r.integers(-9, 9, 7).astype(float), r.integers(-9, 9, 5).astype(float)
    seen = list(H.multi_sequence(a, b))
    assert [s for s, _, _ in seen] == sorted((x + y for x in a for y in b), reverse=True)
    assert len({(i, j) for _, i, j in seen}) == 35 and all(s == a[i] + b[j] for s, i, j in seen)
    assert list(H.multi_sequence(a[:0], b)) == []


def test_bounds_hold_and_spare_most_rows_of_clustered_vectors():
    r = np.random.default_rng(5)
    centres = r.integers(-300, 300, (10, 8))
    x = np.concatenate([c + r.integers(-3, 4, (200, 8)) for c in centres]).astype(float)
    books = tuple(H.codebook(part, 10) for part in H.halves(x))
    codes = [H.apart(part, book).argmin(1) for part, book in zip(H.halves(x), books)]
    radii = tuple(np.array([np.sqrt(((part[c == k] - book[k]) ** 2).sum(1)).max(initial=0) for k in range(len(book))])
                  for part, book, c in zip(H.halves(x), books, codes))
    bounds = H.Bounds(books, radii, None, None)
    labels = r.integers(0, 2, len(x))
    shard = H.Shard(pd.DataFrame({"c1": codes[0], "c2": codes[1], "vec_id": np.arange(len(x)), "label": labels, "e": list(x)}), bounds)
    scored = 0
    for a in range(0, len(x), 61):
        low, high = bounds.of(x[a])
        s = x @ x[a]
        assert (low[0][codes[0]] + low[1][codes[1]] <= s).all() and (s <= high[0][codes[0]] + high[1][codes[1]]).all()
        best = H.Best(5, H.LEAST, H.MOST)
        scored += shard.search(a, labels[a], x[a], [best], True)
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != a and labels[i] == labels[a]][:5]
        assert best.ids.tolist() == order and best.scores.tolist() == s[order].tolist()
        wanted = [H.Best(10, -(-30 * p // 100), 90 * p // 100) for p in best.scores.tolist()]
        lows = [-(-30 * p // 100) for p in best.scores.tolist()]
        shard.search(a, labels[a], x[a], wanted, False)
        for want, least in zip(wanted, lows):
            fits = [i for i in np.lexsort((np.arange(len(x)), -s)) if labels[i] != labels[a] and least <= s[i] <= want.high]
            assert want.ids.tolist() == fits[:10]
    assert scored < 0.7 * len(x) * len(range(0, len(x), 61))


def test_rows_equal_brute_force_over_many_shards(spark):
    r = np.random.default_rng(8)
    rows = [(i, int(r.integers(0, 3)), r.integers(-40, 60, 6).tolist()) for i in range(240)]
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(160)]  # one vector of two fifths of all rows: ties by id, several shards
    rows += [(2000 + i, i % 2, r.integers(-5, 9, 3).tolist()) for i in range(12)]  # another length
    assert mined(spark, rows, every=9) == brute(rows, every=9)
    index = H.Index(frame(spark, rows), **SIZES)
    sizes = [x["count"] for x in index.rows.groupBy("shard").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 2.5 * SIZES["shard_values"] / 6
    hot = index.rows.filter("vec_id >= 1000 AND vec_id < 2000").select("shard").distinct().count()
    assert hot > 1


def test_a_visit_is_repeated_only_where_a_bound_allows_it(spark):
    r = np.random.default_rng(9)
    centres = [[900, 0, 0, 0], [0, 900, 0, 0], [0, 0, 900, 0], [0, 0, 0, 900]]
    rows = [(4 * i + c, i % 2, (np.array(centre) + r.integers(0, 5, 4)).tolist()) for i in range(60) for c, centre in enumerate(centres)]
    index = H.Index(frame(spark, rows), shard_values=160, sample=500, cell=15)
    shards = index.rows.select("shard").distinct().count()
    asked = index.rows.select("dim", F.col("vec_id").alias("anchor_id"), "label", "e").withColumn(
        "wants", F.expr(f"array(struct(cast(null AS long) AS positive_id, 5 AS k, {H.LEAST + 1}L AS low, {H.MOST}L AS high, 400000L AS floor))"))
    found = index.visit(asked, True, False)
    assert shards >= 6 and found.count() < len(rows) * 5 * 4  # the 3 or 4 clusters at right angles are not visited for a positive
    assert mined(spark, rows, shard_values=160, sample=500, cell=15) == brute(rows)


@pytest.mark.parametrize("rows", [
    [], [(0, 1, [1, 2])], [(0, 1, [1, 2]), (1, 1, [3, 4])], [(0, 1, [1, 2]), (1, 2, [3, 4])],
    [(i, i % 2, [0, 0]) for i in range(6)], [(i, i % 2, [1]) for i in range(6)], [(i, i % 2, []) for i in range(4)],
    [(i, i % 2, [-1 if i else 1, 0]) for i in range(5)],
    [(-5, 0, [7, 1]), (0, 0, [7, 1]), (3, 1, [3, 0]), (4, 1, [7, 1])],
])
def test_small_tables(spark, rows):
    assert mined(spark, rows) == brute(rows)


def test_unusable_and_repeated_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    raw = [(0, [1.0, 1.0], 1), (100, [1.0, 0.9], 1), (1, [0.5, 0.5], 2), (1, [0.5, 0.5], 2), (1, [0.4, 0.5], 3), (2, None, 2), (3, [1.0, nan], 2),
           (4, [1.0, None], 2), (5, [0.5, inf], 2), (None, [0.5, 0.5], 2), (6, [0.5, 0.5], None), (7, [0.5, 0.4], 1)]
    df = spark.createDataFrame([(i, e, x, "s", 0.0) for i, e, x in raw], "vec_id long, embedding array<float>, label int, score string, dim double")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in H.op12_hard_negatives(spark, f"file://{tmp_path}").collect())
    rows = [(0, 1, [256, 256]), (100, 1, [256, 230]), (1, 3, [102, 128]), (7, 2, [128, 102])]
    rows[0] = (0, 2, rows[0][2])  # 0 is divisible by 7 too
    assert got == brute(rows, every=100)


def test_scores_beyond_doubles_are_exact():
    big = np.array([[2.0 ** 40 + 1, 3.0], [2.0 ** 40, 1.0]])
    assert H.products(big, np.array([2.0 ** 20 + 1, 1.0])).tolist() == [(2**40 + 1) * (2**20 + 1) + 3, 2**40 * (2**20 + 1) + 1]
    assert H.products(big, np.array([2.0 ** 60, 0.0])).tolist() == [H.MOST, H.MOST]
