"""Hard negatives by inner product from an inverted multi-index.

The index: every vector is cut in two halves, each half has a codebook, and a pair of
codes is a cell. With r the radius of a code (the farthest member half from its
centroid c), every member half x satisfies q.c - |q| r <= q.x <= q.c + |q| r, so a cell's
scores lie between the sums of its two half bounds. A search sorts the codes of both
halves by their upper half bound and visits cells from a heap in order of the summed
bound (the multi-sequence order): no unvisited cell can hold a better score than the
heap's top. It stops once what is asked for is certified:

* positives: the k best rows of the anchor's label are known to be better than any row
  left (equal scores are visited too: ties go to the smaller id);
* negatives: each positive asks for the first rows of other labels in a window
  ``LOW``..``HIGH`` percent of its score. A window is certified when it is full and its
  last score beats the bound, or when the bound has passed below the window. Cells
  that lie above all windows are skipped by their lower bound.

On Spark: codebooks are fitted on at most ``2 * SAMPLE`` rows taken by hash; every row is
coded and indexed. Neighbouring cells form shards of about ``SHARD_VALUES`` numbers, a
larger cell (equal vectors, for instance) is dealt by id over several, and the shards
are stored. An anchor first searches its home shard; what it finds there is the
threshold that decides, from the shards' bounds alone, which other shards it
must visit. Shards are repeated only for the blocks of anchors that visit them. The driver
holds the codebooks and the cell directory (at most ``MAX_CODES`` squared entries a
dimension). Scores are exact: as doubles below 2^53, as Python integers beyond.

Defined results: rows whose id, label or vector is null, or with null or non-finite
components, take no part; of rows that repeat a vec_id the one with the smallest (vector,
label) counts; vectors of different lengths are not compared; ties go to the smaller
vec_id; positives with a negative score have an empty window; scores beyond a
long are cut to it; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import parts_for, stored, table

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90       # the window, percent of the positive's score
SCALE = 256
SAMPLE = 16_384          # rows that the codebooks are fitted on, about; twice that at most
CELL = 128               # rows of a cell, on average, while there are codes enough
MAX_CODES = 256          # codes of a half at most
SHARD_VALUES = 1 << 19   # components of a shard: 8192 rows of 64
QUERY_BLOCK = 512        # anchors that visit a shard together
BATCH = 1024             # rows scored at once
ROUNDS = 8               # of k-means
EXACT = 2.0 ** 53
LEAST, MOST = -2**63, 2**63 - 1


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("double"))


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = x.shape[-1] // 2
    return x[..., :at], x[..., at:]


def apart(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, rows of ``x`` by centroids."""
    return np.maximum((x * x).sum(1)[:, None] + (centroids * centroids).sum(1)[None, :] - 2 * x @ centroids.T, 0.0)


def codebook(x: np.ndarray, codes: int, seed: int = 7) -> np.ndarray:
    """Centroids of ``x`` by k-means; codes without members are dropped."""
    different = np.unique(x, axis=0)
    centroids = np.random.default_rng(seed).permutation(different)[:codes].astype(float)
    for _ in range(ROUNDS):
        nearest = apart(x, centroids).argmin(1)
        used = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        centroids = sums[used > 0] / used[used > 0][:, None]
    return centroids


def products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, cut to a long."""
    if len(rows) and np.abs(rows).max(initial=0) * np.abs(q).max(initial=0) * max(1, len(q)) >= EXACT:
        wide = [sum(int(a) * int(b) for a, b in zip(r, q)) for r in rows]
        return np.array([max(LEAST, min(MOST, s)) for s in wide], np.int64)
    return np.rint(rows @ q).astype(np.int64)


class Bounds:
    """The directory of one dimension: centroids and radii of both halves, the cells in use."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray], cells: np.ndarray, shards: np.ndarray):
        self.books, self.radii, self.cells, self.shards = books, radii, cells, shards

    def of(self, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Lower and upper half bounds of every code, widened for rounding."""
        low, high = [], []
        for part, book, radius in zip(halves(q), self.books, self.radii):
            middle, reach = book @ part, np.sqrt(part @ part) * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
            low.append(middle - reach - slack)
            high.append(middle + reach + slack)
        return low, high


def multi_sequence(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) over all pairs, by falling sum of first[i] + second[j]."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[a[0]] + second[b[0]]), 0, 0)] if len(a) and len(b) else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):  # a pair is reached along its own row only
            heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))


class Best:
    """The first ``k`` (score, id) of what is offered, within a window of scores."""

    def __init__(self, k: int, low: int, high: int, floor: int = LEAST):
        """``floor``: a score that k rows are known to reach."""
        self.k, self.high, self.least = k, high, max(low, floor)
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.needed()) & (scores <= self.high)
        if fits.any():
            s, i = np.concatenate([self.scores, scores[fits]]), np.concatenate([self.ids, ids[fits]])
            first = np.lexsort((i, -s))[:self.k]
            self.scores, self.ids = s[first], i[first]

    def needed(self) -> int:
        """Rows below this score cannot be among the first k."""
        return max(self.least, int(self.scores[-1])) if len(self.scores) == self.k else self.least


class Shard:
    """Some cells of the index with their rows."""

    def __init__(self, rows: pd.DataFrame, bounds: Bounds):
        rows = rows.sort_values(["c1", "c2", "vec_id"])
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.vectors = np.array(rows["e"].tolist(), float).reshape(len(rows), -1)
        cells, starts = np.unique(rows[["c1", "c2"]].to_numpy(), axis=0, return_index=True)
        ends = np.append(starts[1:], len(rows))
        self.cells = {(int(a), int(b)): (s, e) for (a, b), s, e in zip(cells, starts, ends)}
        self.first, self.second = np.unique(cells[:, 0]), np.unique(cells[:, 1])
        self.bounds = bounds

    def search(self, anchor: int, label: int, q: np.ndarray, wanted: list[Best], same: bool) -> int:
        """Offers every row that can matter to ``wanted``; returns the number of rows scored."""
        low, high = self.bounds.of(q)
        scored, batch, size = 0, [], 0

        def score() -> None:
            at = np.concatenate([np.arange(*cell) for cell in batch])
            fits = at[(self.labels[at] == label) == same]
            fits = fits[self.ids[fits] != anchor]
            s = products(self.vectors[fits], q)
            for best in wanted:
                best.offer(s, self.ids[fits])

        for bound, i, j in multi_sequence(high[0][self.first], high[1][self.second]):
            if bound < min((best.needed() for best in wanted), default=np.inf):
                break
            cell = (int(self.first[i]), int(self.second[j]))
            if cell not in self.cells or low[0][cell[0]] + low[1][cell[1]] > max(best.high for best in wanted):
                continue
            batch.append(self.cells[cell])
            size += batch[-1][1] - batch[-1][0]
            if size >= BATCH:
                score()
                scored, batch, size = scored + size, [], 0
        if batch:
            score()
        return scored + size


class Index:
    """A stored inverted multi-index: ``rows`` (dim, shard, c1, c2, vec_id, label, e), and the
    directory of each dimension on the driver."""

    def __init__(self, vectors: DataFrame, shard_values: int = SHARD_VALUES, sample: int = SAMPLE, cell: int = CELL):
        spark = vectors.sparkSession
        one = vectors.groupBy("vec_id").agg(F.min(F.struct("e", "label")).alias("v")).select("vec_id", "v.e", "v.label")
        one = stored(one.withColumn("dim", F.size("e")), "negatives-vectors")
        n = one.count()
        codes = max(1, min(MAX_CODES, round((n / cell) ** 0.5)))
        self.books = self._fit(one, n, codes, sample)
        coded = stored(self._coded(one), "negatives-coded")
        cells = (coded.groupBy("dim", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2"))
                 .orderBy("dim", "c1", "c2").toPandas())
        parts, self.directory = self._dealt(cells, shard_values)
        places = spark.createDataFrame(parts, "dim int, c1 int, c2 int, shard int, shards int")
        at = F.col("shard") + F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int")
        self.rows = stored(coded.join(F.broadcast(places), ["dim", "c1", "c2"])  # as many rows as cells: bounded
                           .select("dim", at.alias("shard"), "c1", "c2", "vec_id", "label", "e"), "negatives-index")

    @staticmethod
    def _fit(rows: DataFrame, n: int, codes: int, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        part = min(1.0, sample / max(1, n))
        taken = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 30)) < int(part * (1 << 30))).limit(2 * sample)

        def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            x = np.array(pdf["e"].tolist(), float).reshape(len(pdf), key[0])
            out = [(key[0], half, list(c)) for half, part in enumerate(halves(x)) for c in codebook(part, codes)]
            return pd.DataFrame(out, columns=["dim", "half", "centroid"])

        books: dict[int, tuple[list, list]] = {}
        fitted = taken.select("dim", "e").groupBy("dim").applyInPandas(fit, "dim int, half int, centroid array<double>")
        for r in fitted.orderBy("dim", "half", "centroid").collect():
            books.setdefault(r["dim"], ([], []))[r["half"]].append(r["centroid"])
        return {dim: tuple(np.array(b, float).reshape(len(b), -1) for b in pair) for dim, pair in books.items()}

    def book(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """The codebooks of a dimension; one code for dimensions that the sample lacks."""
        return self.books.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))

    def _coded(self, rows: DataFrame) -> DataFrame:
        book = self.book

        def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for dim, own in pdf.groupby("dim"):
                    x = np.array(own["e"].tolist(), float).reshape(len(own), dim)
                    out = own[["dim", "vec_id", "label", "e"]].copy()
                    for half, (part, centroids) in enumerate(zip(halves(x), book(dim)), 1):
                        nearest = apart(part, centroids).argmin(1)
                        out[f"c{half}"] = nearest.astype(np.int32)
                        out[f"r{half}"] = np.sqrt(((part - centroids[nearest]) ** 2).sum(1))
                    yield out

        return rows.select("dim", "vec_id", "label", "e").mapInPandas(
            code, "dim int, vec_id long, label long, e array<double>, c1 int, r1 double, c2 int, r2 double")

    def _dealt(self, cells: pd.DataFrame, shard_values: int) -> tuple[list[tuple], dict[int, Bounds]]:
        """Neighbouring cells go to one shard until it is full; a cell larger than a shard gets several."""
        parts, directory, shard, held = [], {}, 0, 0
        for dim, own in cells.groupby("dim"):
            full = max(1, shard_values // max(1, dim))
            known, shards = [], []
            for r in own.itertuples():
                pieces = parts_for(r.n, full)
                if held and (pieces > 1 or held + r.n > full):
                    shard, held = shard + 1, 0
                parts.append((int(dim), int(r.c1), int(r.c2), shard, pieces))
                known += [(r.c1, r.c2)] * pieces
                shards += range(shard, shard + pieces)
                shard, held = (shard + pieces, 0) if pieces > 1 else (shard, held + r.n)
            if held:
                shard, held = shard + 1, 0
            radii = tuple(own.groupby(c)[r].max().reindex(range(len(b)), fill_value=0.0).to_numpy()
                          for c, r, b in (("c1", "r1", self.book(dim)[0]), ("c2", "r2", self.book(dim)[1])))
            directory[int(dim)] = Bounds(self.book(dim), radii, np.array(known, int), np.array(shards, int))
        return parts, directory

    def visit(self, queries: DataFrame, same: bool, home: bool, block: int = QUERY_BLOCK) -> DataFrame:
        """One round of searches. ``queries``: dim, anchor_id, label, e, wants (array of struct
        positive_id, k, low, high, floor — what rows of this anchor are asked for).

        The home round visits one shard an anchor, the other round every further shard whose
        bounds allow a row that is still wanted. Returns anchor_id, positive_id, vec_id, score."""
        directory = self.directory

        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                anchors, shards = [], []
                for at, r in enumerate(pdf.itertuples()):
                    bounds = directory.get(r.dim)
                    if bounds is None or not len(r.wants):
                        continue
                    low, high = ([part[0][bounds.cells[:, 0]] + part[1][bounds.cells[:, 1]]] for part in bounds.of(np.asarray(r.e, float)))
                    top = max(w["high"] for w in r.wants)
                    middle = (low[0] + high[0]) / 2
                    nearest = int(bounds.shards[np.argmax(np.where(middle <= top, middle, -np.abs(middle) - 1e300))])
                    if home:
                        chosen = [nearest]
                    else:
                        least = min(max(w["low"], w["floor"]) for w in r.wants)
                        chosen = np.setdiff1d(np.unique(bounds.shards[(high[0] >= least) & (low[0] <= top)]), [nearest])
                    anchors += [at] * len(chosen)
                    shards += list(chosen)
                yield pdf.iloc[anchors].assign(shard=np.array(shards, np.int32))

        routed = queries.mapInPandas(route, "dim int, anchor_id long, label long, e array<double>, wants array<struct<"
                                            "positive_id: long, k: int, low: long, high: long, floor: long>>, shard int")
        routed = stored(routed, "negatives-visits")
        visits = routed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
        # names of its own: a cogroup tells its sides apart by their columns
        here = visits.select(F.col("shard").alias("of"), F.col("blocks").alias("n_blocks"))
        left = self.rows.join(here, F.col("shard") == F.col("of")).drop("of").withColumn("block", F.explode(F.expr("sequence(0, n_blocks - 1)")))
        right = routed.join(visits, "shard").withColumn("block", F.pmod(F.xxhash64("anchor_id"), F.col("blocks")).cast("int"))

        def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(rows) and len(queries):
                shard = Shard(rows, directory[int(rows["dim"].iloc[0])])
                for r in queries.itertuples():
                    wanted = [Best(w["k"], w["low"], w["high"], w["floor"]) for w in r.wants]
                    shard.search(r.anchor_id, r.label, np.asarray(r.e, float), wanted, same)
                    out += [(r.anchor_id, w["positive_id"], i, s) for w, best in zip(r.wants, wanted)
                            for i, s in zip(best.ids.tolist(), best.scores.tolist())]
            return pd.DataFrame(out, columns=["anchor_id", "positive_id", "vec_id", "score"])

        return (left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
                .applyInPandas(search, "anchor_id long, positive_id long, vec_id long, score long"))

    def first(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """anchor_id, positive_id, rank, vec_id, score: the first k rows of every want, from two rounds."""
        order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")  # k rows a shard
        ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        near = stored(ranked(self.visit(queries, same, True)), "negatives-home")
        floors = (near.filter(F.col("rank") == k).groupBy("anchor_id")
                  .agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("positive_id", F.lit(-1)), "score"))).alias("floors")))
        raised = F.transform("wants", lambda w: w.withField("floor", F.greatest(
            w["floor"], F.coalesce(F.element_at("floors", F.coalesce(w["positive_id"], F.lit(-1))), w["floor"]))))
        rest = queries.join(floors, "anchor_id", "left").withColumn("wants", raised).select(queries.columns)
        return ranked(near.drop("rank").unionByName(self.visit(rest, same, False)))


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, **sizes: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, label, e (whole numbers); ``anchors``: which of them ask."""
    index = Index(vectors, **sizes)
    asking = index.rows.filter(anchors).select("dim", F.col("vec_id").alias("anchor_id"), "label", "e")
    want = lambda positive, k, a, b: F.struct(positive.alias("positive_id"), F.lit(k).cast("int").alias("k"),
                                              a.cast("long").alias("low"), b.cast("long").alias("high"),
                                              F.lit(LEAST).cast("long").alias("floor"))
    best = F.array(want(F.lit(None).cast("long"), positives, F.lit(LEAST), F.lit(MOST)))
    found = stored(index.first(asking.withColumn("wants", best), True, positives)
                   .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # low * p <= 100 * s <= high * p in whole numbers; decimals, as the products may pass a long
    p = F.col("positive_score").cast("decimal(28,0)")
    windows = (found.filter(F.col("positive_score") >= 0).groupBy("anchor_id")
               .agg(F.collect_list(want(F.col("positive_id"), negatives, F.ceil(p * low / 100), F.floor(p * high / 100))).alias("wants")))
    mined = index.first(asking.join(windows, "anchor_id"), False, negatives)
    return (mined.join(found, ["anchor_id", "positive_id"])
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "embeddings")
    used = raw.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = used.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                          quantised(F.col("embedding")).alias("e"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLE = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other, a.label = o.label AS same, list_inner_product(a.e, o.e)::BIGINT AS score
      FROM v a JOIN v o ON a.vec_id <> o.vec_id AND len(a.e) = len(o.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}),
n AS (SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {NEGATIVES}
"""
