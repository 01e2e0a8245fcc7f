"""Exact top-k by inner product with M-trees and best-first search.

Inner product becomes a distance: with every vector x extended by
sqrt(M^2 - |x|^2), M the largest norm, and the query q by 0, the squared distance
is |q|^2 + M^2 - 2 q.x, so the nearest vectors have the largest products.

The vectors are dealt by id hash over shards of about ``SHARD`` vectors, so a
vector that occurs very often lands everywhere alike. Each shard is an M-tree,
stored as pages: a page's entries carry their distance to the page's routing
object and, in inner pages, a covering radius and the child page. Query blocks of
at most ``QUERY_BLOCK`` rows visit every shard. A search takes pages from a queue
in order of their least possible distance; with the distance from the query to
the page's routing object known, the triangle inequality rules out entries by
their stored distance before any new one is computed, and the search ends when
the queue's best page is farther than the k-th neighbour. Scores are integers,
computed exactly; bounds have a margin for rounding, so results are exact.

Defined results: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; of rows that repeat a vec_id the one with the
smallest vector counts; vectors of different lengths are not compared; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import parts_for, stored, table

K = 5
SHARD = 8192        # vectors per tree, on average
QUERY_BLOCK = 1024  # queries that visit a tree together, on average
PAGE = 512          # entries of a page
FANOUT = 32         # routing objects per split
SCALE = 256
SLACK = 1e-6        # relative margin for rounding in distances


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("double"))


class MTree:
    """``pages``: page number → (routing vector or -1, entry vectors, distance to the
    routing vector, covering radii or None, child pages or None)."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, pages: list):
        self.points, self.ids, self.pages = points, ids, pages
        norms = (points * points).sum(axis=1)
        self.far2 = norms.max(initial=0.0)
        self.extra = np.sqrt(np.maximum(self.far2 - norms, 0.0))
        self.blocks: dict[int, np.ndarray] = {}  # page → its entries' vectors side by side, once visited

    @classmethod
    def build(cls, points: np.ndarray, ids: np.ndarray, seed: int = 7) -> "MTree":
        tree = cls(points, ids, [])
        tree._grow(np.arange(len(ids)), -1, np.random.default_rng(seed))
        return tree

    def between(self, one: int, many: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.points[many] - self.points[one]) ** 2).sum(axis=1)
                       + (self.extra[many] - self.extra[one]) ** 2)

    def _grow(self, members: np.ndarray, routing: int, random: np.random.Generator) -> int:
        """Add the page that covers ``members``; returns its number."""
        number = len(self.pages)
        self.pages.append(None)
        to_routing = self.between(routing, members) if routing >= 0 else np.zeros(len(members))
        if len(members) <= PAGE:
            self.pages[number] = (routing, members, to_routing, None, None)
            return number
        pivots = random.choice(members, FANOUT, replace=False)
        distance = np.stack([self.between(p, members) for p in pivots], axis=1)
        nearest = distance.argmin(axis=1)
        if np.bincount(nearest, minlength=FANOUT).max() > 0.9 * len(members):  # mostly equal vectors: split evenly
            nearest = np.arange(len(members)) % FANOUT
        radii, children, kept = [], [], []
        for j, p in enumerate(pivots):
            own = nearest == j
            if own.any():
                kept.append(p)
                radii.append(distance[own, j].max())
                children.append(self._grow(members[own], p, random))
        kept = np.array(kept)
        self.pages[number] = (routing, kept, self.between(routing, kept) if routing >= 0 else np.zeros(len(kept)),
                              np.array(radii), np.array(children))
        return number

    def to_rows(self) -> Iterator[dict]:
        """One row per page."""
        for number, (routing, entries, to_routing, radii, children) in enumerate(self.pages):
            yield {"page": number, "routing": routing, "leaf": radii is None, "entries": entries, "parent_distance": to_routing,
                   "radii": [] if radii is None else radii, "children": [] if children is None else children,
                   "ids": self.ids[entries], "vectors": self.points[entries].ravel()}

    @classmethod
    def from_rows(cls, rows: pd.DataFrame) -> "MTree":
        """The tree of a shard from its page rows."""
        leaves = rows[rows["leaf"]]
        at = np.concatenate([np.asarray(x) for x in leaves["entries"]]) if len(leaves) else np.zeros(0, int)
        flat = np.concatenate([np.asarray(x) for x in leaves["vectors"]]) if len(leaves) else np.zeros(0)
        points = np.zeros((len(at), len(flat) // max(1, len(at))))
        ids = np.zeros(len(at), np.int64)
        points[at] = flat.reshape(points.shape)
        ids[at] = np.concatenate([np.asarray(x) for x in leaves["ids"]]) if len(leaves) else ids
        pages = [None] * len(rows)
        for r in rows.itertuples():
            inner = not r.leaf
            pages[r.page] = (r.routing, np.asarray(r.entries), np.asarray(r.parent_distance),
                             np.asarray(r.radii) if inner else None, np.asarray(r.children) if inner else None)
        return cls(points, ids, pages)

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[list[tuple[float, int]], int]:
        """The k best (score, id), best first, and how many distances were computed."""
        q2 = float(q @ q)
        margin = SLACK * np.sqrt(q2 + self.far2 + 1)
        best: list[tuple[float, int]] = []  # heap of (score, -id): its top is the one to beat
        reach = np.inf
        queue = [(0.0, 0, None)]
        computed = 0
        while queue:
            least, number, to_parent = heapq.heappop(queue)
            if least > reach:
                break
            routing, entries, stored_, radii, children = self.pages[number]
            cover = 0.0 if radii is None else radii
            if to_parent is not None:
                open_ = np.flatnonzero(np.abs(to_parent - stored_) - cover <= reach + margin)
                if not len(open_):
                    continue
            else:
                open_ = np.arange(len(entries))
            block = self.blocks.get(number)
            if block is None:
                block = self.blocks[number] = self.points[entries]
            # whole numbers below 2^53: exact
            score = (block if len(open_) == len(entries) else block[open_]) @ q
            computed += len(open_)
            distance = np.sqrt(np.maximum(q2 + self.far2 - 2 * score, 0.0))
            if radii is not None:
                bound = np.maximum(distance - radii[open_], 0.0)
                for b, d, child in zip(bound, distance, children[open_]):
                    if b <= reach + margin:
                        heapq.heappush(queue, (max(0.0, b - margin), int(child), float(d)))
                continue
            near = np.flatnonzero(distance <= reach + margin)
            ids = self.ids[entries[open_[near]]]
            if len(near) > 4 * k:  # the page's own k best, and one more as the query itself may be among them
                first = np.lexsort((ids, -score[near]))[:k + 1]
                near, ids = near[first], ids[first]
            for s, i in zip(score[near].tolist(), ids.tolist()):
                if i == query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
            if len(best) == k:
                reach = np.sqrt(max(q2 + self.far2 - 2 * best[0][0], 0.0)) + margin
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1])), computed


PAGES = ("dim int, shard int, page int, routing int, leaf boolean, entries array<int>, parent_distance array<double>, "
         "radii array<double>, children array<int>, ids array<long>, vectors array<double>")


def index(vectors: DataFrame, shard: int = SHARD) -> tuple[DataFrame, int]:
    """The stored page table of ``vectors`` (vec_id, e), and the number of shards."""
    n = vectors.count()
    shards = parts_for(n, shard)

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(e=[tuple(x) for x in pdf["e"]]).sort_values(["vec_id", "e"]).drop_duplicates("vec_id")
        points = np.array(pdf["e"].tolist(), float).reshape(len(pdf), key[0])
        rows = pd.DataFrame(MTree.build(points, pdf["vec_id"].to_numpy()).to_rows())
        return rows.assign(dim=key[0], shard=key[1])[[c.split()[0] for c in PAGES.split(", ")]]

    dealt = vectors.select(F.size("e").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                           "vec_id", "e")
    return stored(dealt.groupBy("dim", "shard").applyInPandas(grow, PAGES), "mtree-pages"), shards


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score for every row of ``queries`` (both: vec_id, e — whole numbers)."""
    pages, shards = index(vectors, shard)
    queries = queries.groupBy("vec_id").agg(F.min("e").alias("e"))
    blocks = parts_for(queries.count(), block)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = pages.withColumn("block", each(blocks))
    right = queries.select(F.size("e").alias("dim"), each(shards).alias("shard"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "e")

    def search(pages: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(pages) and len(queries):
            tree = MTree.from_rows(pages)
            for query_id, e in zip(queries["vec_id"], queries["e"]):
                out += [(query_id, i, int(s)) for s, i in tree.search(query_id, np.asarray(e, float), k)[0]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = (left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim", "shard", "block"))
             .applyInPandas(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows a shard
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op10_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "embeddings")
    vectors = (raw.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
               .select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("e")))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
