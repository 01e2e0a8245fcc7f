"""SimHash near-dedup by a self-join of the binary trie of fingerprints.

1. Fingerprints: one Arrow pass over the documents; equal ones become one leaf.
2. Pairs of trie nodes are walked together from (root, root), ``STEP`` bits at a
   time, as a table: a pair whose prefixes differ in more than ``MAX_BITS`` bits
   is dropped, a pair with too many leaves below it is joined with the children
   of both nodes, any other pair is done. Node counts decide, so a
   prefix that many fingerprints share is split further down than others.
3. A done pair's leaves meet in one group of at most ``MOST``: the walk goes on
   there bit by bit over sorted arrays, down to node pairs of a few leaves, whose
   fingerprints are compared. Links leave the group as a spanning forest, never
   as all pairs of a dense cluster, so no link between components is lost.
4. Components of the forests' links (``components.py``); the nodes are fingerprints,
   so rows with a null or a repeated doc_id are linked by their own text only.

Defined results: null, empty and all-blank texts have fingerprint zero and link
like any other; a null doc_id sorts after all others and is returned as null;
component_id is the smallest doc_id of the component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import LAST_DOC, order_key, sliced, stored, table, text_key
from strata.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
STEP = 4           # bits per level of the distributed walk
LEAVES = 1 << 15   # leaves of a done node pair, at least: fewer, larger groups
MOST = 1 << 20     # repeat a leaf in fewer pairs, so groups grow with the input
SHARE = 64         # (a SHARE-th of all leaves) up to this many
FEW = 8            # leaves per node below which fingerprints are compared directly
BLOCK = 1 << 20    # comparisons or node pairs held at once


def fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    ends = ends[min(SHINGLE, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, fp, key): the order key of the id, the fingerprint's 64 bits as a long, and the text's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            fp = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), b.column(2)], ["doc", "fp", "key"])

    return docs.select(order_key(doc_id).alias("doc"), F.col(text).cast("string").alias("text"),
                       text_key(text).alias("key")).mapInArrow(run, "doc long, fp long, key string")


def prefix(fp: Column, bits: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - bits) if bits else F.lit(0).cast("long")


def node_pairs(leaves: DataFrame, max_bits: int = MAX_BITS, most: int | None = None) -> DataFrame:
    """(depth, u, v, diff): node pairs that together hold every pair of leaves within
    ``max_bits``, each with at most ``most`` leaves (or at full depth)."""
    total = leaves.count()
    most = most or min(MOST, max(LEAVES, total // SHARE))
    if total <= most:
        return leaves.sparkSession.createDataFrame([(0, 0, 0, 0)], "depth int, u long, v long, diff int")
    done, depth = None, 0
    open_pairs = leaves.sparkSession.createDataFrame([(0, 0, 0)], "u long, v long, diff int")
    while True:
        depth += STEP
        nodes = stored(leaves.groupBy(prefix(F.col("fp"), depth).alias("p")).agg(F.count("*").alias("n")), "trie-nodes")
        child = lambda name: nodes.select(F.shiftrightunsigned("p", STEP).alias(name), F.col("p").alias(f"{name}_c"),
                                          F.col("n").alias(f"{name}_n"))
        walked = (open_pairs.join(child("u"), "u").join(child("v"), "v")
                  .filter("u <> v OR u_c <= v_c")
                  .withColumn("diff", F.col("diff") + F.bit_count(F.col("u_c").bitwiseXOR(F.col("v_c"))
                                                                  .bitwiseAND(F.lit((1 << STEP) - 1))).cast("int"))
                  .filter(F.col("diff") <= max_bits)
                  .withColumn("size", F.col("u_n") + F.when(F.col("u_c") == F.col("v_c"), 0).otherwise(F.col("v_n"))))
        walked = stored(walked.select(F.col("u_c").alias("u"), F.col("v_c").alias("v"), "diff", "size"), "trie-pairs")
        small = (walked.filter((F.col("size") <= most) | F.lit(depth == 64))
                 .select(F.lit(depth).alias("depth"), "u", "v", "diff"))
        done = small if done is None else done.unionByName(small)
        open_pairs = walked.filter(F.col("size") > most).select("u", "v", "diff")
        if depth == 64 or open_pairs.isEmpty():
            return done


def forest(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per node the smallest node linked to it, over any number of links."""
    label = np.arange(nodes)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def join_subtrees(fp: np.ndarray, u: tuple[int, int], v: tuple[int, int], depth: int, diff: int, max_bits: int
                  ) -> np.ndarray:
    """Labels of ``fp`` (sorted uint64) after linking all pairs of the two leaf ranges within
    ``max_bits``; ``depth`` bits of each range agree, and the ranges differ in ``diff`` of them."""
    label = np.arange(len(fp))
    links: list[np.ndarray] = []
    held = 0

    def settle() -> None:
        nonlocal label, held
        if links:
            a, b = np.concatenate(links, axis=1)
            links.clear()
            held = 0
            label = forest(len(fp), np.concatenate([a, np.arange(len(fp))]), np.concatenate([b, label]))

    def compare(pairs: np.ndarray) -> None:
        nonlocal held
        for at in range(0, pairs.shape[1], BLOCK // (FEW * FEW)):
            lo_u, hi_u, lo_v, hi_v = pairs[:4, at:at + BLOCK // (FEW * FEW)]
            wide = hi_v - lo_v
            size = (hi_u - lo_u) * wide
            of = np.repeat(np.arange(len(size)), size)
            k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            a, b = lo_u[of] + k // wide[of], lo_v[of] + k % wide[of]
            near = (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits) & (a != b)
            links.append(np.stack([a[near], b[near]]))
            held += int(near.sum())
            if held > BLOCK:
                settle()

    stack = [(depth, np.array([[u[0]], [u[1]], [v[0]], [v[1]], [diff]], np.int64))]
    while stack:
        bit, pairs = stack.pop()
        few = ((pairs[1] - pairs[0] <= FEW) & (pairs[3] - pairs[2] <= FEW)) | (bit == 64)
        if few.any():
            compare(pairs[:, few])
            pairs = pairs[:, ~few]
        if not pairs.shape[1]:
            continue
        mask = np.uint64(1 << (63 - bit))
        below = np.uint64((1 << (63 - bit)) - 1)
        split = lambda lo: np.searchsorted(fp, (fp[lo] | mask) & ~below)
        lo_u, hi_u, lo_v, hi_v, d = pairs
        mid_u = np.clip(split(lo_u), lo_u, hi_u)
        mid_v = np.clip(split(lo_v), lo_v, hi_v)
        same = lo_u == lo_v  # a node with itself: its two children meet once
        grown = np.concatenate([
            np.stack([lo_u, mid_u, lo_v, mid_v, d]),
            np.stack([mid_u, hi_u, mid_v, hi_v, d]),
            np.stack([lo_u, mid_u, mid_v, hi_v, d + 1]),
            np.stack([mid_u, hi_u, lo_v, mid_v, d + 1])[:, ~same]], axis=1)
        grown = grown[:, (grown[0] < grown[1]) & (grown[2] < grown[3]) & (grown[4] <= max_bits)]
        for at in range(0, grown.shape[1], BLOCK):
            stack.append((bit + 1, grown[:, at:at + BLOCK]))
    settle()
    return label


def links_of(leaves: DataFrame, max_bits: int = MAX_BITS, most: int | None = None) -> DataFrame:
    """(a, b): links between fingerprints, per node pair a spanning forest of all its links.

    ``leaves``: fp (distinct)."""
    pairs = stored(node_pairs(leaves, max_bits, most), "trie-done")
    depths = [r.depth for r in pairs.select("depth").distinct().collect()]  # 16 at most
    sides = pairs.withColumn("p", F.explode(F.array_distinct(F.array("u", "v"))))
    keyed = leaves.select("fp", F.explode(F.array(*(
        F.struct(F.lit(d).alias("depth"), prefix(F.col("fp"), d).alias("p")) for d in depths))).alias("k"))
    rows = (keyed.select("fp", F.col("k.depth").alias("depth"), F.col("k.p").alias("p"))
            .join(sides, ["depth", "p"]).select("depth", "u", "v", "diff", "fp"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        depth, u, v, diff = map(int, key)
        fp = pdf["fp"].to_numpy().view(np.uint64)
        fp = np.sort(fp)
        shift = np.uint64(64 - depth) if depth else None
        top = fp >> shift if depth else np.zeros(len(fp), np.uint64)
        ranges = [tuple(np.searchsorted(top, np.uint64(x & (2**64 - 1)), s) for s in ("left", "right")) for x in (u, v)]
        label = join_subtrees(fp, *ranges, depth, diff, max_bits)
        at = np.flatnonzero(label != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[at].view(np.int64), "b": fp[label[at]].view(np.int64)})

    return rows.groupBy("depth", "u", "v", "diff").applyInPandas(run, "a long, b long")


def first_rows(prints: DataFrame, first: Column, max_bits: int, most: int | None) -> DataFrame:
    """(fp, component, first): every fingerprint's component (its smallest fingerprint), and the
    smallest ``first`` of all rows of ``prints`` in that component."""
    leaves = stored(prints.groupBy("fp").agg(F.min(first).alias("own")), "simhash-leaves")
    found = stored(connected_components(links_of(leaves, max_bits, most)), "simhash-components")
    least = (found.join(leaves, found["node"] == leaves["fp"]).groupBy("component").agg(F.min("own").alias("least")))
    linked = found.join(least, "component")
    return (leaves.join(linked, leaves["fp"] == linked["node"], "left")
            .select("fp", F.coalesce("component", "fp").alias("component"), F.coalesce("least", "own").alias("first")))


def simhash_components(docs: DataFrame, max_bits: int = MAX_BITS, most: int | None = None) -> DataFrame:
    """doc_id, fingerprint, component_id; one row per input row."""
    prints = stored(fingerprints(docs).select("doc", "fp"), "simhash-prints")
    classes = first_rows(prints, F.col("doc"), max_bits, most).select("fp", "first")
    null = lambda c: F.when(F.col(c) != LAST_DOC, F.col(c))
    return prints.join(classes, "fp").select(
        null("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        null("first").alias("component_id"))


def simhash_survivors(docs: DataFrame, max_bits: int = MAX_BITS, most: int | None = None) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their component, one of each component:
    of several with that id the one with the smallest key of its text."""
    prints = stored(fingerprints(docs), "simhash-prints")
    classes = first_rows(prints, F.struct("doc", "key"), max_bits, most)
    kept = stored(classes.select("component", "first.doc", "first.key").distinct()
                  .select("doc", "key"), "simhash-kept")
    own = docs.withColumns({"_doc": order_key("doc_id"), "_key": text_key("text")})
    same = lambda df, to: (df["_doc"] == to["doc"]) & (df["_key"] == to["key"])
    rows = own.join(kept, same(own, kept), "left_semi")
    # equal rows (id and text) are one document: one of them stays
    repeated = stored(prints.groupBy("doc", "key").agg(F.count("*").alias("n")).filter("n > 1").select("doc", "key"),
                      "simhash-repeated")
    if not repeated.isEmpty():
        once = rows.join(repeated, same(rows, repeated), "left_semi").dropDuplicates(["_doc", "_key"])
        rows = rows.join(repeated, same(rows, repeated), "left_anti").unionByName(once)
    return rows.drop("_doc", "_key")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
