"""Prefix trie of conversations from vertical bitmaps.

A shard is a run of consecutive conversations. Its index is vertical: for every position,
a posting for each distinct turn, a bitset of the shard's conversations that have the turn
there, and for every depth the bitset of conversations that end there. The trie is
walked depth-first: a node is the bitset of its members; the turn that its lowest member
still to place has next gives a posting, posting AND rest is a child, and is taken off the
rest. Popcounts are member counts, the node AND the ends of its depth gives its end list.

A node's key is a 128-bit digest chained over its turns, so the same prefix has the same key
in every shard. Local nodes are stored and added up by key, combined before the shuffle: a
first turn that a third of all conversations share is one row a shard. Sums over
subtrees need each node counted once although many shards hold it: it counts where its
smallest member is, and the sums of a shard are differences of running sums, because
its nodes are numbered depth-first and a subtree is one run of numbers. No step per
level is needed. Shards are runs of ascending ids, so end lists of a node, put one after the
other by shard, ascend too; they are hashed as a stream, without being gathered.

Sizes: conversations are dealt by ranges of ids; a task takes them as a stream and cuts
shards of at most ``SHARD_CONVS`` conversations and, but for one longer than that alone,
``SHARD_TURNS`` turns. Turns travel as digests, not as texts (a single conversation of
n turns needs about 200 n bytes in a task).

Defined results: rows without a conv_id take no part; null role or text is empty; turns are
ordered null first, equal turns by the digest of role and text, repeated rows
stay repeated turns; further columns are ignored; an empty table gives no rows, not even
a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import parts_for, stored, table

SHARD_CONVS = 4096
SHARD_TURNS = 1 << 16
PART_TURNS = 1 << 18   # turns of a range of ids, on average
ROOT = bytes(16)
FAMILY = 5             # a conversation takes its first turns from the one at the start of its family
MAX_HEAD = 8

NODES = ("key binary, parent binary, depth int, bytes long, shard long, first_member long, members long, "
         "number int, size int, ends string")


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits for a turn; the role's length keeps role and text apart."""
    head = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(head.cast("binary"), 256)), 1, 16)


def digested(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), digest, bytes of the text: one row per turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return turns.select("conv_id", F.row_number().over(order).alias("position"), "digest", "bytes")


class Shard:
    """The vertical index of some conversations, and their trie."""

    def __init__(self, ids: list[int], turns: list[list[tuple[bytes, int]]]):
        """``ids`` ascend; ``turns``: for each, its (digest, bytes) in order."""
        self.ids, self.turns = ids, turns
        self.postings: list[dict[bytes, int]] = []
        self.ended: dict[int, int] = {}
        for at, own in enumerate(turns):
            bit = 1 << at
            self.ended[len(own)] = self.ended.get(len(own), 0) | bit
            while len(self.postings) < len(own):
                self.postings.append({})
            for position, (digest, _) in enumerate(own):
                posting = self.postings[position]
                posting[digest] = posting.get(digest, 0) | bit

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low

    def nodes(self) -> list[list]:
        """Rows of :data:`NODES`, numbered depth-first."""
        rows: list[list] = []
        above: list[int] = []
        stack = [(ROOT, None, 0, 0, (1 << len(self.ids)) - 1, -1)]
        while stack:
            key, parent, depth, size, bits, upper = stack.pop()
            number = len(rows)
            first = (bits & -bits).bit_length() - 1
            ending = bits & self.ended.get(depth, 0)
            ends = ",".join(str(self.ids[m]) for m in self.members(ending))
            rows.append([key, parent, depth, size, self.ids[0], self.ids[first], bits.bit_count(), number, 1, ends or None])
            above.append(upper)
            rest = bits ^ ending
            while rest:
                digest, length = self.turns[(rest & -rest).bit_length() - 1][depth]
                child = rest & self.postings[depth][digest]
                stack.append((hashlib.blake2b(key + digest, digest_size=16).digest(), key, depth + 1, length, child, number))
                rest ^= child
        for number in range(len(rows) - 1, 0, -1):
            rows[above[number]][8] += rows[number][8]
        return rows


def local_nodes(turns: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS,
                part_turns: int = PART_TURNS) -> DataFrame:
    """The nodes of every shard. ``turns``: conv_id, position, digest, bytes; a conversation
    without turns has one row with a null position."""
    kinds = [("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("bytes", pa.int64()), ("shard", pa.int64()),
             ("first_member", pa.int64()), ("members", pa.int64()), ("number", pa.int32()), ("size", pa.int32()), ("ends", pa.string())]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        own: list[list[tuple[bytes, int]]] = []
        held = 0

        def made() -> Iterator[pa.RecordBatch]:
            rows = Shard(ids, own).nodes() if ids else []
            for at in range(0, len(rows), 10_000):
                part = zip(*rows[at:at + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(part, kinds)], [n for n, _ in kinds])

        for batch in batches:
            for conv, position, digest, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not ids or ids[-1] != conv:
                    if len(ids) == shard_convs or held >= shard_turns:
                        yield from made()
                        ids, own, held = [], [], 0
                    ids.append(conv)
                    own.append([])
                if position is not None:
                    own[-1].append((digest, size))
                    held += 1
        yield from made()

    parts = parts_for(turns.count(), part_turns)
    ranged = turns.select("conv_id", "position", "digest", "bytes").repartitionByRange(parts, "conv_id")
    return ranged.sortWithinPartitions("conv_id", "position").mapInArrow(walk, NODES)


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """key, n_leaves, saved_tokens of one shard's part of each subtree.

    ``nodes``: the shard's nodes with ``owned`` (the node's smallest member is here) and
    ``leaf`` (no shard has a child of it)."""
    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("number")
        start = np.arange(len(pdf))
        end = start + pdf["size"].to_numpy()
        owned = pdf["owned"].to_numpy(bool)
        leaves = np.concatenate([[0], np.cumsum((owned & pdf["leaf"].to_numpy(bool)).astype(np.int64))])
        saved = np.concatenate([[0], np.cumsum((pdf["members"].to_numpy() - owned) * pdf["bytes"].to_numpy())])
        return pd.DataFrame({"key": pdf["key"], "n_leaves": leaves[end] - leaves[start], "saved_tokens": saved[end] - saved[start]})

    return nodes.groupBy("shard").applyInPandas(sums, "key binary, n_leaves long, saved_tokens long")


def end_digests(nodes: DataFrame) -> DataFrame:
    """key, ends_sha256: SHA-256 of each node's end lists joined by commas in the order of shards.

    A node's lists pass through its task one after the other; only the hash state stays."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, digests = [], []
            for k, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if state is not None:
                        keys.append(key)
                        digests.append(state.hexdigest())
                    key, state = k, hashlib.sha256()
                state.update(ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    lists = nodes.filter(F.col("ends").isNotNull()).select("key", "shard", "ends")
    return lists.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(stream, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, **sizes: int) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (as :func:`local_nodes` takes them):
    key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    local = stored(local_nodes(turns, **sizes), "trie-local")
    nodes = stored(local.groupBy("key").agg(F.first("parent").alias("parent"), F.first("depth").cast("long").alias("depth"),
                                            F.min("first_member").alias("conv_id"), F.sum("members").alias("n_convs")), "trie-nodes")
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    known = stored(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "trie-children")
    flags = known.select("key", "conv_id", (F.col("n_children") == 0).alias("leaf"))
    marked = (local.select("key", "shard", "number", "size", "members", "bytes", "first_member").join(flags, "key")
              .withColumn("owned", F.col("first_member") == F.col("conv_id")).drop("first_member", "conv_id"))
    parts = subtree_sums(marked).withColumn("ends_sha256", F.lit(None).cast("string")).unionByName(
        end_digests(local).withColumns({"n_leaves": F.lit(0).cast("long"), "saved_tokens": F.lit(0).cast("long")}))
    sums = parts.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
                                    F.coalesce(F.max("ends_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (known.join(sums, "key").join(parents, "parent", "left")
            .select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of c - c % 5 and its own after its first h, h = crc32(c) % 9.

    ``turns``: conv_id, position, digest, bytes. Only the first eight turns of a family's
    first conversation travel to the others."""
    each = turns.filter("position = 1").select("conv_id")
    head = (turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("position") <= MAX_HEAD)).groupBy(F.col("conv_id").alias("base"))
            .agg(F.sort_array(F.collect_list(F.struct("position", "digest", "bytes"))).alias("head")))  # eight at most
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MAX_HEAD + 1)).cast("int")
    none = F.array().cast("array<struct<position:int,digest:binary,bytes:bigint>>")
    led = (each.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(head, "base", "left")
           .select("conv_id", F.slice(F.coalesce("head", none), F.lit(1), h).alias("head")))
    taken = led.select("conv_id", F.explode_outer("head").alias("t")).select("conv_id", "t.position", "t.digest", "t.bytes")
    own = (turns.withColumn("h", h).filter(F.col("position") > F.col("h"))
           .join(led.select("conv_id", F.size("head").alias("n")), "conv_id")
           .select("conv_id", (F.col("n") + F.col("position") - F.col("h")).alias("position"), "digest", "bytes"))
    return taken.unionByName(own)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(digested(table(spark, sf_dir, "conversations")), "trie-turns")
    return prefix_trie(stored(rebuilt(turns), "trie-rebuilt")).drop("key")


ORACLE = f"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
d AS (SELECT conv_id, turn, strlen(text) AS bytes, substr(sha256(strlen(role) || ':' || role || text), 1, 32) AS digest FROM t),
p AS (SELECT conv_id, digest, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS position FROM d),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM p),
crc AS (SELECT conv_id, s, 0 AS bit, 4294967295::BIGINT AS c FROM ids
        UNION ALL
        SELECT conv_id, s, bit + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
        FROM (SELECT *, CASE WHEN bit % 8 = 0 THEN xor(c, ascii(s[bit // 8 + 1])::BIGINT) ELSE c END AS x FROM crc WHERE bit < 8 * length(s))),
h AS (SELECT conv_id, xor(c, 4294967295) % {MAX_HEAD + 1} AS h FROM crc WHERE bit = 8 * length(s)),
head AS (SELECT h.conv_id, p.position, p.digest, p.bytes FROM h JOIN p ON p.conv_id = h.conv_id - h.conv_id % {FAMILY} AND p.position <= h.h),
n AS (SELECT h.conv_id, h, count(head.position) AS n FROM h LEFT JOIN head USING (conv_id) GROUP BY ALL),
r AS (SELECT * FROM head UNION ALL
      SELECT p.conv_id, n + position - h, digest, bytes FROM p JOIN n USING (conv_id) WHERE position > h),
path AS (SELECT conv_id, 0::BIGINT AS depth, '' AS path, NULL::VARCHAR AS parent, 0::BIGINT AS bytes FROM h UNION ALL
         SELECT conv_id, position, string_agg(digest, '') OVER w, coalesce(string_agg(digest, '') OVER v, ''), bytes FROM r
         WINDOW w AS (PARTITION BY conv_id ORDER BY position),
                v AS (PARTITION BY conv_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
node AS (SELECT path, any_value(depth) AS depth, any_value(parent) AS parent, any_value(bytes) AS bytes,
                min(conv_id) AS conv_id, count(*) AS n_convs FROM path GROUP BY path),
kids AS (SELECT parent AS path, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
         FROM (SELECT conv_id, arg_max(path, depth) AS path FROM path GROUP BY conv_id) GROUP BY path),
step AS (SELECT a.path AS top, b.path AS path FROM node a JOIN node b ON starts_with(b.path, a.path)),
sums AS (SELECT top AS path, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
         FROM step JOIN node USING (path) LEFT JOIN kids USING (path) GROUP BY top)
SELECT node.conv_id, node.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM node LEFT JOIN node up ON up.path = node.parent LEFT JOIN kids ON kids.path = node.path
     LEFT JOIN ends ON ends.path = node.path JOIN sums ON sums.path = node.path
"""
