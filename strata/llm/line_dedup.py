"""Incremental line dedup: exact reference counts with sharded cuckoo filters before them.

State of a :class:`LineIndex`, three tables in the shared folder, all sharded by line key:

* ``refs``: one row per (line key, document) — the exact references;
* ``counts``: per line key the number of documents and the smallest doc_id, the owner;
* ``filters``: per shard one cuckoo filter of the keys that several documents share.

``insert`` adds documents, ``delete`` takes documents out again. Only the keys that a batch
touches are recounted, and only their filters change; a key whose count falls back to one leaves
the filter, so deleting restores what was before. Each change stores the three tables anew (the
old ones stay readable), so it costs a pass over the index, though none over the texts. ``repeated`` asks which references are repeats: a reference whose
key misses its shard's filter is surely no repeat and is done; the others are verified
against the exact counts, so a filter's false positives never reach a result.

Shape at scale: a reference is 36 bytes however long the line is; counts are combined on the
map side, so a line that a third of all documents hold is one row per map task; filters are
probed per (shard, salt) group of bounded size — a shard that a hot line makes large is
salted by document, its small filter repeated. Texts move once, to meet their verdicts.

Defined results: null or empty text is one empty line; a null doc_id is one document that
comes after all others; rows that repeat a doc_id are the same document; an empty table gives
no rows; input columns beyond doc_id and text are kept by ``without_repeated_lines`` and
ignored otherwise, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import order_key, parts_for, sliced, stored, table
from strata.llm.cuckoo import CuckooFilter

MIN_KEY = 10              # code points
REFS_PER_GROUP = 500_000  # references that one probe group holds on average
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def key_hash(line: str) -> bytes | None:
    """The stored form of a line's key, None where the key is too short to count."""
    key = line.strip(BLANK).translate(str.maketrans(UPPER, LOWER))
    return hashlib.md5(key.encode("utf-8", "surrogatepass")).digest() if len(key) >= MIN_KEY else None


def references(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, key, doc): one row per line key and document."""
    lines = docs.select(order_key("doc_id").alias("doc"),
                        F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\n", -1))).alias("line"))
    return (lines.select("doc", line_key(F.col("line")).alias("k")).filter(F.char_length("k") >= MIN_KEY)
            .select(F.unhex(F.md5(F.col("k").cast("binary"))).alias("key"), "doc").distinct()
            .select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "doc"))


def low64(keys: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in keys), np.uint64) if len(keys) else np.zeros(0, np.uint64)


class LineIndex:
    """See the module's docstring. Instances are immutable: each change returns a new one."""

    def __init__(self, refs: DataFrame, counts: DataFrame, filters: DataFrame, shards: int):
        self.refs, self.counts, self.filters, self.shards = refs, counts, filters, shards

    @classmethod
    def build(cls, docs: DataFrame, shards: int | None = None) -> "LineIndex":
        """An index of ``docs``; ``shards``: by default as many as the session has shuffle partitions."""
        shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        refs = stored(references(docs, shards), "line-refs")
        counts = stored(cls._counted(refs), "line-counts")
        return cls(refs, counts, stored(cls._filtered(counts), "line-filters"), shards)

    @staticmethod
    def _counted(refs: DataFrame) -> DataFrame:
        return refs.groupBy("shard", "key").agg(F.count("*").alias("n_docs"), F.min("doc").alias("owner"))

    @staticmethod
    def _filtered(counts: DataFrame) -> DataFrame:
        """Per shard the filter of the keys with several documents. A shard has distinct keys
        only, about all keys / shards of them, 8 bytes each here."""

        def fill(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "filter": [CuckooFilter.of(low64(pdf["key"])).to_bytes()]})

        return (counts.filter("n_docs > 1").select("shard", F.substring("key", 1, 8).alias("key"))
                .groupBy("shard").applyInPandas(fill, "shard int, filter binary"))

    def insert(self, docs: DataFrame) -> "LineIndex":
        """The index with ``docs`` added (documents it has already gain their new lines)."""
        fresh = references(docs, self.shards).join(self.refs, ["shard", "key", "doc"], "left_anti")
        return self._changed(stored(fresh, "line-new"), self.refs, add=True)

    def delete(self, doc_ids: DataFrame) -> "LineIndex":
        """The index without the documents whose doc_id is in ``doc_ids``."""
        gone = doc_ids.select(order_key("doc_id").alias("doc")).distinct()
        leaving = stored(self.refs.join(gone, "doc", "left_semi").select("shard", "key", "doc"), "line-gone")
        return self._changed(leaving, self.refs.join(gone, "doc", "left_anti").select("shard", "key", "doc"), add=False)

    def _changed(self, batch: DataFrame, others: DataFrame, add: bool) -> "LineIndex":
        """Recount the keys of ``batch`` and move those that become or cease to be shared
        into or out of their shard's filter."""
        refs = stored(others.unionByName(batch) if add else others, "line-refs")
        keys = batch.select("shard", "key").distinct()
        recounted = self._counted(refs.join(keys, ["shard", "key"], "left_semi"))
        counts = stored(self.counts.join(keys, ["shard", "key"], "left_anti").unionByName(recounted), "line-counts")
        was = self.counts.filter("n_docs > 1").select("shard", "key").join(keys, ["shard", "key"], "left_semi")
        now = counts.filter("n_docs > 1").select("shard", "key").join(keys, ["shard", "key"], "left_semi")
        moved = (now.join(was, ["shard", "key"], "left_anti").withColumn("enters", F.lit(True))
                 .unionByName(was.join(now, ["shard", "key"], "left_anti").withColumn("enters", F.lit(False))))

        def move(shard: tuple, have: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            enters = keys["enters"].astype(bool)
            if not len(have):
                made = CuckooFilter.of(low64(keys["key"][enters]))
            else:
                made = CuckooFilter.from_bytes(have["filter"].iloc[0])
                made.delete(low64(keys["key"][~enters]))
                if not made.insert(low64(keys["key"][enters])):
                    return pd.DataFrame({"shard": [shard[0]], "filter": [None]})  # full: refilled below
            return pd.DataFrame({"shard": [shard[0]], "filter": [made.to_bytes()]})

        filters = stored(self.filters.groupBy("shard").cogroup(moved.groupBy("shard"))
                         .applyInPandas(move, "shard int, filter binary"), "line-filters")
        full = filters.filter("filter IS NULL").select("shard")
        refilled = self._filtered(counts.join(F.broadcast(full), "shard", "left_semi"))  # at most one row a shard
        filters = stored(filters.filter("filter IS NOT NULL").unionByName(refilled), "line-filters")
        return LineIndex(refs, counts, filters, self.shards)

    def repeated(self) -> DataFrame:
        """(key, doc): the references whose line stands in a document with a smaller id."""
        sizes = self.counts.groupBy("shard").agg(F.sum("n_docs").alias("n"))  # one row a shard
        salts = F.ceil(F.col("n") / REFS_PER_GROUP).cast("int")
        of_shard = self.filters.join(sizes, "shard").select("shard", "filter", salts.alias("salts"))
        filters = of_shard.select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "filter")
        refs = (self.refs.join(F.broadcast(of_shard.select("shard", "salts")), "shard")  # one int a shard
                .withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int"))
                .select("shard", "salt", "key", "doc"))

        def probe(refs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(refs) or not len(held):
                return refs[["key", "doc"]].iloc[:0]
            return refs[["key", "doc"]][CuckooFilter.from_bytes(held["filter"].iloc[0]).contains(low64(refs["key"]))]

        maybe = (refs.groupBy("shard", "salt").cogroup(filters.groupBy("shard", "salt"))
                 .applyInPandas(probe, "key binary, doc long"))
        exact = self.counts.filter("n_docs > 1").select("key", "owner")
        return maybe.join(exact, "key").filter("doc <> owner").select("key", "doc")


def kept_lines(text: str | None, repeats: set[bytes]) -> tuple[str, int, int]:
    """The text without its repeated lines, the number of lines, the number dropped."""
    lines = (text or "").split("\n")
    kept = [x for x in lines if key_hash(x) not in repeats] if repeats else lines
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def verdicts(docs: DataFrame, index: LineIndex) -> DataFrame:
    """``docs`` with ``_repeats``: the keys that the row's document loses (null: none)."""
    lost = (index.repeated().groupBy("doc").agg(F.collect_set("key").alias("_repeats"))  # at most its own lines
            .withColumnRenamed("doc", "_doc"))
    return docs.join(lost, order_key("doc_id") == F.col("_doc"), "left").drop("_doc")


def deduped(docs: DataFrame, index: LineIndex) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256; one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            found = [kept_lines(t, set(r or ())) for t, r in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for _, n, _ in found], pa.int64()),
                 pa.array([d for *_, d in found], pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t, *_ in found], pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return verdicts(picked, index).select("doc_id", "text", "_repeats").mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns; texts without the lines that a smaller doc_id holds. A text that
    loses no line is returned as it is, null included."""
    judged = verdicts(docs, LineIndex.build(docs))
    at, repeats = docs.columns.index("text"), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = [kept_lines(t, set(r))[0] if r else t
                     for t, r in zip(b.column(at).to_pylist(), b.column(repeats).to_pylist())]
            columns = [b.column(i) for i in range(repeats)]
            columns[at] = pa.array(texts, b.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    docs_columns = docs.columns
    return judged.mapInArrow(run, docs.schema)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return deduped(docs, LineIndex.build(docs))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, u.line, u.pos FROM docs, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, pos)),
keyed AS (SELECT doc_id, pos, line,
                 translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
owners AS (SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT l.doc_id, l.pos, l.line, coalesce(o.owner <> l.doc_id, false) AS gone
           FROM keyed l LEFT JOIN owners o ON l.k = o.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
