"""Exact substring dedup by a distributed merge sort of suffixes.

A byte goes if it lies in a ``LENGTH``-byte string that also starts earlier (smaller
doc_id, or earlier in the document). Sorting every suffix of a large corpus would move each
byte a hundred times, so the suffixes that can match are found first, without loss:

1. Anchors. Of the ``LENGTH - GRAM + 1`` grams of a ``LENGTH``-byte string the one with the
   smallest hash is its anchor; equal strings have equal anchors at equal offsets. An anchor
   knows its context, all bytes that strings through it can touch: up to ``REACH`` before it
   and ``LENGTH`` from it on. Anchors with equal contexts are folded to the earliest, first
   within a batch of documents, then in the gram's bucket: the later ones are repeats over
   their whole context. A gram left with one context is done.
2. Only the other grams' first anchors become suffixes. Each task sorts its suffixes and
   sends, per part, one run: front-coded, every suffix as the length of the prefix it shares
   with the one before it and its remaining bytes.
3. A part merges its runs with a loser tree whose entries know how many bytes they share with
   the last output: unequal shares decide a comparison, equal ones let it start behind the
   shared bytes, so no known prefix is compared again. The merge yields the part's suffix
   array and its common-prefix lengths, from which follows, for every anchor and every offset
   of a string before it, whether an earlier one has the same bytes.

A passage that a third of all documents hold between the same neighbours is one anchor per
batch, not one per document. A gram between ever different neighbours (a licence line, say) is
not split: its anchors lie in one bucket and their suffixes in one part. Texts move once, to
the anchors' positions; those that have repeats are stored there, and the resulting spans
come to them.

Buckets and parts: as many as the session has shuffle partitions. Context equality in step
1 is that of 64-bit hashes within an equal gram hash; step 3 compares bytes.

Defined results: null text is empty; texts shorter than ``LENGTH`` lose nothing; null doc_ids
come after all others; rows that share a doc_id (or have none) are judged each by its own text,
in the order of the texts' SHA-256, and equal rows are one document; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import order_key, stored, stored_by, table

LENGTH = 100
GRAM = 30
REACH = LENGTH - GRAM       # bytes before an anchor that a string through it can have
PIECE = 1 << 20             # bytes hashed at once
RUN = 100_000               # suffixes sorted at once
BASE = 0xD6E8FEB86659FD93   # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        out[have:2 * have] = out[:min(have, n - have)] * np.uint64(pow(base, have, 2**64))
        have *= 2
    return out


_SIZE = PIECE + 2 * LENGTH + REACH
_UP, _DOWN = _powers(BASE, _SIZE), _powers(INVERSE, _SIZE + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def anchors(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of all anchors of the texts that lie in ``buf`` one after the other, hashes of
    their grams and of their contexts."""
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(buf), PIECE):
        low = max(0, begin - REACH)
        sub = buf[low:begin + PIECE + 2 * LENGTH]
        n = len(sub) - GRAM + 1
        if n <= 0:
            continue
        total = np.zeros(len(sub) + 1, np.uint64)
        np.cumsum((sub.astype(np.uint64) + np.uint64(1)) * _UP[:len(sub)], out=total[1:])
        gram = _mix((total[GRAM:] - total[:n]) * _DOWN[:n])
        bits = np.uint64(22)  # a piece has fewer positions; among equal grams the last one counts
        key = (gram >> bits << bits) | (np.uint64((1 << 22) - 1) - np.arange(n, dtype=np.uint64))
        width, least = 1, key
        while 2 * width <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = REACH + 1 - width
        least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
        valid = np.zeros(len(least), bool)
        first = np.searchsorted(ends, begin, "right")
        for s, e in zip(starts[first:], ends[first:]):
            if s >= begin + PIECE:
                break
            valid[max(s, begin) - low:max(0, min(e - LENGTH + 1, begin + PIECE) - low)] = True
        least = least[valid]
        if not len(least):
            continue
        at = np.unique((np.uint64((1 << 22) - 1) - (least & np.uint64((1 << 22) - 1))).astype(np.int64))
        doc = np.searchsorted(ends, at + low, "right")
        left = np.minimum(REACH, at + low - starts[doc])
        right = np.minimum(LENGTH, ends[doc] - at - low)
        context = _mix((total[at + right] - total[at - left]) * _DOWN[at - left]
                       + (left * 256 + right).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        found.append((at + low, gram[at], context))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at, gram, context = map(np.concatenate, zip(*found))
    at, one = np.unique(at, return_index=True)
    return at, gram[one], context[one]


def fold(gram: np.ndarray, context: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the earliest anchor of every (gram, context), sorted by them, and of the later ones."""
    order = np.lexsort((pos, doc, context, gram))
    g, c, d, p = gram[order], context[order], doc[order], pos[order]
    new = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])] if len(order) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = (d != d[first]) | (p != p[first])  # rows that repeat are the same place
    return order[new], order[later]


def _by_doc(doc: np.ndarray, pos: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order].astype(np.int32)
    cuts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, int)
    for a, b in zip(cuts, [*cuts[1:], len(doc)]):
        yield int(doc[a]), pos[a:b].tobytes()


ANCHORS = "bucket int, doc long, gram binary, context binary, docs binary, positions binary"


def anchor_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """Per batch and bucket one row of anchors (``doc`` is the least id, ``docs`` the distances
    from it), and rows (doc, positions) of anchors that are later than an equal one of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = sorted(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), key=lambda r: r[0])
            ids = np.array([d for d, _ in rows], np.int64)
            raw = [(t or "").encode("utf-8", "surrogatepass") for _, t in rows]
            ends = np.cumsum([len(r) for r in raw]) if raw else np.zeros(0, np.int64)
            starts = ends - np.array([len(r) for r in raw], np.int64)
            at, gram, context = anchors(np.frombuffer(b"".join(raw), np.uint8), starts, ends)
            of = np.searchsorted(ends, at, "right")
            doc, pos = ids[of], at - starts[of]
            kept, later = fold(gram, context, doc, pos)
            out = [(int(zlib.crc32(str(d).encode()) % buckets), d, None, None, None, p)
                   for d, p in _by_doc(doc[later], pos[later])]
            kept = kept[np.argsort(kept)]
            bucket = (gram[kept] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            kept, bucket = kept[order], bucket[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(kept) else []
            for a, e in zip(cuts, [*cuts[1:], len(kept)]):
                k = kept[a:e]
                far = doc[k] - doc[k].min()
                far = far.astype(np.uint32) if far.max() < 2**32 else far.view(np.uint64)
                out.append((int(bucket[a]), int(doc[k].min()),
                            ((gram[k] // np.uint64(buckets)) & np.uint64(2**32 - 1)).astype(np.uint32).tobytes(),
                            context[k].tobytes(), far.tobytes(), pos[k].astype(np.uint32).tobytes()))
            yield _batch(out, ANCHORS)

    return docs.mapInArrow(run, ANCHORS)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


PLACES = "doc long, repeats binary, open binary"


def places(rows: DataFrame) -> DataFrame:
    """(doc, repeats, open): positions of anchors whose whole context is a repeat, and of anchors
    whose suffixes must be compared. A bucket holds at most one anchor per batch and context."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        done = pdf[pdf["gram"].isna()]
        out = [(d, p, None) for d, p in zip(done["doc"], done["positions"])]
        runs = pdf[pdf["gram"].notna()]
        if len(runs):
            join = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in runs[c]])
            gram, context, pos = join("gram", np.uint32), join("context", np.uint64), join("positions", np.uint32)
            doc = np.concatenate([
                least + np.frombuffer(x, np.uint32 if len(x) == len(p) else np.uint64).astype(np.int64)
                for least, x, p in zip(runs["doc"], runs["docs"], runs["positions"])])
            first, later = fold(gram, context, doc, pos)
            out += [(d, p, None) for d, p in _by_doc(doc[later], pos[later])]
            g = gram[first]  # sorted
            several = np.r_[g[1:] == g[:-1], False] | np.r_[False, g[1:] == g[:-1]] if len(g) else np.zeros(0, bool)
            first = first[several]
            out += [(d, None, p) for d, p in _by_doc(doc[first], pos[first])]
        return pd.DataFrame(out, columns=["doc", "repeats", "open"])

    return rows.groupBy("bucket").applyInPandas(run, PLACES)


def common(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row (zero-padded) shares with the one before it."""
    if not len(rows):
        return np.zeros(0, np.int64)
    differ = rows[1:] != rows[:-1]
    n = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.r_[0, np.minimum(n, np.minimum(sizes[1:], sizes[:-1]))]


def padded(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width), sizes


RUNS = "part int, n int, shared binary, size binary, before binary, docs binary, positions binary, suffixes binary, lefts binary"


def front_coded(part: int, entries: list[tuple[bytes, bytes, int, int]]) -> tuple:
    """A sorted run as a row: (suffix, bytes before it reversed, doc, pos) each."""
    entries.sort()
    shared = common(*padded([e[0] for e in entries], LENGTH))
    array = lambda x, kind: np.array(x, kind).tobytes()
    return (part, len(entries), array(shared, np.uint8), array([len(e[0]) for e in entries], np.uint8),
            array([len(e[1]) for e in entries], np.uint8), array([e[2] for e in entries], np.int64),
            array([e[3] for e in entries], np.uint32), b"".join(e[0][k:] for e, k in zip(entries, shared.tolist())),
            b"".join(e[1] for e in entries))


def suffix_runs(affected: DataFrame, parts: int) -> DataFrame:
    """Sorted, front-coded runs of the open anchors' suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal n
            out = _batch([front_coded(part, held[part]) for part in sorted(held)], RUNS)
            held.clear()
            n = 0
            return out

        for b in batches:
            for doc, text, found in zip(*(b.column(i) for i in range(3))):
                at = np.unique(np.frombuffer(b"".join(found.as_py()), np.int32)).tolist()
                raw = text.as_py().encode("utf-8", "surrogatepass") if at else b""
                for p in at:
                    suffix = raw[p:p + LENGTH]
                    held.setdefault(zlib.crc32(suffix[:GRAM]) % parts, []).append(
                        (suffix, raw[max(0, p - REACH):p][::-1], doc.as_py(), p))
                n += len(at)
                if n >= RUN:
                    yield flush()
        if held:
            yield flush()

    return affected.select("doc", "text", "open").mapInArrow(run, RUNS)


class Run:
    """A front-coded run, read one suffix at a time."""

    def __init__(self, shared: bytes, size: bytes, suffixes: bytes):
        self.shared, self.size, self.suffixes = shared, size, suffixes
        self.i, self.at, self.now = -1, 0, b""

    def advance(self) -> int:
        """Step on; returns how much the new suffix shares with the last, -1 at the end."""
        self.i += 1
        if self.i >= len(self.size):
            self.now = None
            return -1
        k = self.shared[self.i]
        more = self.size[self.i] - k
        self.now = self.now[:k] + self.suffixes[self.at:self.at + more]
        self.at += more
        return k


def shared_from(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``known`` bytes are known."""
    most = min(len(a), len(b))
    low, step = known, 8
    while low < most:  # in steps that double, then by halves
        if a[low:low + step] == b[low:low + step]:
            low = min(most, low + step)
            step *= 2
            continue
        high = min(most, low + step)
        while low < high:
            mid = (low + high + 1) // 2
            if a[low:mid] == b[low:mid]:
                low = mid
            else:
                high = mid - 1
        return low
    return most


class LoserTree:
    """Merges runs; entries carry the length they share with the last output."""

    def __init__(self, runs: list[Run]):
        self.runs = runs
        self.k = len(runs)
        self.share = [0] * self.k
        for r in runs:
            r.advance()
        self.losers = [-1] * self.k
        self.winner = self._play(1)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win = self._less(a, b)
        self.losers[node] = b if win == a else a
        return win

    def _less(self, a: int, b: int) -> int:
        """The run whose suffix comes first; the other's share becomes that with the winner's."""
        x, y = self.runs[a].now, self.runs[b].now
        if x is None or y is None:
            return b if x is None else a
        share = self.share
        if share[a] != share[b]:  # both against the same last output: the longer share is smaller
            return a if share[a] > share[b] else b
        n = shared_from(x, y, share[a])
        if len(x) == n or (len(y) > n and x[n] < y[n]):
            share[b] = n
            return a
        share[a] = n
        return b

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, index in it, bytes shared with the output before)."""
        while self.runs[self.winner].now is not None:
            w = self.winner
            yield w, self.runs[w].i, self.share[w]
            self.share[w] = self.runs[w].advance()
            node = (w + self.k) // 2
            while node:
                if self._less(w, self.losers[node]) != w:
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


SPANS = "doc long, low int, high int"


def repeated_spans(shared: np.ndarray, size: np.ndarray, lefts: list[bytes], doc: np.ndarray, pos: np.ndarray) -> pd.DataFrame:
    """The repeated bytes around anchors, given in suffix order with the lengths shared with the
    suffix before. A string that begins ``k`` bytes before an anchor repeats if an earlier anchor
    shares LENGTH - k bytes from the anchor on and k bytes before it."""
    n = len(size)
    by_left = sorted(range(n), key=lefts.__getitem__)
    matrix, left_size = padded([lefts[i] for i in by_left], REACH)
    left_shared = common(matrix, left_size)
    by_left = np.array(by_left, np.int64)
    before = np.empty(n, np.int64)
    before[by_left] = left_size
    age = np.lexsort((pos, doc))  # earlier first
    least = np.full(n, LENGTH)
    most = np.full(n, -1)
    for k in range(REACH + 1):
        right_class = np.cumsum(shared < LENGTH - k)
        left_class = np.empty(n, np.int64)
        left_class[by_left] = np.cumsum(left_shared < k)
        fits = age[(size[age] >= LENGTH - k) & (before[age] >= k)]
        key = right_class[fits] * (n + 1) + left_class[fits]
        _, first = np.unique(key, return_index=True)
        again = np.ones(len(fits), bool)
        again[first] = False
        again = fits[again]
        least[again] = np.minimum(least[again], k)
        most[again] = k
    hit = np.flatnonzero(most >= 0)
    return pd.DataFrame({"doc": doc[hit], "low": (pos[hit] - most[hit]).astype(np.int32),
                         "high": (pos[hit] - least[hit] + LENGTH).astype(np.int32)})


def merged_spans(runs: DataFrame) -> DataFrame:
    """(doc, low, high): spans that the parts' merged suffixes show to be repeats."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        order = list(LoserTree([Run(*r) for r in zip(pdf["shared"], pdf["size"], pdf["suffixes"])]))
        starts = np.cumsum([0, *pdf["n"]])
        at = np.array([starts[r] + i for r, i, _ in order], np.int64)
        column = lambda c, kind: np.concatenate([np.frombuffer(x, kind) for x in pdf[c]])[at]
        lefts = []
        for sizes, raw in zip(pdf["before"], pdf["lefts"]):
            ends = np.cumsum(np.frombuffer(sizes, np.uint8).astype(np.int64)).tolist()
            lefts += [raw[a:b] for a, b in zip([0, *ends], ends)]
        return repeated_spans(np.array([s for _, _, s in order]), column("size", np.uint8).astype(np.int64),
                              [lefts[i] for i in at], column("docs", np.int64),
                              column("positions", np.uint32).astype(np.int64))

    return runs.groupBy("part").applyInPandas(run, SPANS)


def removed(n: int, repeats: list[bytes], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal removed spans of a text of ``n`` bytes."""
    at = np.frombuffer(b"".join(repeats), np.int32).astype(np.int64)
    left, right = np.minimum(REACH, at), np.minimum(LENGTH, n - at)
    whole = left + right >= LENGTH
    low = np.r_[(at - left)[whole], np.array([a for a, _ in spans], np.int64)]
    high = np.r_[(at + right)[whole], np.array([b for _, b in spans], np.int64)]
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.minimum(np.maximum.accumulate(high[order]), n) if len(low) else high
    if not len(low):
        return []
    new = np.r_[True, low[1:] > high[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(low) - 1]
    return [(a, b) for a, b in zip(low[new].tolist(), high[last].tolist()) if a < b]


RESULT = "doc long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<low: int, high: int>>"


def judged(docs: DataFrame) -> DataFrame:
    """``RESULT`` for the documents that lose bytes. ``docs``: doc (not null, unique), text."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = places(anchor_rows(docs, n)).groupBy("doc").agg(
        F.collect_list("repeats").alias("repeats"), F.collect_list("open").alias("open"))
    # the texts lie in buckets by doc, so that the spans come to them
    with stored_by(docs.join(found.hint("merge"), "doc"), "suffix-affected", "doc", n) as affected:
        spans = merged_spans(suffix_runs(affected.filter(F.size("open") > 0), n)).groupBy("doc").agg(
            F.collect_list(F.struct("low", "high")).alias("spans"))
        met = affected.join(spans, "doc", "left").select("doc", "text", "repeats", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, repeats, spans in zip(*(b.column(i).to_pylist() for i in range(4))):
                raw = (text or "").encode("utf-8", "surrogatepass")
                gone = removed(len(raw), repeats, [(s["low"], s["high"]) for s in spans or ()])
                kept, at = hashlib.sha256(), 0
                for a, e in gone:
                    kept.update(raw[at:a])
                    at = e
                kept.update(raw[at:])
                rows.append((doc, sum(e - a for a, e in gone), len(gone), kept.hexdigest(),
                             [{"low": a, "high": e} for a, e in gone]))
            doc, cut, count, sha, where = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(cut, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(where, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))],
                ["doc", "n_removed", "n_spans", "kept_sha256", "spans"])

    return met.mapInArrow(run, RESULT)


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, doc, text: ``doc`` orders the documents and is shared by equal rows only.

    It is the id itself where every id names one text. Otherwise the different (id, text) are
    numbered in their order: null ids last, texts of one id by their SHA-256."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_key("doc_id").alias("doc"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if keyed.select("doc").groupBy("doc").count().filter("count > 1").isEmpty():  # reads ids only
        return keyed
    named = keyed.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    order = named.select("doc", "sha").distinct().repartitionByRange("doc", "sha").sortWithinPartitions("doc", "sha")
    order = stored(order.withColumn("place", F.monotonically_increasing_id()), "suffix-order")
    return stored(named.join(order, ["doc", "sha"]).select("doc_id", F.col("place").alias("doc"), "text"), "suffix-placed")


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans; one row per input row."""
    keyed = placed(docs)
    texts = keyed.select("doc", "text")
    again = texts.groupBy("doc").count().filter("count > 1").select("doc")
    if not again.isEmpty():  # equal rows are one document
        again = stored(again, "suffix-again")
        texts = texts.join(again, "doc", "left_anti").unionByName(
            texts.join(again, "doc", "left_semi").groupBy("doc").agg(F.min("text").alias("text")))
    found = judged(texts)
    base = keyed.select("doc_id", "doc", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    return base.join(found, "doc", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<struct<low:int,high:int>>")).alias("spans"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
