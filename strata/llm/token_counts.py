"""Token counts by prefix dynamic programming, stored once and asked again.

A text is cut where a non-space is followed by a space: no token crosses such
a place, and what stands on one side never changes the other. For each piece of a chunk the
prefix table (``bpe.Bpe.last_sizes``, ``bpe.Bpe.prefixes``) has the exact token count at every byte and where
the last token of every prefix starts; the path back through it gives the sizes of the piece's tokens.

:func:`prefix_table` stores the sizes of all tokens of a document, one byte each. Their running
sums are the byte offsets at which the count goes up, so the stored rows answer how many tokens
a text or any part of it up to a byte has, where a token limit cuts it (:func:`truncated`,
:func:`tokens_within`), and which documents fit a token budget (:func:`within_budget`) without the
vocabulary and without encoding anything again. (The count of a prefix that ends inside a
token, taken as a text of its own, is not a part of that; :meth:`Counter.prefix_counts` has it.)

The rows stay where they are read: one Arrow pass over the documents, no
shuffle, per-worker chunk tables of bounded size. Only the budget moves rows, and of
those only ids and counts.

Defined results: null or empty text has 0 tokens; rows are never merged, so
repeated rows and null ids come back once per input row; further columns of
the input are ignored, whatever their names; an empty table gives no rows. In a budget, documents
come by id, null last, rows of one id by their number of tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe import byte_level
from strata.llm.common import order_key, sliced, stored, table

LIMIT = 512
VOCABULARY = "byte_bpe_50k.json"
CACHE_ENTRIES = 1 << 20  # pieces that a worker keeps at most

# The characters that byte-level pre-tokenization takes for white space.
SPACE = "\t-\r \x85\xa0  -     　"
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# Fixed value: the public split pattern of this vocabulary, with white space spelled out.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
         r"|[{space}]+(?![^{space}])|[{space}]+")
PIECE = SPLIT.format(letter=r"\p{L}", number=r"\p{N}", space=SPACE)
# The same for texts of characters below U+0180, whose letters and numbers are few enough to be spelled out too.
LATIN_PIECE = re.compile(SPLIT.format(letter="A-Za-zªµºÀ-ÖØ-öø-\u017f", number="0-9²³¹¼-¾", space=SPACE))
BEYOND_LATIN = re.compile("[^\0-\u017f]")


class Remembered(dict):
    """Results of ``work`` by text, ``most`` at most in two halves: what is asked for again when the first
    is full moves over from the second, the rest goes. Long texts are not kept."""

    def __init__(self, work: Callable[[str], bytes], most: int):
        self.work, self.half, self.older = work, most // 2, {}

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.work(text)
        if len(text) <= 64:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


class Counter:
    """Exact counts for one vocabulary file; lives in a worker."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        import regex

        self.bpe, added = byte_level(path)
        self.piece = regex.compile(PIECE)
        self.special = re.compile("|".join(re.escape(t) for t, _ in sorted(added, key=lambda a: -len(a[0])))) \
            if added else None
        if max([self.bpe.longest, *(len(t.encode()) for t, _ in added)]) > 255:
            raise ValueError("a token is longer than 255 bytes; its size does not fit a byte")
        self.pieces = Remembered(self._of_piece, cache_entries)

    def _of_piece(self, piece: str) -> bytes:
        """The sizes of the piece's tokens."""
        last = self.bpe.last_sizes(piece.encode())
        sizes, end = [], len(last)
        while end:
            sizes.append(last[end - 1])
            end -= last[end - 1]
        return bytes(sizes[::-1])

    def _of_plain(self, text: str) -> bytes:
        """The sizes of the tokens of a text, or of a chunk of it, without special tokens."""
        return b"".join(map(self.pieces.__getitem__, self.cut_apart(text)))

    def cut_apart(self, text: str) -> list[str]:
        """The pieces of a text without special tokens."""
        return (self.piece if BEYOND_LATIN.search(text) else LATIN_PIECE).findall(text)

    def units(self, text: str) -> Iterator[tuple[str, int]]:
        """The text in order: (chunk or special token, token count)."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[at:m.start()])
            yield m.group(), 1
            at = m.end()
        yield from self._plain(text[at:])

    def _plain(self, text: str) -> Iterator[tuple[str, int]]:
        for c in CHUNK.findall(text):
            yield c, len(self._of_plain(c))

    def sizes(self, text: str | None) -> bytes:
        """The sizes of all tokens of the text in bytes, in order."""
        if not text:
            return b""
        if not self.special or not self.special.search(text):
            return self._of_plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._of_plain(text[at:m.start()]), bytes([len(m.group().encode())])]
            at = m.end()
        return b"".join([*out, self._of_plain(text[at:])])

    def count(self, text: str | None) -> int:
        return len(self.sizes(text))

    def cut(self, text: str | None, limit: int) -> int:
        """How many UTF-8 bytes the first ``limit`` tokens of the text cover."""
        return sum(self.sizes(text)[:limit])

    def prefix_counts(self, text: str | None) -> list[int]:
        """The exact token count of ``text[:k]`` for every k from 0."""
        out, at, done = [0], 0, 0
        text = text or ""
        special = {m.start(): m.end() for m in self.special.finditer(text)} if self.special else {}
        last, last_n = "", 0
        for unit, n in self.units(text):
            if special.get(at) == at + len(unit):
                # Cut inside a special token, its string is ordinary text that joins the chunk before.
                inner = [k - last_n for k in self._chunk_prefixes(last + unit)[len(last):]]
                last, last_n = "", 0
            else:
                inner = self._chunk_prefixes(unit)
                last, last_n = unit, n
            inner[-1] = n
            out += [done + k for k in inner]
            done, at = done + n, at + len(unit)
        return out

    def _chunk_prefixes(self, chunk: str) -> list[int]:
        """Counts of chunk[:1], chunk[:2], ... each taken as a text of its own."""
        out: list[int] = []
        before = 0  # tokens of the pieces left of the last two
        pieces = self.cut_apart(chunk)
        for i, p in enumerate(pieces):
            # A shorter text can only be cut otherwise in its last two pieces.
            tail = (pieces[i - 1] if i else "")
            for k in range(1, len(p) + 1):
                out.append(before + len(self._of_plain(tail + p[:k])))
            if i:
                before += len(self.pieces[tail])
        return out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


TABLE = "doc_id long, n_bytes long, n_tokens long, token_sizes binary"


def prefix_table(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, token_sizes (a byte per token) of every row, stored in the shared folder.

    ``vocabulary``: file path of a byte-level BPE .json that every executor has."""
    source = vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(source or vocabulary_path(VOCABULARY))
        for b in sliced(batches):
            texts = b.column(1).to_pylist()
            sizes = [c.sizes(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                 pa.array([len(x) for x in sizes], pa.int64()), pa.array(sizes, pa.binary())],
                ["doc_id", "n_bytes", "n_tokens", "token_sizes"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return stored(picked.mapInArrow(run, TABLE), "prefix-table")


def truncated(prefixes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) and limit_bytes, the bytes that the
    first ``limit`` tokens cover (all of them below the limit). From the stored table alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = [int(np.frombuffer(x, np.uint8).sum()) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(cut, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "limit_bytes"])

    first = prefixes.select("doc_id", "n_bytes", "n_tokens", F.substring("token_sizes", 1, limit).alias("token_sizes"))
    cut = first.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, limit_bytes long")
    return cut.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "limit_bytes")


def tokens_within(prefixes: DataFrame, n_bytes: int) -> DataFrame:
    """doc_id, tokens: how many of a text's tokens end within its first ``n_bytes`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [int(np.searchsorted(np.cumsum(np.frombuffer(x, np.uint8), dtype=np.int64), n_bytes, "right"))
                     for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int64())], ["doc_id", "tokens"])

    # a token has a byte at least, so no more sizes than bytes can matter
    return prefixes.select("doc_id", F.substring("token_sizes", 1, max(0, n_bytes)).alias("token_sizes")).mapInArrow(run, "doc_id long, tokens long")


def within_budget(prefixes: DataFrame, budget: int) -> DataFrame:
    """doc_id, n_tokens, tokens_before, fits: documents in the order of their ids, the tokens of all
    before each, and whether it ends within ``budget`` tokens. From the stored counts alone.

    Ids are dealt by ranges; each range's total (a row) tells the others where they begin."""
    spark = prefixes.sparkSession
    dealt = (prefixes.select("doc_id", "n_tokens").withColumn("at", order_key("doc_id")).repartitionByRange("at", "n_tokens")
             .sortWithinPartitions("at", "n_tokens").withColumn("place", F.monotonically_increasing_id()))
    dealt = stored(dealt.withColumn("range", F.shiftright("place", 33)), "budget-ranges")
    own = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before, starts = 0, []
    for r in dealt.groupBy("range").agg(F.sum("n_tokens").alias("n")).orderBy("range").collect():
        starts.append((r["range"], before))
        before += r["n"]
    start = spark.createDataFrame(starts, "range long, start long")  # one row per range
    counted = (dealt.join(F.broadcast(start), "range")
               .withColumn("tokens_before", F.col("start") + F.coalesce(F.sum("n_tokens").over(own), F.lit(0))))
    return counted.select("doc_id", "n_tokens", "tokens_before", (F.col("tokens_before") + F.col("n_tokens") <= budget).alias("fits"))


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """:func:`truncated` of the documents' :func:`prefix_table`."""
    return truncated(prefix_table(docs, vocabulary, doc_id, text), limit)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
