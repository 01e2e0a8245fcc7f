"""Benchmark decontamination: BM25 with block-max WAND, then verified overlap.

Index: every benchmark item is cut into a question and an answer (``parts``) and, where it
is long, into units of at most ``UNIT`` words; the inverted index has, per word, the units
that hold it with their BM25 impact, in blocks that know their largest impact. Impacts are
divided by the least score that a unit can have in a text that holds ``SIMILARITY`` of
its shingles: all its impacts but the most that so many missing shingles can hide
(``most_hidden``; a run that is missing whole has up to four words more than shingles).
A shingle that repeats in an item counts for the first unit that has it, so some unit of
an item always holds the item's share. So a text in which no unit scores 1 or more cannot
be contaminated: the threshold loses nothing.

Query: the distinct words of every document are one query, so parts of an item may stand
anywhere in it. The largest impacts per block of units are added up first; a document
that reaches 1 in no block is done, the others walk the postings of the remaining blocks
with block-max WAND and retrieve every unit above the threshold. The
items found are verified on the text: the document is contaminated where it holds at
least ``SIMILARITY`` of the item's five-word shingles, taken over question and answer; the
overlap of each part is returned, and as passage the window of ``WINDOW`` words (each
``UNIT`` words one begins) in which a unit of the item scores most, with that score.

The index goes to the workers by shards of about ``SHARD`` units (an item's units in one), one pass over the
documents for each, so its size there is bounded however many items there are; documents
stay where they are read.

Defined results: null or empty texts and texts without a word match nothing; an item
without a word is left out; a part of fewer than five words is one shingle; equal items
are reported each; null ids are returned as null; rows come per input row and item; empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import parts_for, sliced, stored, table

SHINGLE = 5
SIMILARITY = 0.8
UNIT = 64
WINDOW = 2 * UNIT
SHARD = 4000
BLOCK = 4           # units per block
K1, B = 1.2, 0.75

TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def parts(text: str | None) -> tuple[str, str]:
    """Question and answer: cut after the first question mark, else before the last line,
    else before the last sentence; the answer may be empty."""
    text = (text or "").strip()
    for cut in (r"\?", r"\n(?=[^\n]+\Z)", r"[.!](?=\s+[^.!]+[.!]?\Z)"):
        if (m := re.search(cut, text)) and tokens(text[:m.end()]):
            return text[:m.end()], text[m.end():]
    return text, ""


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def units(question: list[str], answer: list[str]) -> list[list[list[str]]]:
    """The item's units, each a list of word runs whose shingles belong to it. Runs of a long
    part overlap by ``SHINGLE - 1`` words, so each of its shingles is in exactly one."""
    if len(question) + len(answer) <= UNIT:
        return [[p for p in (question, answer) if p]]
    step = UNIT - SHINGLE + 1
    return [[p[i:i + UNIT]] for p in (question, answer) if p
            for i in range(0, max(1, len(p) - SHINGLE + 1), step)]


def own_shingles(question: list[str], answer: list[str]) -> list[list[list[bool]]]:
    """Per unit, run and shingle whether it is the first such shingle of its part."""
    found, seen = units(question, answer), set()
    step = UNIT - SHINGLE + 1
    part_of = [j for j, p in enumerate(p for p in (question, answer) if p)
               for _ in range(0, max(1, len(p) - SHINGLE + 1), step)]
    out = []
    for n, runs in enumerate(found):
        out.append([])
        for i, run in enumerate(runs):
            part = i if len(question) + len(answer) <= UNIT else part_of[n]
            mine = [(part, *run[at:at + SHINGLE]) for at in range(max(1, len(run) - SHINGLE + 1))]
            out[-1].append([s not in seen and not seen.add(s) for s in mine])
    return out


def most_hidden(runs: list[list[str]], own: list[list[bool]], impacts: dict[str, float], missing: int) -> float:
    """The most that ``impacts`` of words can add up to that are hidden with ``missing`` of the own shingles.

    A word is hidden where all shingles over it are missing. Exact for words and shingles that
    occur once; otherwise at least the true sum, as later occurrences are hidden for nothing."""
    seen: set[str] = set()
    total = np.zeros(missing + 1)  # by number of own shingles missing so far
    for run, costs in zip(runs, own):
        gain = []
        for w in run:
            gain.append(0.0 if w in seen else impacts[w])
            seen.add(w)
        n, k = len(run), len(costs)
        last = [total, *[np.full(missing + 1, -np.inf)] * SHINGLE]  # by shingles missing in a row up to here
        for i, cost in enumerate(costs):
            now = [reduce(np.maximum, last), *[np.full(missing + 1, -np.inf)] * SHINGLE]
            for c, best in enumerate(last):
                row = min(SHINGLE, c + 1)
                if cost:
                    best = np.concatenate([[-np.inf], best[:-1]])
                now[row] = np.maximum(now[row], best + (gain[i] if row >= min(SHINGLE, i + 1) else 0.0))
            last = now
        total = reduce(np.maximum, (
            best + sum(gain[p] for p in range(k, n) if c >= min(n - p, k)) for c, best in enumerate(last)))
    return float(total.max())


def keys(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit key of every run of ``n`` words; equal runs have equal keys."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + len(out)].astype(np.uint64) + np.uint64(1)
    return out


class Index:
    """Postings of one shard. ``rows``: (unit number, (item row, item_id), question, answer, runs, impacts by word)."""

    def __init__(self, rows: list[tuple]):
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for n, (_, _, q, a, runs, impacts) in enumerate(rows):
            own = next(o for u, o in zip(units(q, a), own_shingles(q, a)) if u == runs)
            count = sum(map(sum, own))
            hidden = math.floor((1 - SIMILARITY) * count + 1e-9)
            whole = sum(impacts.values())
            least = whole - most_hidden(runs, own, impacts, hidden)
            for word, impact in impacts.items():  # a unit that may lose all its words matches everywhere
                if count:  # else another unit of the item has all its shingles
                    postings[word].append((n, impact / least if least > 1e-9 * whole else math.inf))
        for _, _, q, a, _, _ in rows:
            for word in (*q, *a):  # words of the items' other units: for the shingles only
                postings[word]  # noqa: B018
        self.words = {w: i for i, w in enumerate(postings)}
        known: dict = {}
        coded = lambda words: shingles([self.words[w] for w in words])
        for _, _, q, a, _, _ in rows:  # the units of an item share its shingles
            if (at := (tuple(q), tuple(a))) not in known:
                known[at] = coded(q), coded(a)
        self.items = [(item_id, *known[tuple(q), tuple(a)]) for _, item_id, q, a, _, _ in rows]
        grams: dict[int, list] = defaultdict(list)
        for s in {s for both in known.values() for part in both for s in part}:
            grams[len(s)].append(s)
        self.grams = {n: np.unique(np.concatenate([keys(np.array(s, np.int64), n) for s in found]))
                      for n, found in grams.items()}
        self.blocks = len(rows) // BLOCK + 1
        self.units, self.impacts, self.block_max, self.most = [], [], [], []
        self.of_unit: list[list[tuple[int, float]]] = [[] for _ in rows]
        for w, found in enumerate(postings.values()):
            self.units.append([n for n, _ in found])
            self.impacts.append([x for _, x in found])
            most: dict[int, float] = {}
            for n, x in found:
                most[n // BLOCK] = max(x, most.get(n // BLOCK, 0.0))
                self.of_unit[n].append((w, x))
            self.block_max.append(most)
            self.most.append(max(most.values(), default=0.0))
        # the same block maxima as flat arrays, for bounding all blocks at once
        sizes = [len(m) for m in self.block_max]
        self.first = np.cumsum([0, *sizes])
        self.block = np.array([k for m in self.block_max for k in m], np.int64)
        self.bound = np.array([x for m in self.block_max for x in m.values()])

    def reached(self, own: np.ndarray) -> np.ndarray:
        """The blocks whose largest impacts over the words ``own`` (distinct) add up to 1 or more."""
        sizes = self.first[own + 1] - self.first[own]
        at = np.arange(sizes.sum()) + np.repeat(self.first[own] - np.cumsum(sizes) + sizes, sizes)
        return np.flatnonzero(np.bincount(self.block[at], self.bound[at], self.blocks) >= 1 - 1e-6)

    def held(self, ids: np.ndarray) -> set[tuple[int, ...]]:
        """The shingles of items that the text (word numbers) holds."""
        out = set()
        for n, known in self.grams.items():
            found = keys(ids, n)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found)
            out |= set(map(tuple, ids[at[:, None] + np.arange(n)].tolist()))
        return out

    def passage(self, ids: np.ndarray, unit: int) -> tuple[float, int]:
        """(score, first word) of the first window in which the unit scores most."""
        words, impacts = map(np.array, zip(*sorted(self.of_unit[unit])))
        at = np.flatnonzero(np.isin(ids, words))
        there = np.zeros((-(-len(ids) // UNIT), len(words)), bool)
        there[at // UNIT, np.searchsorted(words, ids[at])] = True
        if len(there) > 1:
            there = there[:-1] | there[1:]
        scores = np.where(there, impacts, 0.0).sum(axis=1)
        best = int(scores.argmax())
        return float(scores[best]), best * UNIT

    def retrieve(self, words: list[int], blocks: np.ndarray | None = None) -> list[tuple[int, float]]:
        """Every unit whose impacts over ``words`` (distinct) add up to 1 or more: block-max WAND.

        ``blocks``: the only ones that can hold such a unit, rising."""
        need = 1 - 1e-9
        if blocks is None:
            blocks = self.reached(np.array(words, np.int64))
        at = {w: 0 for w in words}
        found = []
        for block in blocks.tolist():
            first, end = block * BLOCK, (block + 1) * BLOCK
            lists = []
            for w in words:
                if block in self.block_max[w]:
                    at[w] = bisect_left(self.units[w], first, at[w])
                    lists.append(w)
            while True:
                lists = [w for w in lists if at[w] < len(self.units[w]) and self.units[w][at[w]] < end]
                lists.sort(key=lambda w: self.units[w][at[w]])
                total, pivot = 0.0, None
                for i, w in enumerate(lists):
                    total += self.block_max[w][block]
                    if total >= need:
                        pivot = i
                        break
                if pivot is None:
                    break
                unit = self.units[lists[pivot]][at[lists[pivot]]]
                if self.units[lists[0]][at[lists[0]]] == unit:
                    same = [w for w in lists if self.units[w][at[w]] == unit]
                    score = sum(self.impacts[w][at[w]] for w in same)
                    if score >= need:
                        found.append((unit, score))
                    for w in same:
                        at[w] += 1
                else:
                    for w in lists[:pivot + 1]:
                        at[w] = bisect_left(self.units[w], unit, at[w])
        return found

    def search(self, text: str | None) -> Iterator[tuple]:
        """(item_id, passage, score, overlap, question_overlap, answer_overlap) of every item that the
        text holds; ``passage``: first word of the best window."""
        words = tokens(text)
        if not words or not self.words:
            return
        get, none = self.words.get, len(self.words)
        ids = np.array([get(w, none) for w in words], np.int64)
        own = np.unique(ids)
        own = own[own < none]
        blocks = self.reached(own)
        if not len(blocks):
            return
        best = [unit for unit, _ in self.retrieve(own.tolist(), blocks)]
        if not best:
            return
        have = self.held(ids)
        by_item: dict = {}
        for unit in best:
            item, q, a = self.items[unit]
            overlap = (len(q & have) + len(a & have)) / (len(q) + len(a))
            if overlap >= SIMILARITY - 1e-9:
                score, at = self.passage(ids, unit)
                if item not in by_item or score > by_item[item][1]:
                    by_item[item] = (at, score, overlap, len(q & have) / len(q) if q else None,
                                     len(a & have) / len(a) if a else None)
        for item, found in by_item.items():
            yield (item[1], *found)


UNITS = ("item_key long, item_id long, question array<string>, answer array<string>, "
         "runs array<array<string>>")


def item_units(benchmark: DataFrame) -> DataFrame:
    """The units of all items; ``item_key`` numbers the items' rows, equal ones too (one run's numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, item_id, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                q, a = map(tokens, parts(text))
                rows += [(key, item_id, q, a, runs) for runs in units(q, a) if runs]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [x.split()[0] for x in UNITS.split(", ")])

    numbered = benchmark.select(F.monotonically_increasing_id().alias("item_key"),
                                F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return numbered.mapInArrow(run, UNITS)


def indexes(benchmark: DataFrame, shard: int = SHARD) -> Iterator[Index]:
    """The index in shards of about ``shard`` units each, an item's units in one; document frequencies are
    those of all units."""
    found = stored(item_units(benchmark).withColumn("words", F.flatten("runs")), "benchmark-units")
    n, length = found.agg(F.count("*"), F.avg(F.size("words"))).first()
    frequency = found.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(
        F.count("*").alias("df"))
    shards = parts_for(n, shard)
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("item_key"), F.lit(shards)))
    for s in range(shards if n else 0):
        mine = dealt.filter(F.col("shard") == s)
        df = {r.word: r.df for r in mine.select(F.explode("words").alias("word")).distinct().join(frequency, "word").collect()}
        rows = []
        # units with the same common words side by side: blocks of like units have tight maxima
        usual = lambda r: sorted(set(r.words), key=lambda w: (-df[w], w))[:8]
        units_ = sorted(mine.collect(), key=lambda r: (usual(r), r.item_key, r.runs))
        for i, r in enumerate(units_):
            impacts = {}
            for w in set(r.words):
                tf = r.words.count(w)
                idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                impacts[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(r.words) / length))
            rows.append((i, (r.item_key, r.item_id), r.question, r.answer, r.runs, impacts))
        yield Index(rows)


RESULT = ("doc_id long, item_id long, passage int, score double, overlap double, question_overlap double, "
          "answer_overlap double")


def contaminated(docs: DataFrame, benchmark: DataFrame, shard: int = SHARD, doc_id: str = "doc_id") -> DataFrame:
    """One row per document and benchmark item that it holds; ``doc_id``: the column returned
    under that name (a string column of another name stays a string)."""
    kind = "string" if dict(docs.dtypes)[doc_id] == "string" and doc_id != "doc_id" else "long"
    picked = docs.select(F.col(doc_id).cast(kind).alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = RESULT.replace("doc_id long", f"doc_id {kind}", 1)

    def scan(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)  # about ``shard`` units

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for b in sliced(batches):
                rows = [(d, *hit) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for hit in m.search(t)]
                columns = list(zip(*rows)) or [()] * 7
                kinds = [pa.string() if kind == "string" else pa.int64(), pa.int64(), pa.int32(), *[pa.float64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 [x.split()[0] for x in RESULT.split(", ")])

        return picked.mapInArrow(run, result)

    found = [scan(index) for index in indexes(benchmark, shard)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], result)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
