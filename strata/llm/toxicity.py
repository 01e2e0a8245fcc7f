"""Toxicity by maximum-scoring segments.

1. Words and the letter 4- and 5-grams inside them (insults are inflected and
   compounded) get log-odds of standing in toxic against clean documents, with
   a Dirichlet prior in proportion to the number of all documents that hold
   them (so no text can shift it by repeating a word); those
   whose odds stand out (by ``MIN_ODDS`` and z >= ``MIN_Z``) form the lexicon, at most
   ``MAX_LEXICON`` of them. A token scores the highest odds of its word and
   grams; a token without any costs ``-DRIFT``, so chance segments do not grow.
2. Each whole text is scanned once (Ruzzo and Tompa): all maximal-scoring
   segments, in linear time. Runs of other tokens enter as one step.
3. Extreme-value calibration: the token scores of clean training texts that the lexicon was
   not fitted on (one in ``RESERVE``) are counted;
   lambda solves sum p exp(lambda s) = 1 over that histogram, K is the part of that sum that
   positive scores make (a segment starts with one). A segment of score S in a text of n tokens has the
   E-value K n exp(-lambda S): at most about that many such segments are expected in clean
   text of n tokens. The text's evidence is the sum of -ln E over its
   significant segments (E < 1); the share of toxic texts by evidence among all
   labelled training texts, made monotone, is the score.

The counting is one grouped aggregate over all documents (map-side combined,
one row per token); the scan is one Arrow pass with the lexicon broadcast,
bounded by ``MAX_LEXICON``; the calibration scans the training texts where they
are and joins only ids and evidence bins with the labels; ``BINS`` sums reach the
driver.

Defined results: null or empty texts have no segment and get the score of no
evidence; rows come back one for one; null ids are not held out and have no
label; without labels of both kinds every score is 0.
Of several labels of one doc_id the largest counts.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import crc_mod, sliced, stored, table

MIN_Z = 3.0
MIN_ODDS = 2.5
MAX_LEXICON = 20_000
MAX_LABELLED = 20_000  # labelled documents of each kind that the lexicon is fitted on
RESERVE = 4            # of so many clean labelled documents one is kept back for the score distribution
PRIOR = 0.02       # weight of the prior, as a share of the labelled counts
DRIFT = 0.25
GRAMS = (4, 5)
CACHE_WORDS = 1 << 19
BINS = 64
BIN_WIDTH = 0.5
THRESHOLD = 0.7

TOKEN = re.compile(r"[^\W_]+")
# what separates the same tokens, for Spark
NOT_TOKEN = r"[^\p{L}\p{N}]+"


def features(word: str) -> set[str]:
    return {word, *("#" + word[i:i + n] for n in GRAMS for i in range(len(word) - n + 1))}


@dataclass
class Lexicon:
    odds: dict[str, float]
    lam: float = 1.0
    k: float = 1.0
    curve: list[tuple[int, float]] = field(default_factory=list)  # (evidence bin, share of toxic texts), rising
    words: dict[str, float] = field(default_factory=dict)  # a worker's cache

    def segments(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        """Token count, and the maximal segments as (score, first token, last token)."""
        scores = self.scores(text)
        return len(scores), maximal_segments([(i, s) for i, s in enumerate(scores) if s], DRIFT)

    def scores(self, text: str | None) -> list[float]:
        """The score of every token, 0 without a word or gram of the lexicon."""
        if not text:
            return []
        known, of_word = self.words.get, self._of_word
        return [s if (s := known(w)) is not None else of_word(w) for w in TOKEN.findall(text.lower())]

    def _of_word(self, word: str) -> float:
        """The highest odds of the word and its grams, 0 without any."""
        found = [s for g in features(word) if (s := self.odds.get(g))]
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        best = self.words[word] = max(found, default=0.0)
        return best

    def evidence(self, n: int, segments: list[tuple[float, int, int]]) -> float:
        base = math.log(self.k * max(n, 1))
        return sum(x for s, _, _ in segments if (x := self.lam * s - base) > 0)

    def score(self, evidence: float) -> float:
        """Monotone in the evidence: between the centres of two bins that have texts, in proportion."""
        if not self.curve:
            return 0.0
        at = evidence / BIN_WIDTH
        i = bisect_left(self.curve, at, key=lambda k: k[0])
        if i == 0 or i == len(self.curve):
            return self.curve[max(0, i - 1)][1]
        (x, low), (y, high) = self.curve[i - 1], self.curve[i]
        return low + (high - low) * (at - x) / (y - x)


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments of a sequence in which ``hits`` (position, positive
    score) stand and every other position scores ``-drift``; linear time.

    Each kept candidate is [sum before it, sum up to its end, first, last, index of the nearest
    earlier candidate with a smaller sum before]."""
    kept: list[list] = []
    total, end = 0.0, 0
    for i, s in hits:
        total -= drift * (i - end)
        before, total, end = total, total + s, i + 1
        now = [before, total, i, i, -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= now[0]:
                j = kept[j][4]
            now[4] = j
            if j < 0 or kept[j][1] >= now[1]:
                kept.append(now)
                break
            now = [kept[j][0], now[1], kept[j][2], now[3], -1]
            del kept[j:]
    return [(b - a, first, last) for a, b, first, last, _ in kept]


def learn(docs: DataFrame, labels: DataFrame, training: Column, sample: int = MAX_LABELLED) -> Lexicon:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic; ``training``: which doc_ids may teach.

    The lexicon is fitted on at most ``sample`` labelled documents of each kind (those whose id
    hashes lowest), so the join with the texts may broadcast their ids; the prior counts the words
    of every document, and the calibration all that are labelled."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & training)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    few = reduce(DataFrame.union, [known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id")
                                   .limit(sample) for kind in (0, 1)])
    # one clean document in RESERVE is not fitted on: its token scores are those of unseen clean text
    kept_back = (F.col("toxic") == 0) & (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(RESERVE)) == 0)
    labelled = stored(docs.select("doc_id", "text").join(F.broadcast(few.withColumn("reserve", kept_back)), "doc_id")
                      .select("text", "toxic", "reserve"), "toxicity-labelled")
    taught, reserve = labelled.filter("NOT reserve"), labelled.filter("reserve").select("text")
    split = F.split(F.lower("text"), NOT_TOKEN)
    words = lambda df, each: df.withColumn("w", F.explode(each)).filter("w <> ''")
    grams = F.flatten(F.transform(F.array(*map(F.lit, GRAMS)), lambda n: F.when(
        F.length("w") >= n, F.transform(F.sequence(F.lit(1), F.length("w") - n + 1),
                                        lambda i: F.concat(F.lit("#"), F.substring("w", i, n))))
        .otherwise(F.array().cast("array<string>"))))
    by_word = (
        words(taught, F.array_distinct(split)).groupBy("w").agg(F.count_if(F.col("toxic") == 1).alias("t"),
                                       F.count_if(F.col("toxic") == 0).alias("c"))
        .join(words(docs.select("text"), F.array_distinct(split)).groupBy("w").agg(F.count("*").alias("n")), "w"))
    counts = stored(by_word.withColumn("w", F.explode(F.concat(F.array("w"), F.array_distinct(grams))))
                    .groupBy("w").agg(*(F.sum(c).alias(c) for c in "tcn")), "toxicity-features")
    total = counts.agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    if not total.t or not total.c:
        return Lexicon({})
    prior = PRIOR * (total.t + total.c)
    a = F.col("n") / total.n * prior
    odds = lambda y, of: F.log((F.col(y) + a) / (of + prior - F.col(y) - a))
    best = (counts.filter(F.col("t") > 0).withColumn("d", odds("t", total.t) - odds("c", total.c))
            .withColumn("z", F.col("d") / F.sqrt(1 / (F.col("t") + a) + 1 / (F.col("c") + a)))
            .filter((F.col("z") >= MIN_Z) & (F.col("d") >= MIN_ODDS)).orderBy(F.desc("z"), "w").limit(MAX_LEXICON).collect())
    lexicon = Lexicon({r.w: r.d for r in best})
    if best:
        lexicon.lam, lexicon.k = karlin_altschul(token_scores(lexicon, reserve), DRIFT)
    calibrate(lexicon, docs.filter(F.col("doc_id").isNotNull() & training), known)
    return lexicon


def token_scores(lexicon: Lexicon, texts: DataFrame) -> list[tuple[float, float]]:
    """(score, share of all tokens) of the positive token scores in ``texts`` (text).

    As many rows as there are different scores, the lexicon's size at most."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        seen: Counter = Counter()
        for b in sliced(batches):
            for t in b.column(0).to_pylist():
                seen.update(m.scores(t))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.float64()), pa.array(list(seen.values()), pa.int64())], ["s", "n"])

    rows = texts.mapInArrow(run, "s double, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in rows) + 1
    found = [(r.s, r.n / total) for r in rows if r.s > 0]
    # none of the lexicon's words in clean text: half a token of the lowest score, so that lambda stays finite
    return found or [(min(lexicon.odds.values()), 0.5 / total)]


def karlin_altschul(hits: list[tuple[float, float]], drift: float) -> tuple[float, float]:
    """lambda with sum p exp(lambda s) = 1 over clean text's token scores, and K = sum p exp(lambda s)
    over the positive ones: a segment starts with a hit of score s, from where it reaches S with
    a probability of exp(-lambda (S - s)) at most."""
    rest = 1 - sum(p for _, p in hits)

    def excess(lam: float) -> float:
        return sum(p * math.exp(min(700, lam * s)) for s, p in hits) + rest * math.exp(-lam * drift) - 1

    if sum(p * s for s, p in hits) - rest * drift >= 0:  # clean text would climb: no calibration possible
        return 1e-3, 1.0
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 1e3:
        low, high = high, high * 2
    low = low or 1e-9
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    lam = max(low, 1e-3)
    return lam, max(1e-9, sum(p * math.exp(min(700, lam * s)) for s, p in hits))


def calibrate(lexicon: Lexicon, docs: DataFrame, known: DataFrame) -> None:
    """Fill ``lexicon.curve``: the share of toxic texts per evidence bin, monotone.

    ``known``: doc_id, toxic; every labelled text counts, so the shares are those of the input."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in sliced(batches):
            found = [min(BINS - 1, round(m.evidence(*m.segments(t)) / BIN_WIDTH)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int32())], ["doc_id", "bin"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a repeated id is one row per bin before it meets its label
    found = picked.mapInArrow(run, "doc_id long, bin int").groupBy("doc_id", "bin").agg(F.count("*").alias("rows"))
    bins = (found.join(known, "doc_id").groupBy("bin")
            .agg(F.sum("rows").alias("n"), F.sum(F.when(F.col("toxic") == 1, F.col("rows")).otherwise(0)).alias("t"))
            .collect())
    everywhere = sum(r.t for r in bins) / max(1, sum(r.n for r in bins))
    blocks: list[list] = []  # [toxic, texts, bins]; neighbours are pooled while the share falls
    for r in sorted(bins, key=lambda r: r.bin):
        blocks.append([r.t + everywhere * 0.01, r.n + 0.01, [r.bin]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] > blocks[-1][0] / blocks[-1][1]:
            t, n, own = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + n, blocks[-1][2] + own]
    lexicon.curve = [(b, t / n) for t, n, own in blocks for b in own]


def score(docs: DataFrame, lexicon: Lexicon, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, evidence, n_segments (significant ones), spans (their [first token, last token, score])."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most MAX_LEXICON words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in sliced(batches):
            scores, evidences, spans = [], [], []
            for t in b.column(1).to_pylist():
                n, found = m.segments(t)
                e = m.evidence(n, found)
                base = math.log(m.k * max(n, 1))
                scores.append(m.score(e))
                evidences.append(e)
                spans.append([{"first": i, "last": j, "score": s} for s, i, j in found if m.lam * s > base])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array(evidences, pa.float64()),
                 pa.array([len(x) for x in spans], pa.int32()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()),
                                                     ("score", pa.float64())])))],
                ["doc_id", "score", "evidence", "n_segments", "spans"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, score double, evidence double, n_segments int, "
                                  "spans array<struct<first: int, last: int, score: double>>")


def held_out() -> Column:
    return F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = learn(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, lexicon).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence", "n_segments", "spans")
