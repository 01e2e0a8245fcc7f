"""Language identification with error-correcting output codes.

Each language gets a codeword; one binary classifier per bit tells the
languages whose word has this bit from the others, by the log-odds of hashed
letter trigrams. No two bits ask the same question: up to ``EXHAUSTIVE`` languages
every split is a bit (four languages: 7 bits, any two words 4 apart), beyond it random
splits whose words lie farthest apart of those tried. A text's margins, bounded so that one
classifier cannot outvote the others, are compared with every codeword by a
logistic loss, each bit weighted by how well it separates the training
languages; the codeword of smallest loss names the language, and a text whose
two best words are nearly as good is flagged. From four languages on one classifier
may be wrong without changing the answer; two or three languages have no room for that
(their words are one and two bits apart).

A text agrees with its codeword as far as its margins point the codeword's way: about 0.9
for a text of a learned language, about 0.1 for 300 random letters or more, whatever the
number of languages (a line of 20 may reach 0.4: too short to tell). A text that agrees with
none is judged again in stretches, since languages that take turns cancel each other. The filter
goes by that, not by the score, which only says how the words compare.

Learning is one pass of counting: a task adds up the trigrams of its documents
per language in fixed-size arrays, Spark adds the arrays of the tasks, and a
model of (bits x buckets) floats goes to the workers. Its size does not depend
on the corpus.

Defined results: null text or text without a letter is ``und`` with score 0;
with no language to learn every text is ``und``; with one language, texts with
letters get it. Rows come back one for one (repeated rows and null ids
included); a null id is never held out and is learned from. Only the columns
named are read, so further columns do not matter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import crc_mod, sliced, table

BUCKETS = 1 << 14
UNDETERMINED = "und"
AMBIGUOUS = 0.1      # relative difference of the two smallest losses
MIN_AGREEMENT = 0.3  # the filter rejects below
EXHAUSTIVE = 7       # languages up to which every split is a bit
WINDOW = 256         # trigrams of a stretch that is judged by itself where a text agrees with no word
MAX_MARGIN = 1.5     # a typical text has margins of about 1
TRIES = 64           # random codes tried

LETTER = re.compile(r"[^\W\d_]")
# Bytes that are no letters (ASCII other than a-z, after lower-casing) count as one blank.
BLANKED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(text: str) -> np.ndarray:
    """Bucket of every letter trigram (as UTF-8 bytes, blank-padded) of the whole text."""
    raw = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(BLANKED).split())
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] * MULTIPLIERS[0]) ^ (b[1:-1] * MULTIPLIERS[1]) ^ (b[2:] * MULTIPLIERS[2])
    code ^= code >> np.uint32(15)
    return (code * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 14)


def codewords(k: int) -> np.ndarray:
    """``k`` words of +1/-1, one per row; no column repeats another, or its opposite, or is constant."""
    if k <= EXHAUSTIVE:
        columns = [[1, *[1 if n >> i & 1 else -1 for i in range(k - 1)]] for n in range(2 ** max(0, k - 1) - 1)]
        return np.array(columns, np.int8).reshape(len(columns), k).T
    bits = 5 * math.ceil(math.log2(k))
    best, apart = None, -1
    for seed in range(TRIES):
        random = np.random.default_rng(seed)
        columns: dict[tuple, None] = {}
        while len(columns) < bits:
            half = np.where(random.permutation(k) < k // 2, 1, -1)
            columns[tuple((half * half[0]).tolist())] = None  # the first language's bit is 1: no opposites
        words = np.array(list(columns), np.int8).T
        distance = (bits - words.astype(int) @ words.T) // 2
        least = int(distance[~np.eye(k, dtype=bool)].min())
        if least > apart:
            best, apart = words, least
    return best


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray    # languages x bits
    weights: np.ndarray  # buckets x bits, mean margin of about +1/-1
    trust: np.ndarray    # bits, sums to 1

    def predict(self, text: str | None) -> tuple[str, float, bool, int, float]:
        """Language, score, ambiguity flag, bits that differ from the codeword, agreement with it."""
        if not self.languages or not text or not LETTER.search(text):
            return UNDETERMINED, 0.0, False, 0, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False, 0, 1.0
        g = grams(text)
        margin = np.clip(np.bincount(g, minlength=BUCKETS) @ self.weights / len(g), -MAX_MARGIN, MAX_MARGIN)
        loss = np.logaddexp(0, -3 * self.words * margin) @ self.trust
        order = np.argsort(loss, kind="stable")
        best, second = order[0], order[1]
        belief = np.exp(-4 * (loss - loss[best]))
        agreement = float(np.clip(self.words[best] * margin, -1, 1) @ self.trust)
        if agreement < MIN_AGREEMENT and len(g) > WINDOW:  # several languages, perhaps: each stretch by itself
            starts = np.arange(0, len(g) - WINDOW // 2, WINDOW)
            parts = np.add.reduceat(self.weights[g], starts) / np.diff([*starts, len(g)])[:, None]
            agreement = float((np.clip(self.words[None] * parts[:, None], -1, 1) @ self.trust).max(axis=1).mean())
        return (self.languages[best], float(1 / belief.sum()), bool(loss[second] - loss[best] < AMBIGUOUS * loss[second]),
                int((self.words[best] * margin <= 0).sum()), agreement)


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Fit on every row with a language; ``docs`` holds training rows only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in sliced(batches):
            for language, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t and LETTER.search(t):
                    g = np.bincount(grams(t), minlength=BUCKETS)
                    sums[language] = sums[language] + g if language in sums else g
        for language, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(at)), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                ["lang", "bucket", "n"])

    rows = (docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
            .mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .toPandas())  # languages x BUCKETS at most
    languages = sorted(rows["lang"].unique())
    k = len(languages)
    if k < 2:
        return Model(languages, np.zeros((k, 0)), np.zeros((BUCKETS, 0)), np.zeros(0))
    counts = np.zeros((k, BUCKETS))
    counts[rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(), rows["bucket"].to_numpy()] = rows["n"]
    seen = counts.any(axis=0)  # a trigram that no language has tells nothing
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)  # every language counts alike
    words = codewords(k).astype(float)
    weights = np.empty((BUCKETS, words.shape[1]))
    trust = np.empty(words.shape[1])
    for j, bit in enumerate(words.T):
        w = np.log(share[bit > 0].mean(axis=0)) - np.log(share[bit < 0].mean(axis=0))
        w -= (share[bit > 0] @ w).mean() / 2 + (share[bit < 0] @ w).mean() / 2
        scale = max(1e-9, np.abs(share @ w).mean())
        weights[:, j] = np.where(seen, w / scale, 0.0)
        trust[j] = max(1e-3, (share @ w * bit).min() / scale)
    trust = np.clip(trust, trust.mean() / 2, trust.mean() * 1.5)  # no bit speaks for several
    return Model(languages, words, weights, trust / trust.sum())


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, ambiguous, wrong_bits; one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x bits floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in sliced(batches):
            found = [m.predict(t) for t in b.column(1).to_pylist()]
            lang, score, unsure, wrong, _ = zip(*found) if found else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(unsure, pa.bool_()), pa.array(wrong, pa.int32())],
                ["doc_id", "lang_pred", "score", "ambiguous", "wrong_bits"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean, wrong_bits int")


def held_out() -> Column:
    return F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous",
                                        "wrong_bits")


def language_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a recognised language, with all their columns.

    Rejected: null text, text without a letter, and an agreement below ``MIN_AGREEMENT``.
    The text is judged where the row is; nothing is joined or shuffled."""
    model = learn(docs.filter(~held_out()))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in sliced(batches):
            found = [m.predict(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([lang != UNDETERMINED and agreement >= MIN_AGREEMENT for lang, *_, agreement in found],
                                    pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
