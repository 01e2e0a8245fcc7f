"""SentencePiece encoding and decoding as a relational lattice.

Words (blanks and the letters, or all, that follow them) are encoded once, not once per occurrence:

1. the words of all documents are counted: first the parts between blanks, then, of every
   different part, the words;
2. every substring of a word up to the longest piece is a row, and an equi-join with the
   piece table (bounded by the vocabulary, broadcast) leaves the lattice's edges;
3. the edges of a word are grouped — the words are already partitioned by word, so this
   moves nothing — and folded from left to right with ``aggregate``: the state holds the
   best edge into every position. In a merge vocabulary the best edge is the one that may
   follow its predecessor (``bpe.Bpe``: no merge across their border would come first),
   which a fold over the same edges decides from the ranks along the pieces' borders;
   summed scores, the rule of unigram vocabularies, would not give this vocabulary's ids;
4. a second fold walks the best edges back from the word's end.

The words that occur most often, at most ``MAX_WORDS``, form the dictionary that goes to
the workers (a fixed bound, whatever the corpus); the documents are read once more, each
word looked up, and rarer or longer words folded on the spot by the same recurrence. So
texts never move, and memory does not grow with the corpus.

Decoding joins the pieces and byte pieces of the ids again.

Defined results: null or empty text has no ids and decodes to the empty text; characters
without a piece become byte pieces; the word mark U+2581 in a text is encoded as the blank
that it stands for, so ``round_trip`` is false for such texts alone; rows come back one for
one, further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import TOP, Bpe
from strata.llm.common import sliced, stored, table
from strata.llm.token_counts import vocabulary_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
MAX_WORDS = 200_000   # dictionary entries sent to the workers
MAX_LENGTH = 48       # characters of a dictionary word
CACHE_WORDS = 200_000
# Marks that no piece of the vocabulary holds next to a letter: no merge crosses between the two.
APART = ".,;:!?"
# A word of letters that ends before such a mark, a blank or a line end; else all up to a blank or line end.
CUT = "{mark}*{letter}+(?=[{mark}\n{apart}]|{end})|{mark}+[^{mark}\n]*|[^{mark}\n]+|\n"
WORD = re.compile(CUT.format(mark=MARK, letter=r"[^\W\d_]", apart=APART, end=r"\Z"))
UNKNOWN = -1          # stands for a character without a piece until its bytes are put in


class Pieces:
    """The vocabulary of a SentencePiece merge model with byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [sp.id_to_piece(i) for i in range(len(sp))]
        plain = [i for i in range(len(sp)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.names[i]: i for i in plain}
        if "\n" in self.ids:
            raise ValueError("words are cut at line ends: the vocabulary must not hold them")
        if any(a in APART and b.isalpha() or b in APART and a.isalpha() for p in self.ids for a, b in zip(p, p[1:])):
            raise ValueError(f"words are cut between letters and {APART}: no piece may hold both side by side")
        self.ranks = {self.names[i]: -sp.get_score(i) for i in plain if len(self.names[i]) > 1}
        self.bpe = Bpe(self.ids, ranks=self.ranks)
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.raw = [b""] * len(sp)
        for i in plain:
            self.raw[i] = self.names[i].encode()
        for b, i in enumerate(self.byte):
            self.raw[i] = bytes([b])
        self.binary, self.sizes = pa.array(self.raw, pa.large_binary()), np.array([len(r) for r in self.raw], np.int64)
        self.words: dict[str, bytes] = {}

    def ids_of(self, units: list[str]) -> bytes:
        out = array("i")
        for u in units:
            i = self.ids.get(u)
            out.extend([i] if i is not None else [self.byte[b] for b in u.encode()])
        return out.tobytes()

    def of_word(self, word: str) -> bytes:
        """The ids of a word that the dictionary does not hold, as int32 bytes."""
        known = self.words.get(word)
        if known is None:
            known = self.ids_of(self.bpe.encode(word))
            if len(word) <= MAX_LENGTH:
                if len(self.words) >= CACHE_WORDS:
                    self.words.clear()
                self.words[word] = known
        return known

    def forget(self) -> None:
        """Empty the caches."""
        self.words.clear()
        self.bpe._fits.clear()

    def encode(self, text: str | None, dictionary: dict[str, bytes]) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        known, of_word = dictionary.get, self.of_word
        return np.frombuffer(b"".join([known(w) or of_word(w)
                                       for w in WORD.findall(MARK + text.replace(" ", MARK))]), np.int32)

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """``decode`` of every stretch of ``ids`` between two ``ends``; the pieces of all are joined at once."""
        joined = self.binary.take(pa.array(ids, pa.int32()))
        at = np.concatenate([[0], np.cumsum(self.sizes[ids])])[ends].tolist()
        raw = joined.buffers()[2]
        raw = raw.to_pybytes() if raw is not None else b""
        return [raw[a:b].decode("utf-8", "replace").replace(MARK, " ")[1:] for a, b in zip(at, at[1:])]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.decode("utf-8", "replace").replace(MARK, " ")[1:]

    def table(self, spark: SparkSession) -> DataFrame:
        """piece, id, rank, left, right: of every piece that can stand in an encoding. ``left[n-1]`` is
        the rank of the merge that swallows its prefix of n characters, -1 where no such prefix is built."""
        def border(piece: str, spine: tuple) -> list[float]:
            by_length = dict(spine)
            return [float(by_length.get(n, -1)) for n in range(1, len(piece) + 1)]

        rows = [(p, i, float(self.ranks.get(p, TOP)), border(p, self.bpe.left[p]), border(p, self.bpe.right[p]))
                for p, i in self.bpe.spans.items()]
        return spark.createDataFrame(rows, "piece string, id int, rank double, left array<double>, right array<double>")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def words(text: Column) -> Column:
    """The words of a text, as an array column; the same cuts as ``WORD``."""
    marked = F.concat(F.lit(MARK), F.translate(text, " ", MARK))
    return cut_again(marked)


def chunks(text: Column) -> Column:
    """Parts of a text, as an array column; the words of all parts are those of the text. Parts are cut
    before blanks; the text's own words where blanks meet, begin it or are written as marks."""
    cut = F.split(F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(" " + MARK))), " ")
    return F.when(text.contains("  ") | text.startswith(" ") | text.contains(MARK), words(text)).otherwise(cut)


def cut_again(chunk: Column) -> Column:
    """The words of a marked text or of one of its ``chunks``; the same cuts as ``WORD``."""
    return F.regexp_extract_all(chunk, F.lit(CUT.format(mark=MARK, letter=r"\p{L}", apart=APART, end=r"\z")), F.lit(0))


def lattice(word_table: DataFrame, piece_table: DataFrame, longest: int) -> DataFrame:
    """(word, n, edges): per word its edges (s, e, id, rank, left, right)."""
    starts = word_table.select("word", F.char_length("word").alias("n")).withColumn(
        "s", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    spans = starts.withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.col("n") - F.col("s")))))
    cut = spans.withColumn("piece", F.col("word").substr(F.col("s") + 1, F.col("size")))
    edges = (cut.join(F.broadcast(piece_table), "piece", "left")
             .filter(F.col("id").isNotNull() | (F.col("size") == 1)))
    whole = F.array(F.lit(float(TOP)))  # a character without a piece merges with nothing
    edge = F.struct("s", (F.col("s") + F.col("size")).alias("e"), F.coalesce("id", F.lit(UNKNOWN)).alias("id"),
                    F.coalesce("rank", F.lit(float(TOP))).alias("rank"), F.coalesce("left", whole).alias("left"),
                    F.coalesce("right", whole).alias("right"))
    return edges.groupBy("word", "n").agg(F.collect_list(edge).alias("edges"))


EDGE = "struct<s:int,e:int,id:int,rank:double,left:array<double>,right:array<double>>"


def viterbi(edges: Column, merges: Column, n: Column) -> Column:
    """The best edge into every position from 0 to n; ``merges``: the edges of two and more characters."""

    def fits(a: Column, b: Column) -> Column:
        return ~F.exists(merges, lambda c: (
            (c["s"] < b["s"]) & (c["e"] > b["s"]) & (c["e"] <= b["e"]) & (c["s"] >= a["s"])
            & (c["rank"] < F.get(a["right"], b["s"] - c["s"] - 1)) & (c["rank"] <= F.get(b["left"], c["e"] - b["s"] - 1))))

    def step(best: Column, end: Column) -> Column:
        into = F.filter(edges, lambda x: (x["e"] == end) & ((x["s"] == 0) | fits(F.get(best, x["s"]), x)))
        return F.concat(best, F.array(F.get(into, F.lit(0))))

    return F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(None).cast(EDGE)), step)


def walk_back(best: Column, n: Column) -> Column:
    """The (s, id) pairs of the best path, from left to right."""
    return F.aggregate(
        F.sequence(n, F.lit(1), F.lit(-1)),
        F.struct(n.alias("at"), F.array().cast("array<struct<s:int,id:int>>").alias("path")),
        lambda state, at: F.when(at == state["at"], F.struct(
            F.get(best, at)["s"].alias("at"),
            F.concat(F.array(F.struct(F.get(best, at)["s"].alias("s"), F.get(best, at)["id"].alias("id"))),
                     state["path"]).alias("path"))).otherwise(state),
        lambda state: state["path"])


def encode_words(word_table: DataFrame, model: Pieces) -> DataFrame:
    """(word, path): the encoding of every word as (start, id) pairs."""
    spark = word_table.sparkSession
    dealt = word_table.select("word").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    grouped = lattice(dealt, model.table(spark), model.bpe.longest)
    merges = F.filter("edges", lambda x: x["e"] - x["s"] > 1)
    folded = grouped.withColumn("merges", merges).withColumn("best", viterbi(F.col("edges"), F.col("merges"), F.col("n")))
    return folded.select("word", walk_back(F.col("best"), F.col("n")).alias("path"))


def frequent_words(docs: DataFrame, most: int = MAX_WORDS) -> DataFrame:
    """The words of at most ``MAX_LENGTH`` characters that occur oftest, all with the same count or
    none, ``most`` of them at most."""
    parts = docs.select(F.explode(chunks(F.col("text"))).alias("chunk")).groupBy("chunk").agg(F.count("*").alias("n"))
    each = parts.select("n", F.explode(cut_again(F.col("chunk"))).alias("word"))  # a different part is cut once
    counted = stored(each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.char_length("word") <= MAX_LENGTH),
                     "sentencepiece-words")
    # per power of two of the count and its sixteenth: some hundred rows, whatever the corpus
    step = F.when(F.col("n") <= 64, F.col("n").cast("double")).otherwise(64 + F.floor(16 * F.log2(F.col("n") / 64.0)))
    sizes = counted.groupBy(step.alias("step")).agg(F.count("*").alias("w"), F.min("n").alias("least")).collect()
    total, least = 0, None
    for r in sorted(sizes, key=lambda r: -r.step):
        total += r.w
        if total > most:
            break
        least = r.least
    return counted.filter(F.col("n") >= least) if least is not None else counted.limit(0)


def dictionary(docs: DataFrame, model: Pieces, most: int = MAX_WORDS) -> dict[str, bytes]:
    """word → int32 ids of the most frequent words; ``most`` entries of bounded length at most."""
    found = encode_words(frequent_words(docs, most), model).select(
        "word", F.transform("path", lambda p: p["s"]).alias("starts"), F.transform("path", lambda p: p["id"]).alias("ids"))
    out = {}
    for b in found.toArrow().to_batches():
        for word, starts, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if UNKNOWN in ids:
                ids = [j for s, i in zip(starts, ids)
                       for j in ([i] if i != UNKNOWN else [model.byte[x] for x in word[s].encode()])]
            out[word] = array("i", ids).tobytes()
    return out


def encode_documents(docs: DataFrame, model: str | None = None, most: int = MAX_WORDS) -> DataFrame:
    """doc_id, ids, n_tokens, n_bytes, round_trip (decoding the ids gives the text); one row per input row.

    ``model``: file path of the vocabulary that driver and executors have."""
    path = model or vocabulary_path(MODEL)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(picked, pieces(path), most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = pieces(model or vocabulary_path(MODEL)), shared.value
        try:
            for b in sliced(batches):
                texts = b.column(1).to_pylist()
                ids = [m.encode(t, known) for t in texts]
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32, copy=False)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                     pa.array([len(x) for x in ids], pa.int64()), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                     pa.array([d == (t or "") for d, t in zip(m.decode_all(flat, ends), texts)], pa.bool_())],
                    ["doc_id", "ids", "n_tokens", "n_bytes", "round_trip"])
        finally:  # the worker lives on and may serve other stages
            m.forget()

    return picked.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, n_bytes long, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model or vocabulary_path(MODEL))
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
