"""Token counts and SentencePiece ids against the public libraries on awkward texts."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import sentencepiece as SP
from strata.llm import token_counts as TC
from strata.llm.bpe import Bpe, merge_encode
from strata.llm.token_counts import vocabulary_path

PARTS = [" ", "  ", "     ", "\n", "\t", "\r\n", "a", "the", "ing", "'s", "'re", "!", "...", "<|endoftext|>", "<|endo", "é", "漢字",
         "　", "\xa0", "\x1c", "\x85", "​", "﻿", "🎉", "ß", "aaaa", "====", "12", "²", "▁", "<s>", "<0x0A>", "梦", "abab",
         ",", "word.", "(a,b)", "\x00", "  " * 20, "ssssss"]


def awkward(n, seed=3, most=14):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    return TC.Counter(vocabulary_path(TC.VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(TC.VOCABULARY))


def n_tokens(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(counter, library):
    for t in awkward(3000):
        assert counter.count(t) == n_tokens(library, t), repr(t)


def test_every_prefix_is_exact(counter, library):
    for t in awkward(150, seed=5, most=9):
        assert counter.prefix_counts(t) == [n_tokens(library, t[:k]) for k in range(len(t) + 1)], repr(t)


def test_cut_holds_the_first_tokens(counter, library):
    for t in awkward(200, seed=6):
        offsets = library.encode(t, add_special_tokens=False).offsets
        for limit in (1, 3, 50):
            got = counter.cut(t, limit)
            assert got <= len(t.encode()) and (len(offsets) > limit or got == len(t.encode()))
            if len(offsets) > limit and all(a[1] == b[0] for a, b in zip(offsets, offsets[1:])):
                assert got == len(t[:offsets[limit - 1][1]].encode())


def test_counter_with_a_tiny_cache(library):
    small = TC.Counter(vocabulary_path(TC.VOCABULARY), cache_entries=5)
    for t in awkward(200, seed=7):
        assert small.count(t) == n_tokens(library, t)


def test_paths_equal_replayed_merges():
    b = TC.byte_level(vocabulary_path(TC.VOCABULARY))[0]
    r = random.Random(3)
    for _ in range(1500):
        w = bytes(r.choice(b"aeinorst th.,=\xc3\xa9") for _ in range(r.randint(1, 30)))
        want = merge_encode(b, w)
        assert b.encode(w) == want and b.prefixes(w)[0][-1] == len(want)


def test_a_step_of_the_lattice_is_worked_out_once(monkeypatch):
    b = TC.byte_level(vocabulary_path(TC.VOCABULARY))[0]
    r, tried = random.Random(4), []
    parts = [b"ation", b"er", b"ing", b"que", b"ver", b"\xc3\xa9", b"th", b"sch", b"ou", b"en"]
    words = [b" " + b"".join(r.choice(parts) for _ in range(6)) for _ in range(4000)]
    real = b.fits
    monkeypatch.setattr(b, "fits", lambda x, y: tried.append(1) or real(x, y))
    got = [b.prefixes(w) for w in words]
    assert len(tried) < sum(map(len, words)) / 4  # an edge tried at nearly every byte before
    for w, (count, start) in zip(words[:300], got):
        want = [merge_encode(b, w[:k]) for k in range(len(w) + 1)]
        assert count == [len(x) for x in want] and start[1:] == [k - len(x[-1]) for k, x in enumerate(want) if x]


def test_columns_kept_are_bounded_and_forgotten_ones_found_again():
    full = TC.byte_level(vocabulary_path(TC.VOCABULARY))[0]
    few = {t: full.tokens[t] for t in full.tokens if len(t) < 5}
    pairs = {p: k for p, k in full.pairs.items() if p[0] + p[1] in few}
    wide, narrow = Bpe(few, pairs=pairs), Bpe(few, pairs=pairs, kept_bytes=3000)
    r = random.Random(6)
    for _ in range(300):
        w = bytes(r.choice(b"aeinorst th.,=\xc3\xa9") for _ in range(r.randint(0, 60)))
        assert narrow.last_sizes(w) == wide.last_sizes(w)
        assert wide.prefixes(w)[0][-1] == len(merge_encode(wide, w))
        assert narrow._kept < 3000 + 1000 and len(narrow._columns) < 20
    letters = Bpe({"a": 0, "b": 1, "é": 2, "aé": 3, "aéb": 4}, pairs={("a", "é"): 0, ("aé", "b"): 1})
    assert letters.prefixes("aéb漢aé") == ([0, 1, 1, 1, 2, 3, 3], [-1, 0, 0, 0, 3, 4, 4])


def test_what_is_asked_for_again_stays_remembered():
    made = []
    kept = TC.Remembered(lambda t: made.append(t) or t.encode(), 20)
    for i in range(500):
        assert kept["often"] == b"often" and kept[f"once {i}"] == f"once {i}".encode()
        assert len(kept) + len(kept.older) <= 20
    assert made.count("often") == 1 and len(made) == 501
    assert kept["x" * 65] == b"x" * 65 and "x" * 65 not in kept


def test_latin_texts_are_cut_like_others(counter, library):
    below = [chr(c) for c in range(0x180)]
    r = random.Random(11)
    texts = [*below, *(f"a{c}1{c} {c}'s{c}{c}  {c}" for c in below),
             *("".join(r.choice(below) for _ in range(40)) for _ in range(500))]
    for t in texts:
        assert not TC.BEYOND_LATIN.search(t)
        assert TC.LATIN_PIECE.findall(t) == counter.piece.findall(t) and counter.count(t) == n_tokens(library, t), repr(t)
    assert TC.BEYOND_LATIN.search("aƀ") and counter.count("aƀ²Ⅻ 漢") == n_tokens(library, "aƀ²Ⅻ 漢")


def test_token_count_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "the end", "x"), (3, "the end", "x"), (None, "a" * 100_000, "x"), (5, " " * 3000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = [tuple(r) for r in TC.token_counts(docs).collect()]
    want = [(d, len((t or "").encode()), n_tokens(library, t or ""), n_tokens(library, t or "") > 512) for d, t, _ in rows]
    assert sorted((r[:4] for r in got), key=str) == sorted(want, key=str)
    assert TC.token_counts(docs.limit(0)).count() == 0


def test_stored_prefixes_answer_without_encoding(spark, library, monkeypatch):
    texts = [*awkward(120, seed=12), None, "", "x" * 5000, "same", "same"]
    ids = [*range(len(texts) - 3), None, 7, 7]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    prefixes = TC.prefix_table(docs)
    TC_SIZES("")
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]

    def no(*_):
        raise AssertionError("the encoder was used")

    for name in ("counter", "Counter", "vocabulary_path", "byte_level"):  # on the driver
        monkeypatch.setattr(TC, name, no)
    for answer in (TC.truncated, TC.tokens_within, TC.within_budget):    # and in what is sent to the workers
        assert not {"counter", "Counter", "vocabulary_path", "byte_level"} & names_in(answer.__code__)
    key = lambda r: repr(r)
    sizes = lambda t: TC_SIZES(t)
    for limit in (1, 3, 50):
        got = sorted((tuple(r) for r in TC.truncated(prefixes, limit).collect()), key=key)
        assert got == sorted(((i, len((t or "").encode()), n, n > limit, sum(sizes(t)[:limit])) for i, t, n in zip(ids, texts, want)), key=key)
    for at in (0, 1, 9, 300, 10_000):
        got = sorted((tuple(r) for r in TC.tokens_within(prefixes, at).collect()), key=key)
        ends = lambda t: [sum(sizes(t)[:k + 1]) for k in range(len(sizes(t)))]
        assert got == sorted(((i, sum(e <= at for e in ends(t))) for i, t in zip(ids, texts)), key=key)
    order = sorted(zip(ids, want), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for budget in (0, 10, sum(want) // 2, sum(want)):
        got = sorted(((r.doc_id, r.n_tokens, r.tokens_before, r.fits) for r in TC.within_budget(prefixes, budget).collect()), key=lambda r: r[2:])
        before, rows = 0, []
        for i, n in order:
            rows.append((i, n, before, before + n <= budget))
            before += n
        assert sorted(got, key=key) == sorted(rows, key=key)
    assert TC.within_budget(prefixes.limit(0), 5).count() == TC.tokens_within(prefixes.limit(0), 5).count() == 0


def names_in(code):
    """Global names that a function and the functions inside it use."""
    return set(code.co_names).union(*[names_in(c) for c in code.co_consts if hasattr(c, "co_names")])


COUNTER = None


def TC_SIZES(text):
    """Sizes of the tokens from the path through the lattice (counts are checked against the library)."""
    global COUNTER
    COUNTER = COUNTER or REAL(PATH)
    return list(COUNTER.sizes(text))


PATH, REAL = vocabulary_path(TC.VOCABULARY), TC.Counter


def test_token_sizes_are_the_library_s(counter, library):
    for t in awkward(600, seed=13):
        sizes = counter.sizes(t)
        assert sum(sizes) == len(t.encode())
        offsets = library.encode(t, add_special_tokens=False).offsets
        if all(a[1] == b[0] for a, b in zip(offsets, offsets[1:])):  # no character is cut between tokens
            assert list(sizes) == [len(t[a:b].encode()) for a, b in offsets], repr(t)


def test_ids_equal_the_library_on_both_paths(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(SP.MODEL))
    texts = [*awkward(400, seed=8), None, "", "x" * 50_000 + " y", *["same text, twice."] * 2]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    for most in (0, 100_000):  # all words folded on the spot; all from the relational lattice
        out = {r.doc_id: r for r in SP.encode_documents(docs, most=most).collect()}
        for i, t in enumerate(texts):
            assert list(out[i].ids) == sp.encode(t or ""), repr(t)
            assert out[i].n_tokens == len(out[i].ids) and out[i].round_trip == ("▁" not in (t or "")), repr(t)
    back = {r.doc_id: r.text for r in SP.decode_documents(SP.encode_documents(docs)).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))
    assert SP.encode_documents(docs.limit(0)).count() == 0


def test_relational_words_are_cut_like_python(spark):
    texts = awkward(300, seed=9)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in docs.select(SP.words(docs["text"])).collect()]
    for t, found in zip(texts, got):
        assert "".join(found) == SP.MARK + t.replace(" ", SP.MARK)
        if t.isascii() or all(c.isalpha() or not c.isalnum() for c in t):
            assert list(found) == SP.WORD.findall(SP.MARK + t.replace(" ", SP.MARK)), repr(t)


def test_words_of_chunks_are_the_words_of_the_text(spark):
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "one two, three!\nfour 5six\n\n seven", "x▁y z", "▁", "Zoë's «naïve» café; 3.14 %$ ..",
             "日本 語です。 ok", "tab\there and\r\n there", "a b\n", "\n", ", ,a ,b. c?d e!\nf", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    parts = df.select("doc_id", F.posexplode(SP.chunks(F.col("text"))).alias("at", "chunk"))
    parts = parts.select("doc_id", "at", SP.cut_again(F.col("chunk")).alias("words"))
    got = {i: [] for i in range(len(texts))}
    for r in sorted(parts.collect(), key=lambda r: (r.doc_id, r.at)):
        got[r.doc_id] += r.words
    for i, t in enumerate(texts):
        assert got[i] == ([] if t is None else SP.WORD.findall("▁" + t.replace(" ", "▁"))), t
    plan = SP.chunks(F.col("text"))
    simple = df.filter("doc_id = 7").select(F.size(plan)).first()[0]
    assert simple == 5  # cut at blanks alone
    counts = {r.word: r.n for r in SP.frequent_words(df.filter("doc_id in (3, 4, 5, 6)")).collect()}
    assert counts == {"▁a": 3, "▁▁a": 1, "▁": 1, "▁▁b": 1}


def test_all_texts_of_a_batch_are_decoded_at_once_as_each_alone():
    m = SP.pieces(vocabulary_path(SP.MODEL))
    ids = [m.encode(t, {}) for t in ("", "one two", None, "日本 é ▁ \x00", " a  b\n")] + [np.array(m.byte[200:203], np.int32)]
    ends = np.cumsum([0, *map(len, ids)])
    assert m.decode_all(np.concatenate(ids), ends) == [m.decode(x.tolist()) for x in ids]
    assert m.decode_all(np.zeros(0, np.int32), np.array([0, 0])) == [""]
