"""The pipeline against a plain restatement of its stages, and awkward inputs to each stage."""

import random

import corpus_pipeline
import pytest
import sentencepiece

from strata.llm import decontamination as D
from strata.llm import line_dedup as L
from strata.llm import simhash as S
from strata.llm import stages
from strata.llm.token_counts import vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and thing water over under stone green light".split(),
         "de": "der die und über wasser stein grün licht unter schön".split()}


def corpus(seed=1, n=80):
    r = random.Random(seed)
    say = lambda lang, k: " ".join(r.choice(WORDS[lang]) + r.choice(["", "", "s", "en"]) for _ in range(k))
    items = [(i, say("en", 40) + ". " + say("en", 12) + ".") for i in range(6)]
    rows, bodies = [], []
    for d in range(n):
        lang = r.choice(["en", "de"])
        lines = [say(lang, r.choice([4, 30])) for _ in range(r.randint(1, 5))]
        if d % 7 == 0:
            lines.insert(0, "All rights reserved by the same people")
        if d % 11 == 0:
            lines.append(r.choice(items)[1])
        text = "\n".join(lines)
        if d % 5 == 0 and bodies:
            text = r.choice(bodies)
        bodies.append(text)
        rows.append((d, text, lang, "s", len(text)))
    rows += [(n, "", "en", "s", 0), (n + 1, None, None, None, None), (n + 2, "12 34 !!", "en", "s", 8), (None, "the odd one out of all", "en", "s", 1)]
    return rows, items


def restated(rows, items):
    """Language (texts with letters are in no doubt here), lines, fingerprints, leaks, ids."""
    key = lambda d: (d is None, d or 0)
    docs = {d: t for d, t, *_ in rows if t and any(c.isalpha() for c in t)}
    owners, holders = {}, {}
    for d in sorted(docs, key=key):
        for k in {L.key_hash(x) for x in docs[d].split("\n")} - {None}:
            owners.setdefault(k, d)
            holders.setdefault(k, set()).add(d)
    docs = {d: "\n".join(x for x in t.split("\n") if (k := L.key_hash(x)) is None or len(holders[k]) == 1 or owners[k] == d)
            for d, t in docs.items()}
    prints = {d: S.fingerprint(t) for d, t in docs.items()}
    order = sorted(docs, key=key)
    parent = {d: d for d in order}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)), key=key)
                parent[y] = x
    docs = {d: t for d, t in docs.items() if root(d) == d}

    def leaks(text):
        have = D.shingles(D.tokens(text))
        return any(len(p & have) >= 0.8 * len(p) for _, item in items
                   for p in [set().union(*(D.shingles(D.tokens(x)) for x in D.parts(item)))])

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    return {d: sp.encode(t) for d, t in docs.items() if not leaks(t)}


@pytest.fixture
def tables(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows, items


def test_pipeline_equals_its_restatement(spark, tables):
    path, rows, items = tables
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, path).collect()}
    want = restated(rows, items)
    assert got == want
    assert 20 < len(want) < len(rows) - 10
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]


def test_stages_keep_columns_and_take_odd_tables(spark, tables, tmp_path):
    path, *_ = tables
    odd = SCHEMA + ", ids int, score string, doc string, fp long, _extra int"
    empty = spark.createDataFrame([], odd)
    nulls = spark.createDataFrame([(None,) * 10, (1, None, "en", None, None, 1, "s", "d", 2, 3),
                                   (1, "a text with words in it", "en", None, None, 1, "s", "d", 2, 3),
                                   (1, "a text with words in it", "en", None, None, 1, "s", "d", 2, 3)], odd)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (empty, nulls):
            out = stage(spark, docs, path)
            assert name == "sentencepiece" or out.columns == docs.columns
            assert out.count() <= docs.count()
    assert stages.language_id(spark, nulls, path).count() == 2
    assert stages.benchmark_decontamination(spark, nulls, path).count() == 4


def test_null_and_repeated_ids_are_judged_by_their_own_text(spark, tables):
    path, _, items = tables
    r = random.Random(9)
    say = lambda: " ".join(f"w{r.randrange(900)}" for _ in range(60))
    first, second, third, fourth = (say() for _ in range(4))
    rows = [(None, items[0][1]), (None, first), (None, second), (7, items[1][1]), (7, third), (8, None)]
    kept = stages.benchmark_decontamination(spark, spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    assert {tuple(x) for x in kept} == {(None, first), (None, second), (7, third), (8, None)} and len(kept) == 4
    rows = [(5, first), (None, first), (None, second), (None, second.upper()), (6, third), (6, fourth), (9, third), (6, fourth)]
    kept = stages.simhash_near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    assert len(kept) == 4 and {(x.doc_id, x.text.lower()) for x in kept} == {(5, first), (None, second), (6, third), (6, fourth)}
    parts = {(x.doc_id, x.component_id) for x in S.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert parts == {(5, 5), (None, 5), (None, None), (6, 6), (9, 6)}
