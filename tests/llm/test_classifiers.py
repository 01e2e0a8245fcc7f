"""Language and toxicity: held-out quality on the given tables, exact parts against restatements, edge cases."""

import random

import numpy as np
import pytest

from strata.llm import language_id as G
from strata.llm import toxicity as T
from strata.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_language(spark):
    found = G.op9_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    odd = "doc_id long, text string, lang string, score int, lang_pred int"
    rows = [(1, None, "en", 1, 1), (2, "", "en", 1, 1), (3, "12 + 3 = 15", "en", 1, 1), (None, "the text and the word", "en", 1, 1),
            (4, "der text und das wort", "de", 1, 1), (4, "der text und das wort", "de", 1, 1), (5, "the " * 50_000, None, 1, 1)]
    docs = spark.createDataFrame(rows, odd)
    got = [(r.doc_id, r.lang_pred) for r in G.identify(docs, G.learn(docs)).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (None, "en"), (4, "de"), (4, "de"), (5, "en")], key=str)
    assert G.language_filter(docs).count() == 4 and G.language_filter(docs).columns == docs.columns
    none = G.learn(docs.filter("lang IS NULL"))
    assert {r.lang_pred for r in G.identify(docs, none).collect()} == {"und"}
    one = G.learn(docs.filter("lang = 'de'"))
    assert {(r.lang_pred, r.score) for r in G.identify(docs, one).collect()} == {("und", 0.0), ("de", 1.0)}
    assert G.identify(docs.limit(0), one).count() == 0


@pytest.mark.parametrize("k", [2, 3, 4, 7, 8, 9, 20, 60])
def test_codewords_are_far_apart_and_ask_different_questions(k):
    words = G.codewords(k).astype(int)
    assert len(words) == k and (words != words[0]).any(axis=0).all()
    columns = {tuple(c) for c in words.T} | {tuple(-c) for c in words.T}
    assert len(columns) == 2 * words.shape[1]
    least = min((words[i] != words[j]).sum() for i in range(k) for j in range(i))
    assert least >= {2: 1, 3: 2}.get(k, 4)
    assert [G.codewords(1).shape, G.codewords(0).shape[0]] == [(1, 0), 0] if k == 2 else True


def invented(k, seed=5):
    """k languages: each has syllables of its own choice."""
    r = random.Random(seed)
    syllables = [a + b + c for a in "bcdfghklmnprstvwz" for b in "aeiou" for c in ["", "n", "r", "s", "l"]]
    own = {f"l{i:02}": r.sample(syllables, 60) for i in range(k)}
    say = lambda lang, n: " ".join("".join(r.choice(own[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))
    return own, say


def trained(spark, k):
    own, say = invented(k)
    rows = [(i, say(lang, 40), lang) for i, lang in enumerate([*own] * 12)]
    return own, say, G.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))


@pytest.mark.parametrize("k", [4, 9, 20])
def test_one_wrong_classifier_is_corrected(spark, k):
    own, say, model = trained(spark, k)
    texts = [(lang, say(lang, 60)) for lang in own for _ in range(3)]
    for j in range(model.words.shape[1]):
        weights = model.weights.copy()
        weights[:, j] *= -1
        broken = G.Model(model.languages, model.words, weights, model.trust)
        assert [broken.predict(t)[0] for _, t in texts] == [lang for lang, _ in texts], j
        assert all(broken.predict(t)[3] >= 1 for _, t in texts)


@pytest.mark.parametrize("k", [2, 4, 20])
def test_the_stage_rejects_random_letters_and_keeps_clean_text(spark, k):
    own, say = invented(k)
    r = random.Random(1)
    noise = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n))
    clean = [(lang, say(lang, r.choice([6, 30, 200]))) for lang in own for _ in range(max(14, 60 // k))]
    rows = [(i, t, lang) for i, (lang, t) in enumerate(clean)] + [(100_000 + i, noise(r.choice([300, 600, 2000])), None) for i in range(60)]
    kept = {x.doc_id for x in G.language_filter(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len([i for i in kept if i < 100_000]) >= 0.99 * len(clean)
    assert len([i for i in kept if i >= 100_000]) <= 1


def test_languages_that_take_turns_are_kept(spark):
    own, say, model = trained(spark, 2)
    a, b = own
    mixed = say(a, 80) + "\n" + say(b, 80) + "\n" + say(a, 60) + "\n" + say(b, 60)
    assert model.predict(mixed)[4] >= G.MIN_AGREEMENT
    noise = random.Random(2)
    assert model.predict("".join(noise.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(1500)))[4] < G.MIN_AGREEMENT


def test_learning_and_decoding_equal_a_dense_restatement(spark):
    own, say = invented(5, seed=9)
    rows = [(i, say(lang, r), lang) for r in (5, 20, 50) for i, lang in enumerate(own)]
    model = G.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))

    def buckets(text):
        raw = b" " + b" ".join(bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in text.lower().encode()).split()) + b" "
        out = []
        for a, b, c in zip(raw, raw[1:], raw[2:]):
            code = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
            code ^= code >> 15
            out.append((code * 0x2C1B3C6D & 0xFFFFFFFF) >> 18)
        return out

    share, seen = np.full((5, G.BUCKETS), 0.5), np.zeros(G.BUCKETS)
    for _, text, lang in rows:
        np.add.at(seen, buckets(text), 1)
        np.add.at(share[list(own).index(lang)], buckets(text), 1)
    share /= share.sum(axis=1, keepdims=True)
    words = np.array([[1 if lang == 0 or n >> (lang - 1) & 1 else -1 for n in range(15)] for lang in range(5)], float)
    assert (model.words == words).all() and model.languages == list(own)
    weights = np.zeros((G.BUCKETS, 15))
    trust = np.zeros(15)
    for j in range(15):
        yes, no = share[words[:, j] > 0], share[words[:, j] < 0]
        odds = np.log(yes.mean(axis=0)) - np.log(no.mean(axis=0))
        typical = share @ (odds - ((yes @ odds).mean() + (no @ odds).mean()) / 2)
        weights[:, j] = (odds - ((yes @ odds).mean() + (no @ odds).mean()) / 2) / np.abs(typical).mean() * (seen > 0)
        trust[j] = max(1e-3, (typical * words[:, j]).min() / np.abs(typical).mean())
    trust = np.clip(trust, trust.mean() / 2, trust.mean() * 1.5) / np.clip(trust, trust.mean() / 2, trust.mean() * 1.5).sum()
    assert np.allclose(model.weights, weights) and np.allclose(model.trust, trust)
    for text in [say(lang, n) for lang in own for n in (1, 8)] + ["zzz qqq", "Ö"]:
        found = buckets(text)
        margin = np.clip([sum(weights[b, j] for b in found) / len(found) for j in range(15)], -1.5, 1.5)
        loss = [sum(trust[j] * np.log1p(np.exp(-3 * words[i, j] * margin[j])) for j in range(15)) for i in range(5)]
        best = int(np.argmin(loss))
        lang, score, _, wrong, agreement = model.predict(text)
        assert (lang, wrong) == (list(own)[best], int((words[best] * margin <= 0).sum()))
        assert score == pytest.approx(1 / sum(np.exp(-4 * (x - loss[best])) for x in loss))
        assert agreement == pytest.approx(sum(trust[j] * min(1, max(-1, words[best, j] * margin[j])) for j in range(15)))


def segments_restated(scores):
    """All maximal segments: the best segment, then the same left and right of it."""
    best = None
    for i in range(len(scores)):
        s = 0
        for j in range(i, len(scores)):
            s += scores[j]
            if s > 0 and (best is None or s > best[0]):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return [*segments_restated(scores[:i]), best, *[(a, b + j + 1, c + j + 1) for a, b, c in segments_restated(scores[j + 1:])]]


def test_segments_are_all_maximal_ones():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(0, 25)
        hits = [(i, r.random() * 3) for i in range(n) if r.random() < 0.4]
        scores = [dict(hits).get(i, -0.7) for i in range(n)]
        got = T.maximal_segments(hits, 0.7)
        want = segments_restated(scores)
        assert [(i, j) for _, i, j in got] == [(i, j) for _, i, j in want]
        assert all(abs(a[0] - b[0]) < 1e-9 for a, b in zip(got, want))


def test_lambda_solves_its_equation():
    lam, k = T.karlin_altschul([(4.0, 0.001), (2.0, 0.004)], 0.25)
    total = 0.001 * 2.718281828459045 ** (4 * lam) + 0.004 * 2.718281828459045 ** (2 * lam)
    assert abs(total + 0.995 * 2.718281828459045 ** (-0.25 * lam) - 1) < 1e-6 and k == pytest.approx(total)


def test_toxic_texts_score_high(spark):
    r = random.Random(4)
    say = lambda n: " ".join(r.choice(["stone", "green", "water", "light", "under", "house"]) + r.choice("abc") for _ in range(n))
    rows, labels = [], []
    for d in range(600):
        bad = d % 5 == 0
        words = say(r.randint(5, 80)).split()
        if bad:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["Idiot", "morons", "scumbag!"]))
        rows.append((d, " ".join(words), 1))
        labels.append((d, int(bad), None))
    rows += [(1000, None, 1), (1001, "", 1), (None, "idiot morons", 1), (1002, "idiot " * 40_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    marks = spark.createDataFrame(labels + [(None, 1, None), (3, None, None)], "doc_id long, toxic int, quality int")
    lexicon = T.learn(docs, marks, ~T.held_out())
    found = {x.doc_id: x for x in T.score(docs, lexicon).collect()}
    assert len(found) == len(rows) and all(0 <= x.score <= 1 for x in found.values())
    assert all((found[d].score >= 0.7) == bool(t) for d, t, _ in labels)
    assert found[1000].score == found[1001].score < 0.1 and found[1002].score >= 0.7 and found[None].score >= 0.7
    clean = T.learn(docs, marks.filter("toxic = 0"), ~T.held_out())
    assert all(x.score < 0.7 for x in T.score(docs, clean).collect())
    assert T.score(docs.limit(0), lexicon).count() == 0


def test_held_out_toxicity(spark):
    found = T.op2_toxicity(spark, "/root/testdata/sf0.1").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    rows = found.filter("held_out AND toxic IS NOT NULL").collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    assert sum(s >= 0.7 for s in toxic) > 0.7 * len(toxic) and sum(s >= 0.7 for s in clean) < 0.02 * len(clean)


def test_e_values_hold_on_clean_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    lexicon = T.learn(docs, labels, ~T.held_out())
    clean = docs.filter(T.held_out()).join(labels.filter("toxic = 0").select("doc_id").distinct(), "doc_id").select("text")
    p = dict(T.token_scores(lexicon, clean))
    texts = [r.text for r in clean.collect()]
    scores = [s for t in texts for s in lexicon.scores(t)]
    assert p == pytest.approx({s: scores.count(s) / (len(scores) + 1) for s in set(scores) if s > 0})
    found = [(len(lexicon.scores(t)), lexicon.segments(t)[1]) for t in texts]
    for e in (1.0, 0.1, 0.01):  # segments with an E-value below e: e a text at most, and not far fewer where there are enough to tell
        hits = sum(lexicon.k * n * 2.718281828459045 ** (-lexicon.lam * s) < e for n, own in found for s, _, _ in own)
        assert hits <= 1.5 * e * len(texts) + 5, e
    assert 0 < lexicon.lam < 5 and 0 < lexicon.k < 1


def test_toxicity_is_calibrated_on_all_labels_when_the_fit_is_sampled(spark):
    r = random.Random(8)
    docs, marks = [], []
    for d in range(2400):
        bad = d % 10 == 0
        words = [r.choice(["stone", "green", "water", "light", "under", "house"]) + r.choice("abc") for _ in range(30)]
        if bad or r.random() < 0.05:
            words[10:10] = ["scumbag"] * 3
        docs.append((d, " ".join(words)))
        marks.append((d, int(bad)))
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    lexicon = T.learn(texts, spark.createDataFrame(marks, "doc_id long, toxic int"), ~T.held_out(), sample=100)
    rows = T.score(texts, lexicon).withColumn("held_out", T.held_out()).collect()
    found = [x for x in rows if x.evidence > 0 and not x.held_out]
    share = sum(x.doc_id % 10 == 0 for x in found) / len(found)
    assert len(found) > 150 and 0.5 < share < 0.8
    assert all(abs(x.score - share) < 0.05 for x in found)
