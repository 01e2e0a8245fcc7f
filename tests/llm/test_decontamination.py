"""Decontamination against scoring every window and unit, planted leaks, and defined edge cases."""

import random

from strata.llm import decontamination as D


def brute(texts, items):
    """(doc, item) with a window that holds 0.8 of a unit's shingles and a text that holds 0.8 of the item's."""
    out = set()
    for d, t in texts.items():
        words = D.tokens(t)
        grams = {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in range(1, 6)}
        for i, item in items.items():
            q, a = map(D.tokens, D.parts(item))
            pooled = [*D.shingles(q), *D.shingles(a)]
            if not pooled or sum(s in grams[len(s)] for s in pooled) < 0.8 * len(pooled) - 1e-9:
                continue
            for at in range(0, max(1, len(words)), D.UNIT):
                w = words[at:at + D.WINDOW]
                near = {n: {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} for n in range(1, 6)}
                if any(sum(s in near[len(s)] for r in u for s in D.shingles(r))
                       >= 0.8 * sum(len(D.shingles(r)) for r in u) for u in D.units(q, a)):
                    out.add((d, i))
                    break
    return out


def made(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of"] * 60
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = {i: say(r.choice([3, 8, 30, 60])) + ("? " if i % 2 else ". ") + say(r.choice([1, 4, 20])) for i in range(30)}
    items[40] = say(200) + "\n" + say(90)
    texts = {}
    for d in range(120):
        body = say(r.choice([0, 5, 100, 400])).split()
        if d % 3 == 0:
            leak = items[r.choice(list(items))].split()
            for _ in range(r.choice([0, 0, 1, 3, 8])):
                leak[r.randrange(len(leak))] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = leak
        texts[d] = " ".join(body)
    return texts, items


def found(spark, texts, items, **options):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    return D.contaminated(docs, bench, **options)


def test_equals_brute_force(spark):
    texts, items = made(3)
    want = brute(texts, items)
    assert len(want) > 10
    for options in ({}, {"shard": 7}):
        assert {(r.doc_id, r.item_id) for r in found(spark, texts, items, **options).collect()} == want


def test_case_and_punctuation_do_not_hide_a_leak(spark):
    item = "Which river flows through the old town of Ulm? The Danube flows through it."
    rows = found(spark, {1: "intro words here " + item.upper().replace(" ", ",\n") + " and more", 2: "The Danube flows."},
                 {9: item}).collect()
    assert [(r.doc_id, r.item_id, r.overlap, r.question_overlap, r.answer_overlap) for r in rows] == [(1, 9, 1.0, 1.0, 1.0)]


def test_defined_edge_cases(spark):
    items = {1: "alpha beta gamma delta epsilon zeta eta theta", 2: "alpha beta gamma delta epsilon zeta eta theta", 3: None,
             4: "  ", None: "one two three"}
    texts = {1: None, 2: "", 3: "!!!", None: "alpha beta gamma delta epsilon zeta eta theta", 5: "x one two three y",
             6: "one " * 30_000}
    got = sorted(((r.doc_id, r.item_id) for r in found(spark, texts, items).collect()), key=str)
    assert got == sorted([(None, 1), (None, 2), (5, None)], key=str)
    assert found(spark, {1: "a"}, {1: "?"}).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string, score int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(empty, bench).count() == 0


def test_wand_equals_full_scoring():
    r = random.Random(1)
    rows = []
    for i in range(500):
        words = [str(r.randint(0, 80)) for _ in range(r.randint(1, 12))]
        rows.append((i, i, words, [], [words], {w: r.random() for w in words}))
    index = D.Index(rows)
    for _ in range(200):
        query = r.sample(range(len(index.words)), r.randint(1, 40))
        scores = {}
        for w in query:
            for u, x in zip(index.units[w], index.impacts[w]):
                scores[u] = scores.get(u, 0) + x
        assert sorted(u for u, _ in index.retrieve(query)) == sorted(u for u, s in scores.items() if s >= 1 - 1e-9)


def anywhere(texts, items):
    """(doc, item) whose text holds 0.8 of the item's shingles, wherever they stand."""
    out = set()
    for d, t in texts.items():
        words = D.tokens(t)
        grams = {tuple(words[i:i + n]) for n in range(1, 6) for i in range(len(words) - n + 1)}
        for i, item in items.items():
            pooled = [s for p in map(D.tokens, D.parts(item)) for s in D.shingles(p)]
            if pooled and sum(s in grams for s in pooled) >= 0.8 * len(pooled) - 1e-9:
                out.add((d, i))
    return out


def test_parts_alone_and_far_apart_are_found(spark):
    r = random.Random(5)
    say = lambda n, of=4000: " ".join(f"w{r.randrange(of)}" for _ in range(n))
    sizes = [(25, 5), (20, 4), (5, 25), (3, 22), (30, 8), (44, 12), (90, 20), (20, 90), (200, 40), (24, 1)]
    items = {i: say(q) + "? " + say(a) for i, (q, a) in enumerate(sizes * 3)}
    items[40] = " ".join([say(12)] * 9) + "? " + say(70)      # its shingles repeat over its units
    items[41] = " ".join([say(64)] * 3) + " " + say(20) + "? " + say(5)
    texts = {}
    for i, item in items.items():
        q, a = D.parts(item)
        words = item.split()
        cuts = [q, a, q + " " + say(700) + " " + a, a + " " + say(300) + " " + q, " ".join(words[len(words) // 6:]),
                " ".join(words[:len(words) * 5 // 6]), " ".join(words[: len(words) // 2]) + " " + say(400) + " " + " ".join(words[len(words) // 2:])]
        texts |= {len(texts) + n: f"{say(r.choice([0, 40]))} {cut} {say(r.choice([0, 40]))}" for n, cut in enumerate(cuts)}
    want = anywhere(texts, items)
    assert len(want) > 100
    for options in ({}, {"shard": 7}):
        assert {(x.doc_id, x.item_id) for x in found(spark, texts, items, **options).collect()} == want


def test_most_hidden_equals_trying_every_choice():
    from itertools import combinations

    r = random.Random(2)
    for n in range(200):
        left = iter(range(99))
        runs = [[f"w{next(left)}" for _ in range(r.randint(1, 9))] for _ in range(r.randint(1, 2))]
        impacts = {w: r.random() for run in runs for w in run}
        at = [(i, j) for i, run in enumerate(runs) for j in range(max(1, len(run) - 4))]
        missing = r.randint(0, min(3, len(at)))
        most = 0.0
        for gone in combinations(at, missing):
            kept = {w for i, j in at if (i, j) not in gone for w in runs[i][j:j + 5]}
            most = max(most, sum(x for w, x in impacts.items() if w not in kept))
        own = [[True] * max(1, len(run) - 4) for run in runs]
        assert abs(D.most_hidden(runs, own, impacts, missing) - most) < 1e-9


def test_items_with_one_id_or_none_are_each_verified_and_reported_once(spark):
    r = random.Random(12)
    say = lambda n: " ".join(f"w{r.randrange(900)}" for _ in range(n))
    one, two, twin, long = say(30) + "? " + say(5), say(30) + "? " + say(5), say(20), say(200) + "? " + say(90)
    bench = spark.createDataFrame([(None, one), (None, two), (3, twin), (3, twin), (3, one), (4, long)], "item_id long, text string")
    half = " ".join(two.split()[:24])  # scores, but does not hold the item
    docs = spark.createDataFrame([(1, one + " " + two), (2, one + " " + half), (3, twin), (4, long)], "doc_id long, text string")
    want = sorted([(1, None), (1, None), (1, 3), (2, None), (2, 3), (3, 3), (3, 3), (4, 4)], key=str)
    for shard in (4000, 1):
        got = D.contaminated(docs, bench, shard).collect()
        assert sorted(((x.doc_id, x.item_id) for x in got), key=str) == want
