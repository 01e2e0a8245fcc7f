"""Prefix trie: nodes against a plain restatement over any cut into shards; rebuilding, edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from strata.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """conv_id → its turns; rows: (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append((turn is not None, turn or 0, digest, role, text))
    return {c: [x[3:] for x in sorted(own)] for c, own in convs.items()}


def again(convs):
    def fmod5(c):
        return c - (abs(c) % 5) * (1 if c >= 0 else -1)

    h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
    return {c: convs.get(fmod5(c), [])[:h[c]] + own[h[c]:] for c, own in convs.items()}


def plain(convs):
    members = defaultdict(list)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    out = []
    for prefix, own in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = sum(not any(q[:len(p)] == p and len(q) > len(p) for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in own if len(convs[c]) == len(prefix)))
        out.append((min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own), len(children), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "k", 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in T.prefix_trie(T.rebuilt(T.digested(df)), **sizes).select(OUT).collect()), key=repr)


@pytest.fixture(scope="module")
def talk():
    r = random.Random(6)
    rows = []
    for c in range(90):
        hot = r.random() < 0.4
        for turn in range(r.randrange(1, 12)):
            text = ["hi", "héllo", "", None][turn % 4] if hot else r.choice(["a", "b", "ü"]) * r.randrange(1, 3)
            rows.append((3 * c, turn, r.choice(["user", "user", None]) if not hot else "user", text))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_convs": 7, "part_turns": 60}, {"shard_convs": 1, "part_turns": 1000}, {"shard_turns": 20, "part_turns": 90}])
def test_nodes_equal_a_plain_restatement_whatever_the_shards(spark, talk, sizes):
    assert rows_of(spark, talk, **sizes) == plain(again(ordered(talk)))


def test_a_shard_walks_its_trie_by_bitsets():
    turn = lambda x: (x.encode() * 16, len(x))
    shard = T.Shard([3, 8, 9, 12], [[turn("a"), turn("b")], [turn("a")], [turn("a"), turn("b")], []])
    assert shard.postings[0][b"a" * 16] == 0b0111 and shard.postings[1][b"b" * 16] == 0b0101
    assert shard.ended == {2: 0b0101, 1: 0b0010, 0: 0b1000}
    nodes = shard.nodes()
    assert [(n[2], n[5], n[6], n[7], n[8], n[9]) for n in nodes] == [(0, 3, 4, 0, 3, "12"), (1, 3, 3, 1, 2, "8"), (2, 3, 2, 2, 1, "3,9")]
    assert nodes[1][1] == nodes[0][0] == T.ROOT and nodes[2][1] == nodes[1][0]


def test_a_list_of_ends_over_many_shards_is_hashed_in_order(spark):
    rows = [(c, 0, "user", "same") for c in range(0, 3000, 5)]
    kept = [c for c in range(0, 3000, 5)]
    got = rows_of(spark, rows, shard_convs=16, part_turns=100)
    assert got == plain(again(ordered(rows))) and len(got) <= 2
    assert sum(r[3] for r in got if r[1] == 0) == len(kept)


@pytest.mark.parametrize("rows", [
    [], [(None, 0, "user", "x")], [(0, None, None, None)], [(4, 0, "user", "x")],
    [(5, 1, "u", "b"), (5, None, "u", "a"), (5, 1, "u", "b"), (5, 1, "u", "a"), (6, 0, "u", "a"), (None, 0, "u", "a")],
    [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (7, 0, "", "abc"), (8, 0, None, "abc")],
    [(-7, 0, "u", "x"), (-5, 0, "u", "y"), (-3, 1, "u", "z"), (0, 0, "u", "y"), (2**62, 0, "u", "y")],
    [(10, t, "u", "long " * 2000) for t in range(40)] + [(11, t, "u", "long " * 2000) for t in range(40)],
])
def test_edge_cases(spark, rows):
    assert rows_of(spark, rows) == plain(again(ordered(rows)))

