"""Prefix trie of conversations and tree contraction."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from coffer.llm import tries

from .conftest import words

TURN = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        # Names that the operator uses itself.
        *[T.StructField(n, T.StringType()) for n in ("conv", "depth", "number", "words", "k1", "_part", "saved")],
    ]
)


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c > 0 else -(abs(c) % 20))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        text = len(words(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * text + sum(saved[k] for k in kids[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if rebuilt[c] == node)))
        up = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), up, len(convs), len(kids[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def trie(spark, rows):
    frame = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], TURN)
    return sorted(map(tuple, tries.conversation_trie(frame).collect()), key=repr)


def talk(rng, c, turns):
    return [(c, t, ["user", "assistant"][t % 2], rng.choice(["hi", "yes it is", "", "so  what\n", "no"])) for t in range(turns)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(tries, "BLOCK", 4)


def test_trie(spark, small_blocks):
    rng = random.Random(1)
    rows = [r for c in range(130) for r in talk(rng, c, rng.randrange(0, 6))]
    # Odd ones: no id, no turn number, no role, no text, equal numbers, repeated rows, negative ids.
    rows += [(None, 0, "user", "lost"), (200, None, None, None), (200, None, "a", "x"), (200, 3, "a", None), (200, 3, "a", "b")]
    rows += [(201, 0, "user", "again")] * 3 + [(-20, 0, "user", "below"), (-20, 1, "user", "zero"), (-3, 0, "u", "v"), (-3, 5, "u", "w")]
    rows += talk(rng, 61, 200) + [(300, 0, "ab", "c"), (301, 0, "a", "bc"), (302, 0, "a", "long " * 200_000)]
    assert trie(spark, rows) == by_hand(rows)


def test_many_copies_of_one_conversation(spark, monkeypatch):
    """Ids that end at one node take several strings of several parts."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 60_000, 20) for t in range(2)]
    rows += [(1, 0, "user", "alone"), (3, 0, "user", "turn 0")]
    assert trie(spark, rows) == by_hand(rows)


def test_no_rows_and_no_turns(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "a", "b")]) == []
    # Without a first conversation of the family nothing is left of a short one.
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    assert trie(spark, [(short, 0, "a", "b")]) == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def contracted(spark, parents):
    """Totals of a tree given as parents by node; weights are the node's number."""
    depth = {0: 0}
    for v in range(1, len(parents)):
        depth[v] = depth[parents[v]] + 1
    up = [(v, depth[v], *((parents[v], depth[parents[v]]) if v else (None, None)), v) for v in range(len(parents))]
    tree = spark.createDataFrame(up, "conv bigint, depth bigint, up_conv bigint, up_depth bigint, w bigint")
    got = {r["conv"]: (r["kids"], r["leaves"], r["w"]) for r in tries.subtree_totals(tree, ["w"]).collect()}
    kids, leaves, total = [0] * len(parents), [0] * len(parents), list(range(len(parents)))
    for v in sorted(depth, key=depth.get, reverse=True):
        leaves[v] = leaves[v] or 1
        if v:
            p = parents[v]
            kids[p], leaves[p], total[p] = kids[p] + 1, leaves[p] + leaves[v], total[p] + total[v]
    assert got == {v: (kids[v], leaves[v], total[v]) for v in depth}


@pytest.mark.parametrize("shape", ["alone", "chain", "star", "comb", "random", "broom"])
def test_contraction(spark, shape):
    rng = random.Random(shape)
    parents = {
        "alone": [0],
        "chain": [0, *range(180)],
        "star": [0] * 200,
        "comb": [0] + [v - 1 if v % 2 else max(v - 2, 0) for v in range(1, 120)],
        "random": [0] + [rng.randrange(max(0, v - 6), v) for v in range(1, 400)],
        "broom": [0, *range(60), *[60] * 50],
    }[shape]
    contracted(spark, parents)


def test_rounds_of_a_chain_grow_with_its_logarithm(spark, monkeypatch):
    rounds = []
    real = tries.materialise
    monkeypatch.setattr(tries, "materialise", lambda df, name: rounds.append(name) or real(df, name))
    contracted(spark, [0, *range(300)])
    assert rounds.count("tree") <= 14


def test_no_two_neighbours_are_passed_over(spark):
    rows = spark.range(64).selectExpr("id AS depth").crossJoin(spark.range(64).selectExpr("id AS kid_depth"))
    rows = rows.filter("kid_depth > depth").selectExpr("*", "1 AS kids", "1 AS up_conv")
    for flipped in (False, True):
        found = [rows.filter(tries._passed_over(k, flipped)) for k in range(6)]
        for f in found:
            assert f.select("depth").distinct().join(f.selectExpr("kid_depth AS depth").distinct(), "depth").isEmpty()
    taken = [rows.filter(tries._passed_over(k, flipped)) for k in range(6) for flipped in (False, True)]
    every = taken[0]
    for t in taken[1:]:
        every = every.unionByName(t)
    assert every.distinct().count() == 64 * 63 // 2
