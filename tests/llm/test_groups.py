"""Near duplicates, components and line windows against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import types as T

from coffer.llm import embeddings, jaccard, lines
from coffer.llm.components import connected_components

from .conftest import ODD, prose, words


def roots(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 150)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = dict(map(tuple, connected_components(frame, "a", "b").collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 150, 150: 150}
    assert connected_components(frame.filter("a = b"), "a", "b").count() == 0


VECTOR = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute_vectors(rows):
    unit = []
    for i, v in rows:
        ok = v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x = np.array(v, dtype=np.float32).astype(float) if ok else None
        unit.append(None if x is None else x / np.linalg.norm(x))
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9
    ]
    return links


@pytest.mark.parametrize("block", [2048, 16])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    near = base[:12].repeat(8, axis=0) + rng.standard_normal((96, 16)) * 0.12
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] + [1.0] * 15), (2004, [1e38] * 16)]
    rows += [(2005, [None] + [1.0] * 15), (2006, [1.0] * 15), (2007, [3e-39] * 16), (2008, [float("inf")] * 16)]
    links = brute_vectors(rows)
    part = roots(len(rows), links)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame(rows, VECTOR)).collect()}
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert got[i]["n_links"] == sum(k in pair for pair in links), i
        assert got[i]["component_id"] == min(rows[j][0] for j in range(len(rows)) if part[j] == part[k])
        assert got[i]["kept"] == (got[i]["component_id"] == i)


def test_near_vectors_of_nothing_and_without_ids(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], VECTOR)).count() == 0
    rows = [(None, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [0.0, 1.0])]
    got = [tuple(r) for r in embeddings.near_vectors(spark.createDataFrame(rows, VECTOR)).collect()]
    assert sorted(got, key=repr) == sorted([(None, 1, 5, False), (5, 1, 5, True), (None, 0, None, False)], key=repr)


def brute_jaccard(rows):
    sets = []
    for _, text, *_ in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    pairs = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return sets, roots(len(rows), pairs)


def edited(rng, text, share):
    w = text.split(" ")
    for i in rng.choice(len(w), max(1, int(len(w) * share)), replace=False):
        w[i] = f"new{rng.integers(1 << 30)}"
    return " ".join(w)


def test_similar_documents(documents):
    rng = np.random.default_rng(8)
    rows = []
    for k in range(25):
        text = prose(rng, int(rng.integers(4, 300)))
        rows.append((len(rows), text, "en", "src0"))
        for share in (0.0, 0.005, 0.01, 0.02, 0.03, 0.04, 0.05, 0.1):
            rows.append((len(rows), edited(rng, text, share) if share else text.upper(), "en", "src0"))
    # A chain: each text a little further from the first.
    chain = prose(rng, 200)
    for _ in range(12):
        rows.append((len(rows), chain, "en", "src1"))
        chain = edited(rng, chain, 0.02)
    # Texts that share most of their words, in groups that do not link with each other.
    passage = prose(rng, 40)
    rows += [(len(rows) + i, passage + " " + prose(rng, 22), "en", "src1") for i in range(40)]
    rows += [r for r in ODD if r[0] is not None and r[0] != 9010]
    sets, part = brute_jaccard(rows)
    got = {r["doc_id"]: r for r in jaccard.similar_documents(documents(rows)).collect()}
    for k, row in enumerate(rows):
        assert got[row[0]]["n_shingles"] == len(sets[k])
        assert got[row[0]]["component_id"] == min(rows[j][0] for j in range(len(rows)) if part[j] == part[k]), row[0]


def test_similar_documents_of_odd_rows(documents):
    got = sorted((tuple(r) for r in jaccard.similar_documents(documents(ODD)).collect()), key=repr)
    assert len(got) == len(ODD)
    assert (None, 3, 9007) in got and got.count((9010, 1, 9010)) == 2
    assert jaccard.similar_documents(documents([])).count() == 0


def brute_lines(rows):
    out, seen = {}, {}
    for doc_id, text in sorted(rows):
        parts = text.split("\n")
        full = [k for k, x in enumerate(parts) if words(x)]
        gone = set()
        for j in range(len(full) - 2):
            w = tuple(parts[full[j + k]] for k in range(3))
            if seen.setdefault(w, (doc_id, j)) != (doc_id, j):
                gone |= {full[j], full[j + 1], full[j + 2]}
        out[doc_id] = (len(full), len(gone), "\n".join(x for k, x in enumerate(parts) if k not in gone))
    return out


def test_line_dedup(documents):
    rng = np.random.default_rng(4)
    pool = [prose(rng, 6) for _ in range(12)] + ["", "  "]
    rows = [(i, "\n".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 14)))) for i in range(80)]
    rows.append((500, "\n".join(["again and again"] * 9)))
    got = {r["doc_id"]: tuple(r)[1:] for r in lines.line_dedup(documents([(i, t, "en", "s") for i, t in rows])).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_of_odd_rows(documents):
    twice = (9500, "a\nb\nc\nd", "en", "s")
    got = [tuple(r) for r in lines.line_dedup(documents([*ODD, twice, twice, (None, "b\nc\nd", "en", "s")])).collect()]
    assert len(got) == len(ODD) + 3
    assert got.count((9500, 4, 3, "a")) == 2  # the row without an id comes first
    assert (9001, 0, 0, None) in got and (9002, 0, 0, "") in got and (9011, 0, 0, "\n\n\n") in got
    assert lines.line_dedup(documents([])).count() == 0


def test_signatures_with_equal_members_are_one(spark):
    rows = [(sig, i) for sig, members in enumerate([(1, 2, 3), (1, 2), (1, 2, 3), (2, 3), (1, 2)]) for i in members]
    frame = spark.createDataFrame(rows, "sig bigint, id bigint")
    kept = jaccard._distinct_groups(frame).collect()
    assert sorted(map(tuple, kept)) == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (3, 2), (3, 3)]
