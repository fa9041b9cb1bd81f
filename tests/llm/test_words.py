"""Counts and hashes of text batches against plain Python."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coffer.llm.jaccard import band_plan, parities, shingle_sets, signatures
from coffer.llm.words import slices, text_stats

from .conftest import words

TEXTS = st.lists(st.text(st.sampled_from("ab A#\n\t\r é漢\x1c"), max_size=60), max_size=8)


def plain(text):
    w = words(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    full = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(full) - len(set(full)),
        "n_repeat_words": len(covered),
        "n_distinct": len(set(w)),
        "n_top": max(Counter(w).values(), default=0),
        "n_echo": sum(a == b for a, b in zip(w, w[1:])),
        "n_lines": len(full),
    }


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_counts(texts, limit):
    got = [text_stats(t) for t in slices(pa.array(texts, pa.string()), limit)]
    for i, text in enumerate(texts):
        for name, value in plain(text).items():
            assert np.concatenate([g[name] for g in got])[i] == value, (name, text)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_shingle_sets(texts):
    for t in slices(pa.array(texts, pa.string())):
        sets, owner = shingle_sets(t, 5)
        for i, text in enumerate(texts):
            w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            want = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
            assert (owner == i).sum() == len(want)
            assert len(set(sets[owner == i])) == len(want)


def test_null_and_offset_slices():
    array = pa.array(["no", "a b", None, "c"], pa.string()).slice(1)
    assert np.concatenate([text_stats(t)["n_words"] for t in slices(array)]).tolist() == [2, 0, 1]


@pytest.mark.parametrize("size", [5, 6, 7, 9, 12, 20, 33, 60, 121, 250, 700, 3000])
def test_sets_at_the_limit_share_a_signature(size):
    """Pairs that are just similar enough, of equal and of unequal sizes."""
    plan = band_plan(80)
    rng = np.random.default_rng(size)
    for trial in range(60 if size < 500 else 6):
        both = size - int(rng.integers(0, size // 9 + 1))
        more = [max(0, int(both / 0.8) - both), 0]
        left = int(rng.integers(0, more[0] + 1))
        right = max(0, int(both / 0.8) - both - left)
        values = rng.integers(0, 1 << 63, both + left + right, dtype=np.uint64)
        a, b = values[: both + left], np.concatenate([values[:both], values[both + left :]])
        assert 100 * both >= 80 * len(values)
        odd = parities(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2).view(np.uint64)
        assert np.bitwise_count(odd[0] ^ odd[1]).sum() <= left + right
        if left or right:
            assert set(signatures(np.sort(a), 80, plan)) & set(signatures(np.sort(b), 80, plan))


def test_unrelated_sets_share_none():
    plan = band_plan(80)
    rng = np.random.default_rng(5)
    seen = Counter()
    for _ in range(300):
        seen.update(set(signatures(rng.integers(0, 1 << 63, 90, dtype=np.uint64), 80, plan)))
    assert max(seen.values()) == 1


@pytest.mark.parametrize("size", [300, 2585, 2600, 6313, 9865, 37635])
def test_small_sets_of_a_band_have_full_partitions_too(size):
    """The least sizes of bands fill fewest partitions; a second deal is enough, and none is shared by all."""
    plan = band_plan(80)
    rng = np.random.default_rng(size)
    sets = [np.sort(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(4)]
    made = [signatures(s, 80, plan) for s in sets]
    assert all(len(m) < 1.7 * size for m in made)
    assert len(set().union(*map(set, made))) == sum(len(set(m)) for m in made)
    near = np.concatenate([sets[0][size // 10 :], rng.integers(0, 1 << 63, size // 10, dtype=np.uint64)])
    assert set(signatures(np.sort(near), 80, plan)) & set(made[0])
