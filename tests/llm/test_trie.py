"""Elias-Fano sequences and the trie against sorted arrays."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegate.llm import trie


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=300),
       st.lists(st.integers(0, 1 << 41), min_size=1, max_size=50))
def test_monotone(values, asked):
    values = np.sort(np.array(values, np.int64))
    s = trie.Monotone.of(values)
    assert s.get(np.arange(len(values))).tolist() == values.tolist()
    x = np.array(asked + values[:20].tolist(), np.int64)
    assert s.successor(x).tolist() == np.searchsorted(values, x).tolist()


@pytest.mark.parametrize("values", [[0], [0] * 500, [5] * 3, list(range(2000)),
                                    [0] * 100 + [1 << 45], [1 << 45] * 200])
def test_monotone_extremes(values):
    values = np.array(values, np.int64)
    s = trie.Monotone.of(values)
    assert (s.get(np.arange(len(values))) == values).all()
    x = np.array([0, 1, 4, 5, 6, 1 << 44, 1 << 45, (1 << 45) + 1])
    assert (s.successor(x) == np.searchsorted(values, x)).all()


def test_sequences_are_compact():
    rng = np.random.default_rng(0)
    values = np.sort(rng.integers(0, 1 << 30, 100_000))
    s = trie.Monotone.of(values)
    bits = 8 * sum(a.nbytes for a in s.arrays())
    assert bits / len(values) < 30 - 16 + 6


def test_trie_finds_every_pair_and_no_other():
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 400, (5000, 2)) ** 2, axis=0)
    pairs = pairs[pairs[:, 0] % 7 != 3]
    u, v = pairs.T
    contexts = np.unique(u)
    built = trie.mapped(trie.build(u, v, np.arange(len(contexts)), np.arange(len(u)) % 60000))
    at, place = built.find(u, v)
    assert (place == np.arange(len(u))).all() and (contexts[at] == u).all()
    known = set(map(tuple, pairs.tolist()))
    asked = rng.integers(0, 170000, (4000, 2))
    asked[:2000] = pairs[rng.integers(0, len(pairs), 2000)] + rng.integers(0, 2, (2000, 2))
    at, place = built.find(asked[:, 0], asked[:, 1])
    assert ((place >= 0) == [tuple(p) in known for p in asked.tolist()]).all()
    assert ((at >= 0) == np.isin(asked[:, 0], contexts)).all()


def test_empty_trie():
    none = np.zeros(0, np.int64)
    built = trie.mapped(trie.build(none, none, none, none))
    assert [x.tolist() for x in built.find(np.array([0, 5]), np.array([1, 1]))] == [[-1, -1]] * 2
