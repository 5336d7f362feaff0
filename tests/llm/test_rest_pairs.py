"""Pairs of the rest join, which a document pair meets once and not at each shared shingle; components."""

import itertools

import pytest

from candela.llm import components as C
from candela.llm.jaccard import _rest_pairs

SCHEMA = "token long, rep long, n long, place int, component long, sketch array<long>"


def pairs(spark, sets, components=None):
    """The rows of the join for documents with these prefix tokens, in the global (unsigned) order."""
    rows = []
    for rep, tokens in sets.items():
        for place, token in enumerate(sorted(tokens, key=lambda t: t % (1 << 64))):
            rows.append((token, rep, 400, place, (components or {}).get(rep, rep), [0] * 16))
    return [tuple(r) for r in _rest_pairs(spark.createDataFrame(rows, SCHEMA), 75).collect()]


def test_a_pair_with_many_shared_tokens_is_one_row(spark):
    tokens = [*range(1, 41), *range(-40, 0)]  # classes above 31 make negative numbers
    got = pairs(spark, {rep: tokens for rep in range(20)})
    assert sorted(got) == sorted((a, b) for a, b in itertools.product(range(20), repeat=2) if a > b)


def test_no_pair_with_a_shared_token_is_lost(spark):
    common = [*range(100, 130), *range(-30, 0)]
    sets = {rep: [t for k, t in enumerate(common) if (k * 7 + rep * rep) % 5 >= 2] + [1000 + rep, -1000 - rep]
            for rep in range(12)}
    sets[50] = [129, 2000, 2001, 2002, 2003, 2004]  # only one token in common, after others of its own
    sets[51] = [5000]
    expected = {(a, b) for a, b in itertools.product(sets, repeat=2) if a > b and set(sets[a]) & set(sets[b])}
    got = pairs(spark, sets)
    assert set(got) == expected and len(got) < 2 * len(expected)


def test_repeated_rows_and_equal_components(spark):
    sets = {1: [5, 5, 6, 6, 7], 2: [5, 5, 6, 7, 7], 3: [6, 7, 9]}
    assert set(pairs(spark, sets)) == {(2, 1), (3, 1), (3, 2)}
    assert set(pairs(spark, sets, {1: 1, 2: 1, 3: 3})) == {(3, 1), (3, 2)}


@pytest.mark.parametrize("edges, rounds", [
    ([], 0), ([(2, 1), (3, 1), (5, 4), (4, 4)], 0), ([(1, 2), (2, 1)], 0),
    ([(k, k + 1) for k in range(40)], None), ([(7, 1), (7, 2), (9, 2), (9, 8), (20, 21)], None)])
def test_components_take_no_round_after_the_last(spark, monkeypatch, edges, rounds):
    done, star = [], C._small_star
    monkeypatch.setattr(C, "_small_star", lambda e: done.append(1) or star(e))
    got = {r[0]: r[1] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {x: m for x, m in least.items() if x != m}
    assert rounds is None or len(done) == rounds
