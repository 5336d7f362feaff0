"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from candela.llm.ship import prepared
from candela.llm.spelling import choose_pivots, count_words, gram_keys, group_variants

LETTERS = "abcdeéßÿ×"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        near = [o for o in counts if one_edit(w, o)]
        best = min(near, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        out[w] = [form, n, len(near), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].insert(1, root)
    return {w: tuple(v) for w, v in out.items()}


def found(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def variants(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(LETTERS) + word[i:], word[:i] + rng.choice(LETTERS) + word[i + 1:]])


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abc", 2), (LETTERS, 3), ("a", 4)])
def test_near_words_equal_all_pairs(spark, letters, seed):
    """Few letters: bigrams repeat in a word, and nearly all words are near others."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(120)}
    for w in list(words)[:60]:
        for _ in range(4):
            v = variants(rng, w)
            words |= {v} if len(v) >= 6 else set()
    words |= {"a" * k for k in range(6, 12)} | {"a" * 400, "a" * 401, "a" * 399 + "b"}
    counts = {w: rng.choice([5, 6, 25, 30, 150, 800, 4000]) for w in words}
    df = prepared(spark).createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert found(group_variants(df)) == brute(counts)


def test_chains_of_forms_end_at_the_root(spark):
    chain = ["aaaaaa" + "b" * k for k in range(9)]
    counts = {w: 5 ** (k + 1) for k, w in enumerate(chain)}
    df = prepared(spark).createDataFrame(list(counts.items()), "word string, n long")
    got = found(group_variants(df))
    assert got == brute(counts) and {v[1] for v in got.values()} == {chain[-1]}


def test_one_edit_leaves_a_common_key():
    rng = random.Random(5)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(4, 9)))
        b = variants(rng, a)
        shared = [(i, j) for i in range(len(a) - 1) for j in range(len(b) - 1) if a[i:i + 2] == b[j:j + 2]]
        if not one_edit(a, b) or not shared:
            continue
        near = [(i, j) for i, j in shared if i == j and one_edit(a[i + 2:], b[j + 2:]) and a[:i] == b[:j]
                or a[i:] == b[j:] and one_edit(a[:i], b[:j])]
        for i, j in near:
            assert set(gram_keys(a, i)) & set(gram_keys(b, j)), (a, b, i, j)


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(6)
    for _ in range(500):
        prefix = [((rng.randint(1, 9), "xy"), i) for i in rng.sample(range(9), rng.randint(3, 6))]
        pairs = [(p, q) for p in prefix for q in prefix if q[1] - p[1] >= 2]
        got = choose_pivots(prefix)
        assert got[1][1] - got[0][1] >= 2
        assert sum(g[0][0] for g in got) == min(p[0][0] + q[0][0] for p, q in pairs)


ROW = "doc_id long, text string, word string, n int"


def test_word_counts(spark):
    rng = random.Random(7)
    words = ["größer", "Straße", "élan", "don't", "12abcdefg34", "ABCDEF", "abcdef", "÷×÷×÷×", "中文abcdefg中", "x" * 100, "naïveté"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for k in range(150)]
    rows += [(None, "abcdef " * 9), (7, None), (8, ""), (9, "abcdef" + "-" * 5), (10, "é" * 3000), (11, "中" * 400_000 + "abcdefgh" + "中" * 400_000),
             (12, "y" * 70 + " " + "abcdef " * 300_000), rows[3], rows[3]]
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 7 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    df = prepared(spark).createDataFrame([(*r, "w", 1) for r in rows], ROW).repartition(6)
    got = count_words(df, slips=7)
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert count_words(df, min_length=4, min_count=1).filter("word = 'élan'").count() == 1


def test_no_words(spark):
    empty = prepared(spark).createDataFrame([], ROW)
    assert found(group_variants(count_words(empty))) == {}
    assert found(group_variants(prepared(spark).createDataFrame([("abcdef", 5)], "word string, n long"))) == {
        "abcdef": (None, "abcdef", 5, 0, None)}
