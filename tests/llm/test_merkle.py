"""Merkle manifest against a tree built in memory, at several sizes and with odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from candela.llm.merkle import manifest
from candela.llm.ship import prepared

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# leaf, root and idx clash with names of results and of stages
ROW = "doc_id {key}, source string, lang string, n_chars int, text string, leaf int, root string, idx int"


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def coded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows, fan):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][k:k + fan]) for k in range(0, len(levels[-1]), fan)])
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            a = i - i % fan
            yield level[a:i], level[i + 1:a + fan]
            i //= fan
    trees = {}
    for s, g in groups.items():
        g.sort(key=lambda r: ((r[0] is not None, r[0] if r[0] is not None else 0), sha(*map(coded, r))))
        trees[s] = tree([sha(*map(coded, r)) for r in g])
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    crown = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            siblings = [*path(trees[s], i), *path(crown, k)]
            seen = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                seen = (*r[:4], r[4].translate(LOW))
            folded = sha(*map(coded, seen))
            for a, b in siblings:
                folded = sha(*a, folded, *b)
            out.append((r[0], trees[s][0][i], trees[s][-1][0], crown[-1][0], sha(*[x for a, b in siblings for x in a + b]),
                        folded, folded == crown[-1][0]))
    return sorted(out, key=str)


def run(df, **options):
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = manifest(df, "doc_id", "source", FIELDS, {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")},
                   where, **options)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


def frame(spark, rows, key="long"):
    return prepared(spark).createDataFrame([(*r, 1, "x", 2) for r in rows], ROW.format(key=key)).repartition(5)


@pytest.mark.parametrize("fan,levels", [(2, 1), (3, 2), (16, 3)])
def test_manifest_equals_a_tree_in_memory(spark, fan, levels):
    """One source has half of all rows; others one, none, or a whole number of runs."""
    rng = random.Random(fan)
    sources = ["hot"] * 150 + ["Ä", None, "a", "aa", "b" * 40] * 10 + ["alone", "", "two", "two"] + [f"s{k}" for k in range(20)]
    rows = [(k * 7 % 1009, s, rng.choice(["en", None]), rng.choice([None, 3, 1000]),
             rng.choice([None, "", "Größe A", "x" * 3000, "ONE", "two"])) for k, s in enumerate(sources)]
    rows += [rows[3], rows[3], (None, "hot", None, None, "Null Id"), (None, "hot", None, None, None), (5, "hot", None, None, "tie")]
    assert run(frame(spark, rows), fan=fan, levels=levels) == brute(rows, fan)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257])
def test_runs_at_their_limits(spark, n):
    rows = [(k, "s", "en", k, "T") for k in range(n)]
    assert run(frame(spark, rows), levels=1) == brute(rows, 16)


def test_copies_of_one_row_and_text_ids(spark):
    rows = [("b", "s", "en", 1, "Same")] * 90 + [("é", "s", "en", 1, "Same"), (None, "s", None, None, None)]
    assert run(frame(spark, rows, "string"), fan=4, levels=2) == brute(rows, 4)


def test_no_rows(spark):
    assert run(frame(spark, [])) == []
