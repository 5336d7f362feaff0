"""The n-gram Jaccard join on ids that have several rows with different texts."""

import random

import pytest

from candela.llm.ship import prepared


def brute_force(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        s = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        sets.setdefault(i, []).append(s)
    up = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and any(x and 4 * len(x & y) >= 3 * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((up[a], up[b]))
                up = {i: lo if c == hi else c for i, c in up.items()}
    return sorted((i, len(s), up[i]) for i, own in sets.items() for s in own)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_jaccard_of_one_id_with_two_texts(spark, kind):
    from candela.llm.jaccard import link_documents
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    made = []
    for k in range(6):  # each id holds a long and a short text, and others resemble or equal one of them
        long, short = text(150 + k), text(20)
        made += [(10 * k + 5, long), (10 * k + 5, short), (10 * k + 3, f"{long} end"), (10 * k + 7, f"{short} end"),
                 (10 * k + 8, short)]
    made += [(80, made[0][1]), (80, ""), (80, text(30)), (81, None), (81, made[5][1]), (90, text(30)), (90, text(30)),
             (91, "a b"), (91, "a b"), (95, None), (95, "")]
    rows = [(k, t) if kind == "long" else (f"d{k}", t) for k, t in made]
    schema = f"doc_id {kind}, text string"
    got = link_documents(prepared(spark).createDataFrame([*rows, (None, text(9))], schema).repartition(3)).collect()
    assert len(got) == len(rows) + 1
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == brute_force(rows)
