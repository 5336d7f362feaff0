"""Embedding near-duplicates among vectors of several lengths."""

import numpy as np

from candela.llm.ship import prepared


def test_every_length_is_linked(spark):
    from candela.llm.embeddings import near_duplicates
    rng = np.random.default_rng(6)
    vectors = []
    for dim, n in ((16, 120), (8, 60), (5, 30), (2, 6), (1, 4), (3, 1)):
        x = rng.normal(size=(n, dim))
        vectors += [*x, *(x[: n // 2] + rng.normal(size=(n // 2, dim)) * 0.05), *x[:n // 6]]
    vectors = [np.asarray(v, np.float32) for v in vectors]
    ids = rng.permutation(9000)[: len(vectors)].tolist()
    df = prepared(spark).createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)],
                                         "vec_id long, embedding array<float>").repartition(3)
    u = [v.astype(float) / np.linalg.norm(v.astype(float)) for v in vectors]
    linked = [[b for b in range(len(u)) if a != b and len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.95] for a in range(len(u))]
    least = list(ids)
    while (after := [min([least[a], *(least[b] for b in linked[a])]) for a in range(len(u))]) != least:
        least = after
    want = {i: (len(linked[k]), least[k]) for k, i in enumerate(ids)}
    for options in ({"recall": 1.0}, {"recall": 1.0, "block": 8, "k": 3}):
        got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(df, **options).collect()}
        assert got == want
    alone = near_duplicates(prepared(spark).createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, 2.0])],
                                                            "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in alone) == [(1, 1, 1), (2, 0, 2), (3, 1, 1)]
