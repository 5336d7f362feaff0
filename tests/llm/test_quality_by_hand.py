"""The quality classifier's updates and scores against plain Python, number by number."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa

from candela.llm.quality import features, ftrl, score, train
from candela.llm.ship import prepared
from candela.llm.textops import utf8_column

ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1


def by_hand(rows, epochs):
    """Follow-the-regularised-leader (proximal), one coordinate after the other."""
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= L1:
            return 0.0
        return -(z[i] - math.copysign(L1, z[i])) / ((BETA + math.sqrt(n[i])) / ALPHA + L2)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            w = {i: weight(i) for i in at.tolist()}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at.tolist(), x.tolist()))))
            for i, v in zip(at.tolist(), x.tolist()):
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / ALPHA * w[i]
                n[i] += g * g
    return weight


def test_updates():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(64, 9, replace=False)), rng.random(9), float(k % 3 == 0)) for k in range(40)]
    got = ftrl(rows, 6, 3, ALPHA, BETA, L1, L2)
    weight = by_hand(rows, 3)
    assert np.allclose(got, [weight(i) for i in range(64)], atol=1e-6) and np.count_nonzero(got) > 30


def test_training_and_scores(spark):
    """One shard: weights are those of the updates over all labelled texts, scores the logistic of the sparse product."""
    texts = [("good plain words here " * (k % 4 + 1) if k % 2 else "%%% *** spam $$$ spam " * (k % 3 + 1)) + f" w{k}" for k in range(60)]
    bits = 12
    docs = prepared(spark).createDataFrame([(k, t) for k, t in enumerate(texts)] + [(60, None), (61, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, quality int")
    got = train(docs, labels, bits=bits, epochs=2)
    rows = []
    for k in range(50):
        _r, bucket = features(*utf8_column(pa.array([texts[k]])), bits)
        n = Counter(bucket.tolist())
        x = {b: np.float32(c / math.sqrt(len(bucket))) for b, c in n.items()}
        x.setdefault(0, np.float32(1.0))
        x[0] = np.float32(1.0) if 0 not in n else x[0]
        rows.append((np.array(sorted(x)), np.array([x[b] for b in sorted(x)], np.float32), float(k % 2)))
    weight = by_hand(rows, 2)
    assert np.allclose(got, [weight(i) for i in range(1 << bits)], atol=1e-5)
    scored = {r.doc_id: r.score for r in score(docs, got).collect()}
    for k in range(62):
        _r, bucket = features(*utf8_column(pa.array([texts[k] if k < 60 else ""])), bits)
        margin = sum(float(got[b]) for b in bucket.tolist()) / math.sqrt(max(1, len(bucket))) + float(got[0])
        assert abs(scored[k] - 1 / (1 + math.exp(-margin))) < 1e-6
    assert sum((scored[k] >= 0.5) == bool(k % 2) for k in range(50, 60)) == 10
