"""Toxicity: held-out accuracy, unseen misspellings, and the score by its definition."""

import random

import numpy as np
import pytest

from candela.llm import toxicity as X
from candela.llm.quality import held_out
from candela.llm.ship import prepared

ROW = "doc_id {key}, text string, score string, predicted string, label int"
RUDE = ["idiot", "worthless", "disgusting", "pathetic"]


def corpus(n=700, seed=1):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("bcdfglmnprstaeiou") for _ in range(rng.randint(2, 4))) for _ in range(60)]
    rows = []
    for k in range(n):
        words = [rng.choice(stems) + rng.choice(stems) for _ in range(rng.randint(10, 200))]
        toxic = k % 7 == 0
        if toxic:
            for _ in range(max(1, len(words) // 50)):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        rows.append((k, " ".join(words).capitalize() + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def model(spark, rows):
    return learn(spark, rows)


def frame(spark, rows, key="long"):
    return prepared(spark).createDataFrame([(i, t, "s", "p", 1) for i, t, _ in rows], ROW.format(key=key)).repartition(4)


def learn(spark, rows, key="long"):
    labels = prepared(spark).createDataFrame([(i, y) for i, _, y in rows], f"doc_id {key}, toxic int")
    return X.train(frame(spark, rows, key), labels.filter(~held_out()), bits=16, per_class=300)


def scores(spark, model, texts):
    got = X.score(frame(spark, [(k, t, 0) for k, t in enumerate(texts)]), model).collect()
    return [r.score for r in sorted(got, key=lambda r: r.doc_id)]


def test_held_out_texts(spark, rows, model):
    got = {r.doc_id: r for r in X.score(frame(spark, rows), model).select("doc_id", "score", "predicted", held_out().alias("h")).collect()}
    apart = [(got[i].predicted, y) for i, _, y in rows if got[i].h]
    assert len(apart) > 100 and sum(p == y for p, y in apart) / len(apart) > 0.98
    toxic = [p for p, y in apart if y]
    assert sum(toxic) / len(toxic) > 0.9
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got.values())


def test_misspellings_that_were_never_seen(spark, rows, model):
    """A text's toxic words in a new spelling score far above the text without them."""
    base = " ".join(rows[1][1].split()[:40])
    plain, spelled = scores(spark, model, [base, base + " idiiot worthlesss disgustting patheticc"])
    assert spelled > 0.3 > plain


def test_score_is_the_softmax_of_the_average(spark, rows, model):
    import pyarrow as pa

    from candela.llm.textops import utf8_column
    texts = [rows[0][1], rows[7][1], "", "idiot", "!!!", "IDIOT Idiot idiot", "größe " * 50 + "worthless"]
    want = []
    for t in texts:
        data, offsets = utf8_column(pa.array([t]))
        _row, _n, words, s, e = X.distinct_words(data, offsets)
        parts = [X.subwords(data, words[k:k + 1], s[k:k + 1], e[k:k + 1], model.bits)[1] for k in range(len(words))]
        want.append(model.probability(parts))
    assert np.allclose(scores(spark, model, texts), want, atol=1e-5)


def test_subwords_are_the_n_grams():
    data = np.frombuffer("xx Abcd".encode(), np.uint8)
    _, b = X.subwords(data, np.array([9], np.uint64), np.array([3]), np.array([7]), 20)
    assert len(b) == 1 + sum(6 - w + 1 for w in X.WIDTHS)
    low = np.frombuffer("abcd".encode(), np.uint8)
    assert np.array_equal(b, X.subwords(low, np.array([9], np.uint64), np.array([0]), np.array([4]), 20)[1])


def test_odd_rows(spark, model):
    texts = [(1, None, 0), (2, "", 0), (3, " \n!?", 0), (None, "idiot", 0), (4, "idiot " * 400_000, 0), (4, "idiot " * 400_000, 0)]
    out = X.score(frame(spark, texts), model)
    assert sorted(out.columns) == sorted(["doc_id", "text", "label", "score", "predicted"])
    got = [(r.doc_id, round(r.score, 6)) for r in out.collect()]
    s = dict(got)
    assert len(got) == 6 and s[1] == s[2] == s[3] < 0.3 and got.count((4, s[4])) == 2
    assert X.score(frame(spark, []), model).count() == 0


def test_without_labels_or_classes(spark, rows):
    docs = frame(spark, rows[:20])
    labels = lambda r: prepared(spark).createDataFrame(r, "doc_id long, toxic int")
    for given, want in (([], 0.5), ([(1, None)], 0.5), ([(k, 1) for k in range(8)], 0.9), ([(k, 0) for k in range(8)], 0.1),
                        ([(10_000, 1), (1, 0)], 0.5)):
        got = {round(r.score, 6) for r in X.score(docs, X.train(docs, labels(given), bits=12)).collect()}
        assert got == {want}, given
    mixed = labels([(0, 1), (0, 0), (0, 1), (1, 0), (1, None), (2, 0)])
    assert X.train(docs, mixed, bits=12, steps=2).bits == 12  # several labels of an id: their mean


def test_rows_of_one_id_teach_once(spark, rows):
    few = [(str(i), t, y) for i, t, y in rows[:60]]
    once, often = learn(spark, few, "string"), learn(spark, few + few[:1] * 50, "string")
    assert np.allclose(once.vectors, often.vectors) and np.allclose(once.weights, often.weights)
