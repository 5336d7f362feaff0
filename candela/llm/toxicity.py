"""Toxicity: averaged subword vectors and a linear softmax, trained jointly in numpy.

A word (run of ASCII letters, digits and bytes from 128 on; A-Z lower-cased) has
as subwords itself and its byte n-grams of 3 to 6, with both ends of the word
marked. Each subword hashes to one of ``2**bits`` vectors; a word is the
average of its subwords' vectors, and a text the weighted average of its
distinct words. The softmax over two classes is linear in that average. A
misspelling that was never seen shares most n-grams, and so most of its vector,
with the spelling that was.

Weights: a subword counts by ``|log odds| ** power`` of the training texts of
the two classes that have it (add-one smoothing), so function words and unseen
n-grams add next to nothing. In training, a text is left out of the counts that
weigh its own subwords; otherwise words of a single text would look telling.
``neutral`` is added to the sum of weights, so that a text in which nothing
tells is near the zero vector.

Training: at most ``per_class`` rows of each label, those with the smallest
hashes of their ids (one row for each id, the least text): a bounded sample,
spread evenly whatever the order of the table. One task follows the gradient
of both vectors and softmax. Classes weigh the same there; their true shares,
counted over all labels, return in the bias, so that scores are probabilities.

The model is broadcast folded: two 4-byte numbers a subword, 8 MB at 20 bits.
Scoring is a map over whole texts without a shuffle. It equals averaging the
vectors and applying the softmax (:meth:`Model.probability`), since both are
linear.

Null and empty texts, and texts without a word, have the bias only. Null labels
and labels without a document teach nothing; if an id has several labels their
mean decides. Without any label all scores are 0.5; where all labels agree,
scores are the smoothed share of that label. Repeated rows are scored one by
one. Input columns named like the added ones are replaced. Very long texts are
read in pieces cut between words, subwords made for 32,768 words at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.textops import (_BYTE_VALUE, cut_at_non_word, hash_windows, lower_ascii, map_batches, slices,
                                 utf8_column, words_of)

IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True
_CUT = cut_at_non_word(IS_WORD)
_FOLD = lower_ascii()
WIDTHS = (3, 4, 5, 6)
BLOCK_WORDS = 32_768
_BEGIN, _END = 1, 2  # no byte of a word


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray   # 2**bits x size
    softmax: np.ndarray   # size x 2
    bias: np.ndarray      # 2
    weights: np.ndarray   # 2**bits
    neutral: float

    @property
    def bits(self) -> int:
        return int(len(self.weights)).bit_length() - 1

    def folded(self) -> tuple[np.ndarray, np.ndarray, float, float]:
        """(weights, weights times what a subword adds to the logit, bias, neutral)."""
        logit = self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])
        return (self.weights.astype(np.float32), (self.weights * logit).astype(np.float32),
                float(self.bias[1] - self.bias[0]), self.neutral)

    def probability(self, words: list[np.ndarray]) -> float:
        """Score of one text from its distinct words' subword buckets, as the definition says it."""
        mean, total = np.zeros(self.vectors.shape[1]), self.neutral
        for buckets in words:
            w = self.weights[buckets].astype(np.float64)
            mean += (w[:, None] * self.vectors[buckets]).mean(axis=0)
            total += w.mean()
        z = mean / total @ self.softmax + self.bias
        e = np.exp(z - z.max())
        return float(e[1] / e.sum())


def distinct_words(data, offsets):
    """(row, word number) of each row's distinct words, and the words' hashes, byte starts and ends."""
    h, r, s, e = words_of(data, offsets, IS_WORD, fold=_FOLD, cut=_CUT)
    if not len(h):
        z = np.zeros(0, np.int64)
        return z, z, h, z, z
    words, first, number = np.unique(h, return_index=True, return_inverse=True)
    pairs = np.unique(r * np.int64(len(words)) + number)
    return pairs // len(words), pairs % len(words), words, s[first], e[first]


def subwords(data, words, starts, ends, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of the words' subwords, repeated ones included."""
    shift = np.uint64(64 - bits)
    numbers, buckets = [np.arange(len(words))], [(words >> shift).astype(np.int64)]
    lengths = ends - starts + 2
    at = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    inside = np.arange(len(word)) - at[word]
    text = _FOLD[data[np.clip(starts[word] + inside - 1, 0, len(data) - 1)]]
    text[at], text[at + lengths - 1] = _BEGIN, _END
    values = _BYTE_VALUE[text]
    for width in WIDTHS:
        grams = hash_windows(values, width)
        if len(grams):
            whole = word[:len(grams)] == word[width - 1:]
            numbers.append(word[:len(grams)][whole])
            buckets.append((grams[whole] >> shift).astype(np.int64))
    return np.concatenate(numbers), np.concatenate(buckets)


def text_features(data, offsets, rows: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row: its subwords' buckets and how much of a word each stands for (1 / subwords of the word, summed)."""
    row, number, words, s, e = distinct_words(data, offsets)
    edges = np.searchsorted(row, np.arange(rows + 1))
    out = []
    for k in range(rows):
        mine = number[edges[k]:edges[k + 1]]
        found, parts = np.zeros(0, np.int64), np.zeros(0)
        for a in range(0, len(mine), BLOCK_WORDS):
            w = mine[a:a + BLOCK_WORDS]
            n, b = subwords(data, words[w], s[w], e[w], bits)
            part = 1.0 / np.bincount(n)[n]
            found, where = np.unique(np.concatenate([found, b]), return_inverse=True)
            parts = np.bincount(where, np.concatenate([parts, part]), minlength=len(found))
        out.append((found.astype(np.int32), parts.astype(np.float32)))
    return out


def telling(with_1, with_0, n_1, n_0, power: float) -> np.ndarray:
    """``|log odds| ** power`` of a subword that so many of the texts of each class have."""
    return np.abs(np.log((with_1 + 1) / (n_1 + 2)) - np.log((with_0 + 1) / (n_0 + 2))) ** power


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int, *, size: int, steps: int,
        rate: float, momentum: float, scale: float, power: float, neutral: float) -> Model:
    """Joint gradient steps for vectors and softmax over all texts; the classes weigh the same."""
    n_1 = int(labels.sum())
    n_0 = len(labels) - n_1
    row = np.repeat(np.arange(len(texts)), [len(b) for b, _ in texts])
    bucket = np.concatenate([b for b, _ in texts]) if texts else np.zeros(0, np.int32)
    x = np.concatenate([p for _, p in texts]) if texts else np.zeros(0, np.float32)
    of_1 = labels[row] == 1
    with_1 = np.bincount(bucket[of_1], minlength=1 << bits)
    with_0 = np.bincount(bucket[~of_1], minlength=1 << bits)
    weights = np.where(with_1 + with_0 > 0, telling(with_1, with_0, n_1, n_0, power), 0.0).astype(np.float32)
    own = telling(with_1[bucket] - of_1, with_0[bucket] - ~of_1, n_1 - of_1, n_0 - ~of_1, power) * x
    keep = own > 1e-4
    row, bucket, own = row[keep], bucket[keep], own[keep]
    total = np.bincount(row, own, minlength=len(texts)) + neutral
    x = (own / total[row] * scale).astype(np.float32)
    used, place = np.unique(bucket, return_inverse=True)

    start = np.random.default_rng(11)
    vectors = (start.random((len(used), size)) - 0.5) * 1e-3
    softmax = np.zeros((size, 2))
    softmax[:, 1] = np.where(np.arange(size) % 2 == 0, 0.5, -0.5)
    softmax[:, 0] = -softmax[:, 1]
    bias = np.zeros(2)
    moved = [np.zeros_like(vectors), np.zeros_like(softmax), np.zeros_like(bias)]
    share = np.where(labels == 1, 0.5 / max(n_1, 1), 0.5 / max(n_0, 1))[:, None]
    truth = np.stack([1 - labels, labels], axis=1)
    for step in range(steps):
        h = np.stack([np.bincount(row, vectors[place, k] * x, minlength=len(texts)) for k in range(size)], axis=1)
        z = h @ softmax + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        slope = (p / p.sum(axis=1, keepdims=True) - truth) * share
        back = slope @ softmax.T
        slopes = [np.stack([np.bincount(place, back[row, k] * x, minlength=len(used)) for k in range(size)], axis=1),
                  h.T @ slope / scale, slope.sum(axis=0) / scale]
        for value, move, g in zip((vectors, softmax, bias), moved, slopes):
            move *= momentum
            move -= rate * (1 - step / steps) * g
            value += move
    whole = np.zeros((1 << bits, size), np.float32)
    whole[used] = vectors * scale
    return Model(whole, softmax.astype(np.float32), bias, weights, neutral)


def _constant(share: float, neutral: float) -> Model:
    bias = np.log(np.array([1 - share, share]))
    return Model(np.zeros((16, 1), np.float32), np.zeros((1, 2), np.float32), bias, np.zeros(16, np.float32), neutral)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id",
          bits: int = 20, per_class: int = 1024, size: int = 4, steps: int = 50, rate: float = 2.0,
          momentum: float = 0.9, scale: float = 20.0, power: float = 2.5, neutral: float = 10.0) -> Model:
    """The model. ``labels`` holds only rows that may be learned from."""
    judged = (labels.select(F.col(key).alias("key"), F.col(label).alias("label")).dropna()
              .groupBy("key").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    counts = {r.label: r.n for r in judged.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_1, n_0 = counts.get(1, 0), counts.get(0, 0)
    if not n_1 or not n_0:
        return _constant((n_1 + 1) / (n_1 + n_0 + 2), neutral)
    order = [F.xxhash64("key"), F.col("key")]
    picked = [judged.filter(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    picked = picked[0].unionByName(picked[1]).collect()  # at most 2 * per_class pairs
    spark = docs.sparkSession
    chosen = spark.createDataFrame(pd.DataFrame([tuple(r) for r in picked], columns=["key", "label"]), judged.schema)
    rows = (docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text")))

    def count(batches):
        for whole in batches:
            for batch in slices(whole, 2):
                found = text_features(*utf8_column(batch.column(2)), batch.num_rows, bits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([b.tobytes() for b, _ in found], pa.binary()),
                     pa.array([p.tobytes() for _, p in found], pa.binary())], names=["key", "label", "buckets", "parts"])
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key {kind}, label int, buckets binary, parts binary")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable")
        texts = [(np.frombuffer(b, np.int32), np.frombuffer(p, np.float32)) for b, p in zip(group.buckets, group.parts)]
        m = fit(texts, group.label.to_numpy(), bits, size=size, steps=steps, rate=rate, momentum=momentum, scale=scale,
                power=power, neutral=neutral)
        at = np.flatnonzero(m.weights).astype(np.int32)
        return pd.DataFrame({"at": [at.tobytes()], "vectors": [m.vectors[at].tobytes()], "weights": [m.weights[at].tobytes()],
                             "softmax": [m.softmax.tobytes()], "bias": [m.bias.tobytes()], "both": [group.label.nunique() == 2]})
    learned = (counted.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(
        learn, "at binary, vectors binary, weights binary, softmax binary, bias binary, both boolean").first())
    if learned is None or not learned.both:
        return _constant((n_1 + 1) / (n_1 + n_0 + 2), neutral)
    at = np.frombuffer(learned.at, np.int32)
    vectors, weights = np.zeros((1 << bits, size), np.float32), np.zeros(1 << bits, np.float32)
    vectors[at] = np.frombuffer(learned.vectors, np.float32).reshape(-1, size)
    weights[at] = np.frombuffer(learned.weights, np.float32)
    bias = np.frombuffer(learned.bias, np.float64) + np.log(np.array([n_0, n_1]) / (n_0 + n_1))
    return Model(vectors, np.frombuffer(learned.softmax, np.float32).reshape(size, 2), bias, weights, neutral)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (0 to 1, higher: more toxic) and predicted (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.folded())
    bits, column = model.bits, docs.columns.index(text)

    def judge(batch):
        weights, logits, bias, neutral = shared.value
        data, offsets = utf8_column(batch.column(column))
        row, number, words, s, e = distinct_words(data, offsets)
        weight, logit = np.zeros(len(words)), np.zeros(len(words))
        for a in range(0, len(words), BLOCK_WORDS):
            part = slice(a, a + BLOCK_WORDS)
            n, b = subwords(data, words[part], s[part], e[part], bits)
            many = np.bincount(n)
            weight[part], logit[part] = np.bincount(n, weights[b]) / many, np.bincount(n, logits[b]) / many
        total = np.bincount(row, weight[number], minlength=batch.num_rows) + neutral
        margin = np.bincount(row, logit[number], minlength=batch.num_rows) / total + bias
        p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        return [p, (p >= threshold).astype(np.int32)]
    return map_batches(docs, judge, [("score", "double"), ("predicted", "int")], text)
