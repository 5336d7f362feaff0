"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Features of a text are counts, in ``2**bits`` buckets, of its words (runs of
bytes above 32, case kept), its word pairs, and the same for word shapes (kind
of the first two bytes, last byte, length class); a pair of equal words has a
bucket of its own. Counts are divided by the root of the number of features.

Training: at most ``max_rows`` labelled rows, those with the smallest hashes
of their doc_id (a bounded sample, spread evenly whatever the order of the
table). Each shard of at least ``shard_rows`` rows runs the
follow-the-regularised-leader (proximal) updates in a random order; the
shards' weights are averaged. Weights are 4 bytes a bucket (1 MB) and are
broadcast. Scoring is a sparse dot product for each document in map tasks,
without a shuffle.

Null and empty texts have the bias only. Labels that are null are not used;
if a doc_id has several labels their mean decides. Without any label all
scores are 0.5. Repeated rows are scored one by one. Input columns named like
the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.textops import _BASE, _M1, cut_at_non_word, map_batches, mix, slices, utf8_column, words_of

IS_WORD = np.arange(256) > 32
_CUT = cut_at_non_word(IS_WORD)
_KIND = np.full(256, 1, np.uint64)  # signs; then digits, upper, lower and other letters
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 2, 3, 4, 4
_SAME = np.uint64(0xA0761D6478BD642F)


def _pairs(h: np.ndarray, inside: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        p = mix(h[:-1] * _BASE + h[1:])
    p[h[:-1] == h[1:]] = _SAME
    return p[inside]


def features(data, offsets, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each n-gram; bucket 0 is the bias."""
    h, r, s, e = words_of(data, offsets, IS_WORD, cut=_CUT)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    second = np.where(e - s > 1, _KIND[data[np.minimum(s + 1, len(data) - 1)]], np.uint64(0))
    last = data[e - 1]
    size = np.minimum(np.log2(e - s).astype(np.uint64), np.uint64(6))
    end = np.where(_KIND[last] == 1, last.astype(np.uint64), _KIND[last])
    shape = ((_KIND[data[s]] * np.uint64(8) + second) * np.uint64(256) + end) * np.uint64(8) + size
    with np.errstate(over="ignore"):
        shape = mix(shape * _M1 + np.uint64(1))
    inside = r[1:] == r[:-1]
    later = r[1:][inside]
    rows = np.concatenate([r, later, r, later])
    grams = np.concatenate([h, _pairs(h, inside), shape, _pairs(shape, inside) ^ np.uint64(5)])
    return rows, (mix(grams) >> np.uint64(64 - bits)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], bits: int, epochs: int, alpha: float,
         beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights after the proximal updates over ``(buckets, values, label)`` rows."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(1 << bits)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text",
          key: str = "doc_id", bits: int = 18, max_rows: int = 8192, shard_rows: int = 1024,
          epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02,
          l2: float = 0.1) -> np.ndarray:
    """The weights (``2**bits`` float32). ``labels`` holds only rows that may be learned from."""
    chosen = (labels.select(F.col(key).alias("key"), F.col(label).alias("label"))
              .dropna().groupBy("key").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
              .orderBy(F.xxhash64("key"), "key").limit(max_rows))
    picked = chosen.collect()  # at most max_rows pairs of numbers
    if not picked:
        return np.zeros(1 << bits, np.float32)
    spark = docs.sparkSession
    chosen = spark.createDataFrame(pd.DataFrame([tuple(x) for x in picked], columns=["key", "label"]),
                                   chosen.schema)
    rows = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "key").select("key", "label", "text"))
    shards = max(1, min(8, len(picked) // shard_rows))

    def count(batches):
        for whole in batches:
            for batch in slices(whole, 2):
                r, bucket = features(*utf8_column(batch.column(2)), bits)
                both, n = np.unique((r << bits) + bucket, return_counts=True)
                row, bucket = both >> bits, (both & ((1 << bits) - 1)).astype(np.int32)
                ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
                total = np.bincount(row, n, minlength=batch.num_rows)
                value = (n / np.sqrt(np.maximum(total, 1))[row]).astype(np.float32)
                pack = [[x[ends[i]:ends[i + 1]].tobytes() for i in range(batch.num_rows)] for x in (bucket, value)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(pack[0], pa.binary()), pa.array(pack[1], pa.binary())],
                    names=["key", "label", "buckets", "x"])
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key {kind}, label double, buckets binary, x binary")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "buckets"], kind="stable")
        examples = [(np.append(np.frombuffer(b, np.int32), 0), np.append(np.frombuffer(x, np.float32), 1.0), y)
                    for b, x, y in zip(group.buckets, group.x, group.label)]
        examples = [(np.unique(a, return_index=True), v, y) for a, v, y in examples]
        examples = [(u, v[i], y) for (u, i), v, y in examples]
        w = ftrl(examples, bits, epochs, alpha, beta, l1, l2)
        return pd.DataFrame({"n": [len(group)], "w": [w.tobytes()]})
    fitted = (counted.withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "key"), F.lit(shards)))
              .groupBy("shard").applyInPandas(fit, "n long, w binary").collect())  # at most 8 rows
    if not fitted:
        return np.zeros(1 << bits, np.float32)
    return np.average([np.frombuffer(w, np.float32) for _, w in fitted], axis=0,
                      weights=[n for n, _ in fitted]).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (0 to 1, higher: better) and predicted (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(len(weights)).bit_length() - 1
    column = docs.columns.index(text)

    def judge(batch):
        r, bucket = features(*utf8_column(batch.column(column)), bits)
        w = shared.value
        total = np.bincount(r, w[bucket], minlength=batch.num_rows)
        n = np.bincount(r, minlength=batch.num_rows)
        margin = total / np.sqrt(np.maximum(n, 1)) + w[0]
        p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        return [p, (p >= threshold).astype(np.int32)]
    return map_batches(docs, judge, [("score", "double"), ("predicted", "int")], text)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
