"""Token counts by a two-tier table of pre-token lengths.

First tier: a compact hash table of the corpus' most frequent pre-tokens,
gathered by bounded per-task summaries over all documents and broadcast
(``size`` entries of 12 bytes, at most half full: 2 MB). Second tier: the
table of each Python worker, which asks the ``tokenizers`` library for what it
has not seen. Pre-tokens themselves are never shuffled: tasks send at most
``per_task`` (hash, length, uses) rows. The tiers hold lengths as the library
gives them, so counts don't depend on which pre-tokens are frequent.

Null and empty texts have 0 tokens. Repeated rows are counted one by one.
Very long texts are read in pieces cut between pre-tokens. An empty table
gives an empty result. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.pretokens import encoder
from candela.llm.textops import HashTable, map_batches, utf8_column


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", size: int = 1 << 16,
                     per_task: int = 1 << 13) -> HashTable:
    """The table of the ``size`` pre-tokens with most uses, by summaries of all map tasks."""
    def summarise(batches):
        keys, uses, lens = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        coder = encoder(path)
        for batch in batches:
            for kind, _rows, *rest in coder.pieces(*utf8_column(batch.column(0))):
                if kind != "table":
                    continue
                h, (part, s, e) = rest
                new, at, n = np.unique(h, return_index=True, return_counts=True)
                if len(new) > per_task:
                    top = np.argpartition(n, -per_task)[-per_task:]
                    new, at, n = new[top], at[top], n[top]
                size_ = coder.lengths(new, (part, s[at], e[at]))
                keys, first, inverse = np.unique(np.concatenate([keys, new]), return_index=True,
                                                 return_inverse=True)
                uses = np.bincount(inverse, np.concatenate([uses, n])).astype(np.int64)
                lens = np.concatenate([lens, size_])[first]
                if len(keys) > 4 * per_task:
                    top = np.argpartition(uses, -2 * per_task)[-2 * per_task:]
                    keys, uses, lens = keys[top], uses[top], lens[top]
        if len(keys) > per_task:
            top = np.argpartition(uses, -per_task)[-per_task:]
            keys, uses, lens = keys[top], uses[top], lens[top]
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(lens),
                                              pa.array(uses)], names=["hash", "n_tokens", "uses"])
    rows = (docs.select(text).mapInArrow(summarise, "hash long, n_tokens int, uses long")
            .groupBy("hash", "n_tokens").agg(F.sum("uses").alias("uses"))
            .orderBy(F.desc("uses"), "hash").limit(size).collect())
    table = HashTable(size)
    table.insert(np.array([r[0] for r in rows], np.int64).view(np.uint64),
                 np.array([r[1] for r in rows], np.int32))
    return table


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 1024,
                 size: int = 1 << 16) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of each text."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text, size))
    column = docs.columns.index(text)

    def count(batch):
        data, offsets = utf8_column(batch.column(column))
        n = encoder(path).counts(data, offsets, frequent.value)
        return [np.diff(offsets), n, n > limit]
    return map_batches(docs, count, [("n_bytes", "long"), ("n_tokens", "long"),
                                     ("over_limit", "boolean")], text)
