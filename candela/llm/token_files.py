"""Token-id files compressed by Re-Pair grammars.

Documents are dealt by ranges of their key, encoded in ascending key order and
written as shards of about ``shard_bytes`` of text. Within a shard, the most
frequent pairs of neighbouring ids are replaced by nonterminals, again and
again: each round counts all pairs, gives up to ``batch`` of the most frequent
ones (at least ``least`` uses) a rule each, and replaces their occurrences from
left to right, until no pair is frequent enough, numbers run out or a round
shortens the shard by under ``stop``. Symbols have 16 bits where the vocabulary's
ids leave room for rules in them, else 32; both are compressed alike. Pairs never cross the end of a
document, so a document is a run of symbols.

A shard is one row of a Parquet table (any store that Spark reaches): the
documents' keys and a blob of little-endian numbers

    magic "RPG1" | documents, rules, symbols, first nonterminal, tokens (uint32)
    | end of each document in symbols (uint32) | rules: left, right (uint32)
    | tokens of each rule's expansion (uint32) | symbols (uint16, or uint32
    where ids don't fit)

With the expansion lengths any range of tokens is found by their running sums
and only its symbols are expanded (:meth:`Shard.tokens`).

Null and empty texts are the end id alone. Rows with equal keys are ordered by
their text. Very long texts make a shard of their own. An empty table gives no
shards. Columns besides key and text are not stored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.llm.pretokens import encoder
from candela.llm.textops import slices, utf8_column

MAGIC = b"RPG1"
_SLOTS = 17
WIDE_RULES = 1 << 20   # of a shard whose symbols have 32 bits
# by bytes of a symbol: type of a pair, bits of a symbol, multiplier that spreads pairs over slots
_PAIRS = {2: (np.uint32, 16, np.uint32(2654435769)), 4: (np.uint64, 32, np.uint64(0x9E3779B97F4A7C15))}


def _rounds(symbols: np.ndarray, closing: np.ndarray, first: int, batch: int, least: int, stop: float):
    """Shorter symbols and the rules (left, right); ``closing`` marks symbols that end a document, as many as there may be."""
    rules: list[np.ndarray] = []
    at, limit = first, len(closing)
    pair, bits, spread = _PAIRS[symbols.dtype.itemsize]
    shift, low, unused = pair(bits), pair((1 << bits) - 1), pair(2 * bits - _SLOTS)
    while len(symbols) > 1 and at < limit:
        left, right = symbols[:-1], symbols[1:]
        free = ~closing[left]
        pairs = (left.astype(pair) << shift) | right
        ordered = np.sort(pairs[free])
        if not len(ordered):
            break
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        uses = np.diff(np.append(starts, len(ordered)))
        frequent = np.flatnonzero(uses >= least)
        if not len(frequent):
            break
        room = min(batch, limit - at)
        if len(frequent) > room:
            frequent = frequent[np.argpartition(uses[frequent], -room)[-room:]]
        chosen = ordered[starts[frequent]]
        # a table without collisions; a pair whose slot is taken waits for the next round
        slot, first_in = np.unique((chosen * spread) >> unused, return_index=True)
        chosen = chosen[first_in]
        rule_of = np.zeros(1 << _SLOTS, np.uint16)
        rule_of[slot] = np.arange(len(chosen))
        rule = rule_of[(pairs * spread) >> unused]
        places = np.flatnonzero((chosen[rule] == pairs) & free)
        rule = rule[places].astype(np.int64)
        # of neighbouring places, the first, third, ... are replaced
        run = np.append(True, np.diff(places) != 1)
        since = np.arange(len(places)) - np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
        taken = since % 2 == 0
        places, rule = places[taken], rule[taken]
        before = len(symbols)
        symbols = symbols.copy()
        symbols[places] = (at + rule).astype(symbols.dtype)
        keep = np.ones(before, bool)
        keep[places + 1] = False
        symbols = symbols[keep]
        closing[at:at + len(chosen)] = closing[chosen & low]
        rules.append(chosen)
        at += len(chosen)
        if len(places) < stop * before:
            break
    flat = np.concatenate(rules) if rules else np.zeros(0, pair)
    return symbols, np.stack([flat >> shift, flat & low], 1).astype(np.uint32)


def compress(ids: np.ndarray, ends: np.ndarray, end_id: int = 2, batch: int = 4096, least: int = 16,
             stop: float = 0.01) -> bytes:
    """The blob of one shard: ``ids`` of all documents, ``ends`` of each in ids."""
    top = int(ids.max()) if len(ids) else 0
    first, n_tokens = top + 1, len(ids)
    small = first + batch <= 1 << 16  # one round's rules have numbers there
    closed = np.zeros(n_tokens, bool)
    closed[ends - 1] = True
    closing = np.zeros(1 << 16 if small else max(first, end_id + 1) + WIDE_RULES, bool)
    closing[end_id] = True
    symbols, rules = _rounds(ids.astype(np.uint16 if small else np.uint32), closing, first, batch, least, stop)
    lengths = np.ones(first + len(rules), np.uint32)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[first + k] = lengths[a] + lengths[b]
    symbol_ends = np.searchsorted(np.cumsum(lengths[symbols], dtype=np.int64), ends) + 1
    header = np.array([len(ends), len(rules), len(symbols), first, n_tokens], "<u4")
    return b"".join([MAGIC, header.tobytes(), symbol_ends.astype("<u4").tobytes(),
                     np.ascontiguousarray(rules.T).astype("<u4").tobytes(), lengths[first:].astype("<u4").tobytes(),
                     symbols.astype("<u2" if small else "<u4").tobytes()])


class Shard:
    """Reads a blob; tokens of any document or range without expanding the rest."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("this is no shard of token ids")
        docs, rules, symbols, first, self.n_tokens = np.frombuffer(blob, "<u4", 5, 4).tolist()
        numbers = np.frombuffer(blob, "<u4", docs + 3 * rules, 24)
        self.symbol_ends = numbers[:docs].astype(np.int64)
        left, right = numbers[docs:docs + rules], numbers[docs + rules:docs + 2 * rules]
        self.length = np.concatenate([np.ones(first, np.int64), numbers[docs + 2 * rules:].astype(np.int64)])
        at = 24 + 4 * (docs + 3 * rules)
        self.symbols = np.frombuffer(blob, "<u2" if len(blob) - at == 2 * symbols else "<u4", symbols, at)
        # expansions of all rules, each after those that it uses
        self.start = np.concatenate([np.arange(first), first + np.cumsum(self.length[first:]) - self.length[first:]])
        self.pool = np.zeros(first + int(self.length[first:].sum()), "<u4")
        self.pool[:first] = np.arange(first)
        for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
            s, m, n = self.start[first + k], self.length[a], self.length[b]
            self.pool[s:s + m] = self.pool[self.start[a]:self.start[a] + m]
            self.pool[s + m:s + m + n] = self.pool[self.start[b]:self.start[b] + n]
        self.ends = np.cumsum(self.length[self.symbols])

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.length[symbols]
        at = np.repeat(self.start[symbols] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.pool[at]

    def tokens(self, a: int, b: int) -> np.ndarray:
        """Ids ``a`` to ``b`` of the shard."""
        if a >= b:
            return np.zeros(0, "<u4")
        i, j = np.searchsorted(self.ends, a, "right"), np.searchsorted(self.ends, b, "left") + 1
        start = int(self.ends[i] - self.length[self.symbols[i]])
        return self._expand(self.symbols[i:j])[a - start:b - start]

    def document(self, k: int) -> np.ndarray:
        return self._expand(self.symbols[self.symbol_ends[k - 1] if k else 0:self.symbol_ends[k]])

    def document_ends(self) -> np.ndarray:
        return self.ends[self.symbol_ends - 1]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text",
                 end_id: int = 2, shard_bytes: int = 8 << 20) -> None:
    """Write the shards of ``docs`` to the folder ``path``."""
    def encode(batches):
        coder, part, number = encoder(vocabulary), TaskContext.get().partitionId(), 0
        keys, ids, ends, size = [], [], [], 0

        def shard():
            flat, doc_ends = np.concatenate(ids), np.concatenate(ends)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([[x for column in keys for x in column.to_pylist()]], pa.list_(keys[0].type)),
                 pa.array([len(flat)], pa.int64()), pa.array([compress(flat, doc_ends, end_id)], pa.binary())],
                names=["part", "number", "keys", "n_tokens", "blob"])
        for whole in batches:
            for batch in slices(whole, 1, shard_bytes // 4):
                data, offsets = utf8_column(batch.column(1))
                if size and size + len(data) > shard_bytes:
                    yield shard()
                    keys, ids, ends, size, number = [], [], [], 0, number + 1
                found, offs = coder.ids(data, offsets)
                # the end id after each document
                out = np.full(len(found) + batch.num_rows, end_id, np.uint32)
                at = np.arange(len(found)) + np.repeat(np.arange(batch.num_rows), np.diff(offs))
                out[at] = found
                done = sum(map(len, ids))
                keys.append(batch.column(0))
                ids.append(out)
                ends.append(offs[1:] + np.arange(1, batch.num_rows + 1) + done)
                size += len(data) + 1
        if keys:
            yield shard()
    kind = docs.schema[key].dataType.simpleString()
    (docs.select(key, text).repartitionByRange(key).sortWithinPartitions(key, text)
     .mapInArrow(encode, f"part int, number int, keys array<{kind}>, n_tokens long, blob binary")
     .write.parquet(path))


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of each document, read back from the shards."""
    shards = spark.read.parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that wrote
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = (shards.select("part", "number", "n_tokens")
              .withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(parts, "part").select("part", "number", (F.col("part_start") + F.col("inside")).alias("start")))
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def decode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(1)[i].as_py())
                ends = shard.document_ends()
                flat = shard.tokens(0, shard.n_tokens)
                raw = flat.tobytes()
                begin = np.append(0, ends[:-1])
                span = list(zip((4 * begin).tolist(), (4 * ends).tolist()))
                columns = [batch.column(0)[i].values, pa.array(begin + batch.column(2)[i].as_py()),
                           pa.array(ends - begin), pa.array([zlib.crc32(raw[a:b]) for a, b in span], pa.int64())]
                if with_ids:
                    columns.append(pa.array([raw[a:b] for a, b in span], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[key, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)
    return (shards.join(starts, ["part", "number"]).select("keys", "blob", "start")
            .mapInArrow(decode, f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids))
