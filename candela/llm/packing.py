"""Best-fit packing of token pieces into sequences by linear grouping.

1. Each document's ids (with an end id) are cut into pieces of at most
   ``capacity`` ids; only the first of several may be shorter. Pieces are
   written once as a table of numbers.
2. The driver sees only the histogram of lengths (``capacity`` counts at
   most). Large pieces, in descending order, form ``groups`` (64) groups of equal
   cardinality, however many pieces and lengths there are; all lengths of a group
   are rounded up to its largest. For these few sizes,
   configurations are chosen one by one: the largest size left, with the fill
   from the remaining sizes that comes closest to ``capacity`` (subset sums as
   bits), as often as the counts allow.
3. Actual pieces take the slots: a piece's rank in its group gives its
   sequence by arithmetic on the configurations' tables, in map tasks.
4. The sequences' real gaps and the small pieces' lengths, again as
   histograms, are matched best fit decreasing; runs of equal pieces go to runs
   of equal gaps. A piece's rank among its length gives its gap's rank, and a
   join on (gap, rank) its sequence.

Ranks come from two-level counts (length, then a hash chunk of about the root
of the largest count), so a length that a third of all pieces share is not
sorted in one task. Joins have one row for each key.

Null and empty texts are the end id alone. Repeated rows are packed one by
one. Very long texts make many pieces. An empty table gives an empty result.
Other input columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.pretokens import encoder
from candela.llm.textops import slices, utf8_column
from candela.session import materialize


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id",
           text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of each piece; ids: little-endian uint32."""
    def cut(batches):
        coder = encoder(path)
        for whole in batches:
            for batch in slices(whole, 1):
                ids, offs = coder.ids(*utf8_column(batch.column(1)))
                row, piece, start, length, crc, raw = [], [], [], [], [], []
                ids, tail = ids.astype("<u4"), np.array([end_id], "<u4").tobytes()
                for i in range(batch.num_rows):
                    mine = ids[offs[i]:offs[i + 1]].tobytes() + tail
                    n = len(mine) // 4
                    at = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
                    for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
                        part = mine[4 * a:4 * b]
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            raw.append(part)
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(raw, pa.binary())] * with_ids,
                    names=[key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        cut, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
             + ", ids binary" * with_ids)


def ranked(df: DataFrame, key: str, order: list[str], largest: int) -> DataFrame:
    """``df`` with ``rank``: 0, 1, ... within each ``key``, without a task for a whole key."""
    chunk = F.pmod(F.xxhash64(*order), F.lit(max(1, math.isqrt(largest))))
    df = df.withColumn("chunk", chunk)
    counts = df.groupBy(key, "chunk").agg(F.count("*").alias("n"))
    base = counts.select(key, "chunk", (F.sum("n").over(
        Window.partitionBy(key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0))
        - F.col("n")).alias("base"))
    inside = F.row_number().over(Window.partitionBy(key, "chunk").orderBy(*order))
    return (df.withColumn("inside", inside).join(base, [key, "chunk"])
            .withColumn("rank", F.col("base") + F.col("inside") - 1).drop("chunk", "inside", "base"))


class LargePlan:
    """Configurations for the large lengths of a histogram, and where each rank goes."""

    def __init__(self, histogram: dict[int, int], capacity: int, groups: int):
        lengths = np.array(sorted(histogram, reverse=True), np.int64)
        counts = np.array([histogram[x] for x in lengths], np.int64)
        self.before = np.zeros(capacity + 1, np.int64)  # larger pieces, by length
        ends = np.cumsum(counts)
        self.before[lengths] = ends - counts
        total = int(ends[-1]) if len(ends) else 0
        k = max(1, -(-total // groups))
        first = np.arange(0, total, k)
        sizes = lengths[np.searchsorted(ends, first, "right")] if total else np.zeros(0, np.int64)
        merged = np.flatnonzero(np.append(True, sizes[1:] != sizes[:-1])) if total else []
        self.first = first[merged] if total else first
        size = [int(x) for x in (sizes[merged] if total else sizes)]
        left = np.diff(np.append(self.first, total)).tolist()
        slots = [[] for _ in size]  # of each group: (first slot, slots a sequence, first sequence)
        used = [0] * len(size)
        self.sequences = 0
        for g in range(len(size)):
            while left[g]:
                config = self._configuration(size, left, g, capacity)
                times = min(left[i] // m for i, m in config.items())
                for i, m in config.items():
                    slots[i].append((used[i], m, self.sequences))
                    used[i] += times * m
                    left[i] -= times * m
                self.sequences += times
        self.big = total + 1
        flat = [(i * self.big + a, a, m, s) for i, x in enumerate(slots) for a, m, s in x]
        self.key, self.slot, self.each, self.base = (np.array(c, np.int64) for c in zip(*flat)) if flat else [np.zeros(0, np.int64)] * 4

    @staticmethod
    def _configuration(size, left, g, capacity) -> dict[int, int]:
        """Group ``g`` once and the remaining sizes that fill the rest of a sequence best."""
        room = capacity - size[g]
        reach, steps = 1, []
        mask = (1 << (room + 1)) - 1
        for i in range(g, len(size)):
            n = min(left[i] - (i == g), room // size[i])
            if n > 0:
                steps.append((i, n, reach))
                for _ in range(n):
                    reach |= (reach << size[i]) & mask
            if reach >> room & 1:
                break
        fill, config = reach.bit_length() - 1, {g: 1}
        for i, n, before in reversed(steps):
            while not before >> fill & 1:
                fill -= size[i]
                config[i] = config.get(i, 0) + 1
        return config

    def sequence(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        place = self.before[length] + rank
        group = np.searchsorted(self.first, place, "right") - 1
        rank = place - self.first[group]
        at = np.searchsorted(self.key, group * self.big + rank, "right") - 1
        return self.base[at] + (rank - self.slot[at]) // self.each[at]


class SmallPlan:
    """Best fit decreasing of the small lengths into gaps; gap -1 is a new sequence."""

    def __init__(self, histogram: dict[int, int], gaps: dict[int, int], capacity: int):
        runs = [[] for _ in range(capacity + 1)]  # by gap now: (gap at first, first rank, sequences)
        for gap, n in gaps.items():
            runs[gap].append((gap, 0, n))
        self.new, placed = 0, []
        self.big = max([0, *histogram.values()]) + 1
        for length in sorted(histogram, reverse=True):
            rank, left = 0, histogram[length]
            gap = length
            while left:
                while gap <= capacity and not runs[gap]:
                    gap += 1
                if gap > capacity:
                    n = -(-left // (capacity // length))
                    runs[capacity].append((-1, self.new, n))
                    self.new += n
                    gap = capacity
                origin, first, n = runs[gap].pop()
                take = min(n, left)
                if take < n:
                    runs[gap].append((origin, first + take, n - take))
                runs[gap - length].append((origin, first, take))
                placed.append((length * self.big + rank, rank, origin, first))
                rank, left = rank + take, left - take
                gap = max(length, gap - length) if gap - length >= length else gap
        self.key, self.rank, self.origin, self.first = (np.array(c, np.int64) for c in zip(*placed)) if placed else [np.zeros(0, np.int64)] * 4
        order = np.argsort(self.key)
        self.key, self.rank, self.origin, self.first = (x[order] for x in (self.key, self.rank, self.origin, self.first))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length * self.big + rank, "right") - 1
        return self.origin[at], self.first[at] + rank - self.rank[at]


def _mapped(df: DataFrame, fn, names: list[str]) -> DataFrame:
    """``df`` with long columns ``names`` from ``fn(length, rank)``; rank goes."""
    keep = [c for c in df.columns if c != "rank"]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                new = fn(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(x) for x in new],
                                                 names=keep + names)
    return df.select(*keep, "rank").mapInArrow(run, ", ".join([kinds, *(f"{n} long" for n in names)]))


def pack(items: DataFrame, key: str = "doc_id", capacity: int = 1024, groups: int = 64,
         small_below: int | None = None) -> DataFrame:
    """``items`` (see :func:`pieces`) with sequence_id and offset.

    ``items`` is read several times; write it to a table before. Lengths under
    ``small_below``, by default three eighths of ``capacity``, are small: what
    rounding wastes in the sequences of large pieces is a real gap that they fill.
    """
    small_below = max(1, 3 * capacity // 8) if small_below is None else small_below
    histogram = {r[0]: r[1] for r in items.groupBy("length").count().collect()}  # capacity rows at most
    full = histogram.get(capacity, 0)
    plan = LargePlan({n: c for n, c in histogram.items() if small_below <= n < capacity}, capacity, groups)
    small = {n: c for n, c in histogram.items() if n < small_below}
    order = [key, "piece", "start", "ids_crc32"]
    everything = ranked(items, "length", order, max([1, *histogram.values()]))

    def large_sequence(length, rank):
        whole = length == capacity
        out = plan.sequences + rank
        out[~whole] = plan.sequence(length[~whole], rank[~whole])
        return [out]
    large = materialize(_mapped(everything.filter(F.col("length") >= small_below), large_sequence, ["sequence_id"]))
    if small:
        gaps = (large.filter(F.col("length") < capacity).groupBy("sequence_id")
                .agg((capacity - F.sum("length")).alias("gap")).filter("gap > 0"))
        by_gap = {r[0]: r[1] for r in gaps.groupBy("gap").count().collect()}  # capacity rows at most
        fit = SmallPlan(small, by_gap, capacity)
        placed = _mapped(everything.filter(F.col("length") < small_below), fit.place, ["gap", "gap_rank"])
        gaps = ranked(gaps, "gap", ["sequence_id"], max([1, *by_gap.values()]))
        base = plan.sequences + full
        found = (placed.join(gaps.withColumnRenamed("rank", "gap_rank"), ["gap", "gap_rank"], "left")
                 .withColumn("sequence_id", F.coalesce("sequence_id", F.col("gap_rank") + base))
                 .select(*large.columns))
        large = large.unionByName(found)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order).rowsBetween(Window.unboundedPreceding, 0)
    return large.withColumn("offset", F.sum("length").over(inside) - F.col("length"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id",
                   text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequences and places."""
    return pack(materialize(pieces(docs, path, capacity, end_id, key, text, with_ids)), key, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of a result with ``with_ids``: one row of at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    return joined.select("sequence_id", "n_tokens", F.expr(
        "unhex(array_join(transform(parts, p -> hex(p.ids)), ''))").alias("ids"))
