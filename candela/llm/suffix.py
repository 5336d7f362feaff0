"""Removal of repeated byte strings by suffix arrays of shards.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Every string of the corpus is judged:

1. Anchors. In each string of ``length`` bytes the ``gram``-byte piece with the
   least hash is its anchor, so equal strings have equal anchors, and share the
   17 bytes before or after it as well. One pass sends 32 bits of each
   document's anchors (one string in 18 has a new one) with either side,
   packed, and marks those that two documents or more have in a bit array of
   fixed size (``2**filter_bits`` bits, 16 MB). It is a filter only: a wrong
   mark costs work, never a result.
2. Shards. Map tasks build a suffix array for each shard of about 1 MB of text,
   over the regions whose anchors are marked, by Larsson-Sadakane refinement:
   suffixes are sorted by 8 bytes, then only those in unsorted groups by the
   ranks 8, 16 and 32 bytes further. Kasai's common prefixes (in lockstep over
   blocks of the text) give the groups of equal strings, and these what a
   smaller document of the same shard removes. Of the rest, each string goes on
   once for a document, so a passage that a third of all documents share leaves
   a shard once.
3. Merging. What is left goes to partitions by anchor, as runs of strings around
   their anchors. Each run's strings, as sorted 64-bit keys, are merged into
   those of the other shards by binary search; strings of one key are compared
   byte by byte, and the smallest document of each string is kept. Then each
   run's strings are looked up again, and those of larger documents are cut.
4. Cuts of a document are united to spans and applied to its text. The spans
   are broadcast to the texts up to ``broadcast_bytes``, beyond that joined.

Null and empty texts and texts shorter than ``length`` lose nothing. Rows with a
null id neither cut others nor are cut. Rows of one id don't cut one another.
Very long texts are divided into shards that overlap by ``length - 1`` bytes.
Columns besides id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.textops import _BYTE_VALUE, _INT_BASE, _INT_INVERSE, map_batches, mix, powers, utf8_column
from candela.session import materialize

SHARD_BYTES = 1 << 20


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        c = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * powers(len(data), _INT_BASE), out=c[1:])
        return c


def _all_hashes(data: np.ndarray, width: int, sums: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the ``width`` bytes from every place on."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    c = _prefix_sums(data) if sums is None else sums
    with np.errstate(over="ignore"):
        return mix((c[width:] - c[:-width]) * powers(n - width + 1, _INT_INVERSE))


def _hashes_at(sums: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((sums[at + width] - sums[at]) * powers(len(sums), _INT_INVERSE)[at])


class Part:
    """A run of texts or pieces of a long text: bytes, and each piece's row and place in it."""

    def __init__(self, data, starts, ends, rows, base):
        self.data = data
        self.starts, self.ends = np.array(starts, np.int64), np.array(ends, np.int64)
        self.rows, self.base = np.array(rows, np.int64), np.array(base, np.int64)

    def piece(self, at):
        return np.searchsorted(self.starts, at, "right") - 1


def parts_of(data, offsets, length: int, limit: int = SHARD_BYTES, skip=None):
    """Divide rows into parts of about ``limit`` bytes; pieces of a row overlap by length - 1."""
    pieces, a = [], 0
    for row in range(len(offsets) - 1):
        s, e = int(offsets[row]), int(offsets[row + 1])
        if e - s < length or skip is not None and skip[row]:
            continue
        at = s
        while e - at >= length:
            end = min(e, at + limit)
            if pieces and end - a > limit:
                yield Part(data[a:pieces[-1][1]], *zip(*((x - a, y - a, r, b) for x, y, r, b in pieces)))
                pieces = []
            if not pieces:
                a = at
            pieces.append((at, end, row, at - s))
            at = end - length + 1 if end < e else e
    if pieces:
        yield Part(data[a:pieces[-1][1]], *zip(*((x - a, y - a, r, b) for x, y, r, b in pieces)))


def anchors(part: Part, length: int, gram: int):
    """Runs of strings with one anchor: (first place, last place, anchor's place, piece), prefix sums."""
    sums = _prefix_sums(part.data)
    v = _all_hashes(part.data, gram, sums)
    n = len(v)
    place_bits = np.uint64(max(1, int(n).bit_length()))
    v >>= place_bits
    v <<= place_bits
    v |= np.arange(n, dtype=np.uint64)
    window, have = length - gram + 1, 1
    while 2 * have <= window:  # least of the next 2, 4, 8 ... grams
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    if have < window:
        v = np.minimum(v[:len(v) - (window - have)], v[window - have:])
    edge = np.zeros(len(v) + 1, bool)
    edge[1:-1] = v[1:] != v[:-1]
    edge[part.starts] = True
    edge[np.minimum(part.ends - length + 1, len(v))] = True
    first = np.flatnonzero(edge[:-1])
    last = np.append(first[1:], len(v)) - 1
    piece = part.piece(first)
    valid = first <= part.ends[piece] - length
    first, last, piece = first[valid], last[valid], piece[valid]
    return first, last, (v[first] & np.uint64((1 << int(place_bits)) - 1)).astype(np.int64), piece, sums


def sided(sums, anchor, first, last, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of anchors with the bytes after and before them; 0 where these leave ``first``..``last``.

    A string that begins at most ``(length - gram + 1) // 2`` bytes before its
    anchor holds the anchor with the bytes after it, any other that with the
    bytes before it.
    """
    m = (length - gram) // 2
    after, before = np.zeros(len(anchor), np.uint64), np.zeros(len(anchor), np.uint64)
    k = anchor + gram + m <= last
    after[k] = _hashes_at(sums, anchor[k], gram + m) | np.uint64(1)
    k = anchor - m >= first
    before[k] = mix(_hashes_at(sums, anchor[k] - m, gram + m)) | np.uint64(1)
    return after, before


def big_endian_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number that sorts like them; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(data)]
    return out


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes' first ``depth`` bytes or more (Larsson-Sadakane)."""
    n = len(words)
    order = np.argsort(words)
    ordered = words[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.zeros(n + 64, np.int64)  # 0: past the end
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    known = 8
    while known < depth:
        alone = fresh & np.append(fresh[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        members = order[at]
        key = (rank[members] << 32) | rank[np.minimum(members + known, n)]
        by = np.argsort(key)
        members, key = members[by], key[by]
        order[at] = members
        new = np.append(True, key[1:] != key[:-1])
        rank[members] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] + 1
        fresh[at] = new
        known *= 2
    return order


def common_prefixes(words: np.ndarray, order: np.ndarray, limit: int, block: int = 64) -> np.ndarray:
    """min(limit, common prefix of a suffix and the one before it in ``order``), by place (Kasai).

    The prefix at a place is at least that of the place before, less one, if the
    two suffixes there differ within the ``limit`` bytes that ``order`` is sorted
    by. Blocks of the text are walked in lockstep, each from its own first place.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = np.concatenate([words, np.zeros(limit + 8, np.uint64)])
    out = np.zeros(n, np.int64)
    first = np.arange(0, n, block)
    known = np.zeros(len(first), np.int64)
    for step in range(block):
        lanes = np.flatnonzero(first + step < n)
        place = first[lanes] + step
        other = before[place]
        got = np.maximum(known[lanes] - 1, 0)
        got[other < 0] = 0
        left = np.flatnonzero((other >= 0) & (got < limit))
        while len(left):
            differ = words[place[left] + got[left]] ^ words[other[left] + got[left]]
            same = np.zeros(len(left), np.int64)
            for k in range(8):
                same += differ < np.uint64(1 << (8 * k)) if k else differ == 0
            got[left] += same
            left = left[(same == 8) & (got[left] < limit)]
        got = np.minimum(got, limit)
        known[lanes] = np.where(got < limit, got, 0)
        out[place] = got
    return out


def equal_groups(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, number of the group of equal first ``length`` bytes of each in it)."""
    words = big_endian_words(data)
    depth = 8
    while depth < length:
        depth *= 2
    order = suffix_array(words, depth)
    prefix = common_prefixes(words, order, depth)[order]
    return order, np.cumsum(prefix < length)


def _runs(at: np.ndarray, *same) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs of consecutive places with equal ``same`` arrays."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = at[1:] != at[:-1] + 1
    for x in same:
        cut |= x[1:] != x[:-1]
    edge = np.flatnonzero(cut)
    return np.append(0, edge + 1), np.append(edge, len(at) - 1)


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _shared_anchors(docs: DataFrame, length: int, gram: int, filter_bits: int, parts: int) -> np.ndarray:
    """The packed bits of anchors that two documents or more have. ``parts``: a power of two."""
    def send(batches):
        for batch in batches:
            slots = []
            data, offsets = utf8_column(batch.column(1))
            for part in parts_of(data, offsets, length, skip=batch.column(0).is_null().to_numpy(zero_copy_only=False)):
                _first, _last, anchor, piece, sums = anchors(part, length, gram)
                h = sided(sums, anchor, part.starts[piece], part.ends[piece], length, gram)
                row = part.rows[piece].astype(np.uint64) << np.uint64(32)
                both = np.concatenate([(row | (x >> np.uint64(32)))[x > 0] for x in h])
                slots.append(np.unique(both).astype(np.uint32))
            if slots:
                slots = np.sort(np.concatenate(slots))
                cuts = np.searchsorted(slots, (np.arange(1, parts, dtype=np.uint64) << np.uint64(32)) // np.uint64(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(parts), pa.int32()), pa.array([x.tobytes() for x in np.split(slots, cuts)], pa.binary())],
                    names=["part", "slots"])

    piece = (1 << filter_bits) // parts

    def mark(batches):
        packed: dict[int, list] = {}
        for batch in batches:
            for part, slots in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed.setdefault(part, []).append(slots)
        for part, slots in packed.items():
            slots = np.sort(np.frombuffer(b"".join(slots), np.uint32))
            twice = np.unique(slots[1:][slots[1:] == slots[:-1]])
            bits = np.zeros(piece, bool)
            bits[(twice >> np.uint32(32 - filter_bits)).astype(np.int64) - part * piece] = True
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                             names=["part", "bits"])
    found = (docs.select("id", "text").mapInArrow(send, "part int, slots binary").repartition(parts, "part")
             .mapInArrow(mark, "part int, bits binary").collect())  # 2**filter_bits bits, whatever the input
    out = np.zeros(1 << (filter_bits - 3), np.uint8)
    for part, bits in found:
        out[part * piece // 8:(part + 1) * piece // 8] = np.frombuffer(bits, np.uint8)
    return out


_NAMES = ["part", "cut", "packed"]
_FIELDS = "part int, cut boolean, packed binary"


def _packed_cuts(part: list[int], cuts: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of cuts; each array has the rows id, text hash, first and last."""
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array([True] * len(part)),
         pa.array([np.ascontiguousarray(x, "<i8").tobytes() for x in cuts], pa.binary())], names=_NAMES)


def shard_rows(batches, bits: np.ndarray, length: int, gram: int, parts: int):
    """Cuts within shards, and runs of what is left for the partitions, of (id, sig, text) batches."""
    filter_bits = int(len(bits)).bit_length() + 2
    for batch in batches:
        data, offsets = utf8_column(batch.column(2))
        ids, sigs = batch.column(0), batch.column(1)
        number = ids.fill_null(0).to_numpy()
        skip = ids.is_null().to_numpy(zero_copy_only=False)
        left, size_left = [], 0
        for part in parts_of(data, offsets, length, skip=skip):
            first, last, anchor, piece, sums = anchors(part, length, gram)
            marked = []
            for x in sided(sums, anchor, part.starts[piece], part.ends[piece], length, gram):
                slot = (x >> np.uint64(64 - filter_bits)).astype(np.int64)
                marked.append((bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool) & (x > 0))
            # of each run, strings that begin well before the anchor, then the others, as ranges
            turn = np.clip(anchor - (length - gram + 1) // 2, first, last + 1)
            lo = np.stack([first, turn], 1).ravel()
            size = np.stack([np.where(marked[1], turn - first, 0), np.where(marked[0], last + 1 - turn, 0)], 1).ravel()
            run = np.repeat(np.arange(len(first)), 2)[size > 0]
            lo, size = lo[size > 0], size[size > 0]
            if not len(lo):
                continue
            # regions of adjoining ranges: their bytes, and where their strings start
            piece = piece[run]
            a = np.append(0, np.flatnonzero((lo[1:] != lo[:-1] + size[:-1]) | (piece[1:] != piece[:-1])) + 1)
            b = np.append(a[1:], len(lo)) - 1
            sizes = lo[b] + size[b] - lo[a] + length - 1
            text = part.data[_gather(lo[a], sizes)]
            moved = np.repeat(np.cumsum(sizes) - sizes - lo[a], b - a + 1)
            at = _gather(lo, size)
            starts = at + np.repeat(moved, size)
            row = np.repeat(part.rows[piece], size)
            place = at + np.repeat(part.base[piece] - part.starts[piece], size)
            anchor = np.repeat(anchor[run], size)
            order, group = equal_groups(text, length)
            which = np.full(len(text), -1, np.int64)
            which[starts] = np.arange(len(at))
            mine = which[order]
            group, mine = group[mine >= 0], mine[mine >= 0]
            doc = number[row]
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            least = np.minimum.reduceat(doc[mine], first)
            cut = np.zeros(len(at), bool)
            cut[mine] = doc[mine] > np.repeat(least, np.diff(np.append(first, len(mine))))
            k = np.flatnonzero(cut)
            if len(k):
                a, b = _runs(place[k], row[k])
                who = row[k][a]
                yield _packed_cuts([int(sums[-1] % np.uint64(parts))], [np.stack(
                    [number[who], sigs.to_numpy()[who], place[k][a], place[k][b] + length])])
            k = np.flatnonzero(~cut)
            if len(k):
                a, b = _runs(at[k], anchor[k], row[k])
                sizes = at[k][b] - at[k][a] + length
                left.append((_hashes_at(sums, anchor[k][a], gram), row[k][a], place[k][a], sizes,
                             part.data[_gather(at[k][a], sizes)]))
                size_left += int(sizes.sum())
            if size_left > 4 * SHARD_BYTES:
                yield _packed_runs(left, number, sigs, parts)
                left, size_left = [], 0
        if left:
            yield _packed_runs(left, number, sigs, parts)


def _packed_runs(left: list, number, sigs, parts: int) -> pa.RecordBatch:
    """A row for each partition: its runs' ids, text hashes, places, sizes and bytes."""
    h, row, place, size, text = (np.concatenate(x) for x in zip(*left))
    to = (mix(h) % np.uint64(parts)).astype(np.int32)
    by = np.argsort(to, kind="stable")
    text = text[_gather((np.cumsum(size) - size)[by], size[by])]
    to, row, place, size = to[by], row[by], place[by], size[by]
    ids, sig = number[row], sigs.to_numpy()[row]
    ends = np.append(0, np.cumsum(size))
    edge = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
    packed = [b"".join([np.uint32(y - x).tobytes(), ids[x:y].tobytes(), sig[x:y].tobytes(),
                        place[x:y].astype(np.uint64).tobytes(), size[x:y].astype(np.uint16).tobytes(),
                        text[ends[x]:ends[y]].tobytes()])
              for x, y in zip(edge.tolist(), np.append(edge[1:], len(to)).tolist())]
    return pa.RecordBatch.from_arrays([pa.array(to[edge]), pa.array([False] * len(packed)), pa.array(packed, pa.binary())],
                                      names=_NAMES)


def merge_rows(batches, length: int, parts: int):
    """The cuts of one partition, within shards and by merging its runs, for partitions by document."""
    merged, found = _Merged(length), []
    for batch in batches:
        for cut, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if cut:
                found.append(np.frombuffer(packed, "<i8").reshape(4, -1))
            else:
                merged.add(packed)
    found += merged.cuts()
    if found:
        cuts = np.concatenate(found, 1)
        to = (mix(cuts[0].view(np.uint64) ^ mix(cuts[1].view(np.uint64))) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        to, cuts = to[order], cuts[:, order]
        edge = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        yield _packed_cuts(to[edge].tolist(), np.split(cuts, edge[1:], 1))


def unite_rows(batches):
    """(id, sig, cut): the maximal spans of each document's cuts, packed as pairs of int64."""
    found = [np.frombuffer(x, "<i8").reshape(4, -1) for batch in batches for x in batch.column(0).to_pylist()]
    if not found:
        return
    cuts = np.concatenate(found, 1)
    doc, sig, first, last = cuts[:, np.lexsort((cuts[2], cuts[1], cuts[0]))]
    new_doc = np.append(True, (doc[1:] != doc[:-1]) | (sig[1:] != sig[:-1]))
    # documents one after the other on one line: a later one begins beyond all ends of those before
    line = (np.cumsum(new_doc) - 1) * (int(last.max()) + 2)
    reach = np.maximum.accumulate(line + last)
    new = np.append(True, line[1:] + first[1:] > reach[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(line)) - 1
    spans = np.stack([first[start], (reach - line)[end]], 1).astype("<i8")
    edge = np.flatnonzero(new_doc[start])
    ends = np.append(edge[1:], len(spans))
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[start][edge]), pa.array(sig[start][edge]),
         pa.array([spans[a:b].tobytes() for a, b in zip(edge.tolist(), ends.tolist())], pa.binary())],
        names=["id", "sig", "cut"])


def cuts(docs: DataFrame, length: int = 50, gram: int = 16, filter_bits: int = 27) -> DataFrame:
    """(id, sig, cut): the byte spans to remove of ``docs`` (id, sig, text), packed; documents without are left out."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    conf = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filter_parts = 1 << max(5, math.ceil(math.log2(max(1, size / (64 << 20)))))
    marked = spark.sparkContext.broadcast(_shared_anchors(docs, length, gram, filter_bits, min(filter_parts, 1 << 16)))
    parts = max(conf, math.ceil(size / (2 << 20)))

    def shards(batches):
        return shard_rows(batches, marked.value, length, gram, parts)

    def merge(batches):
        return merge_rows(batches, length, conf)
    return (docs.select("id", "sig", "text").mapInArrow(shards, _FIELDS).repartition(parts, "part")
            .select("cut", "packed").mapInArrow(merge, _FIELDS).repartition(conf, "part")
            .select("packed").mapInArrow(unite_rows, "id long, sig long, cut binary"))


class _Merged:
    """The strings of one partition: runs of shards, merged by binary search of their keys."""

    RUN = 1 << 20

    def __init__(self, length: int):
        self.length = length
        self.keys, self.least = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.where = np.zeros(0, np.int64)  # the place of a string with that key, in all runs' texts
        self.runs, self.waiting, self.size, self.base = [], [], 0, 0

    def add(self, packed: bytes) -> None:
        n = int(np.frombuffer(packed, np.uint32, 1)[0])
        ids, sigs = np.frombuffer(packed, np.int64, n, 4), np.frombuffer(packed, np.int64, n, 4 + 8 * n)
        place = np.frombuffer(packed, np.uint64, n, 4 + 16 * n).astype(np.int64)
        size = np.frombuffer(packed, np.uint16, n, 4 + 24 * n).astype(np.int64)
        text = np.frombuffer(packed, np.uint8, offset=4 + 26 * n)
        self.waiting.append((ids, sigs, place, size, text))
        self.size += len(text)
        if self.size > self.RUN:
            self._flush()

    def _strings(self, size) -> tuple[np.ndarray, np.ndarray]:
        """(place in the run's text, number of its context) of each string."""
        n = size - self.length + 1
        return _gather(np.cumsum(size) - size, n), np.repeat(np.arange(len(n)), n)

    def _flush(self) -> None:
        if not self.waiting:
            return
        ids, sigs, place, size, text = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.size = [], 0
        at, context = self._strings(size)
        key = _all_hashes(text, self.length)[at]
        order = np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
        first = np.flatnonzero(new)
        which = np.zeros(len(key), np.int32)  # of each string among the run's keys
        which[order] = np.cumsum(new) - 1
        least = np.minimum.reduceat(ids[context[order]], first)
        key, where = key[first], at[order[first]] + self.base
        self.runs.append((ids, sigs, place, size, text, key, which, self.base))
        self.base += len(text)
        to = np.searchsorted(self.keys, key)
        there = np.zeros(len(key), bool)
        inside = to < len(self.keys)
        there[inside] = self.keys[to[inside]] == key[inside]
        self.least[to[there]] = np.minimum(self.least[to[there]], least[there])
        new = ~there
        self.keys, self.least, self.where = (np.insert(x, to[new], y[new]) for x, y in (
            (self.keys, key), (self.least, least), (self.where, where)))

    def _different(self, text: np.ndarray) -> dict:
        """Smallest document by key and string, for keys of more than one string."""
        words = big_endian_words(text)
        steps = [*range(0, self.length - 8, 8), self.length - 8]
        odd = set()
        for _ids, _sigs, _place, size, _text, key, which, base in self.runs:
            at, _context = self._strings(size)
            at += base
            other = self.where[np.searchsorted(self.keys, key)][which]
            for k in steps:
                bad = words[at + k] != words[other + k]
                if bad.any():
                    odd.update(key[which[bad]].tolist())
        found: dict[tuple, int] = {}
        for ids, _sigs, _place, size, text, key, which, _base in self.runs if odd else []:
            at, context = self._strings(size)
            for i in np.flatnonzero(np.isin(key, np.array(list(odd), np.uint64))[which]).tolist():
                who = (int(key[which[i]]), text[at[i]:at[i] + self.length].tobytes())
                doc = int(ids[context[i]])
                found[who] = min(doc, found.get(who, doc))
        return found

    def cuts(self) -> list[np.ndarray]:
        """Arrays of id, text hash, first and last of what larger documents lose."""
        self._flush()
        out: list[np.ndarray] = []
        if not self.runs:
            return out
        different = self._different(np.concatenate([run[4] for run in self.runs]))
        odd = np.array(sorted({k for k, _ in different}), np.uint64)
        for ids, sigs, place, size, text, key, which, _base in self.runs:
            at, context = self._strings(size)
            least = self.least[np.searchsorted(self.keys, key)][which]
            if len(odd):
                for i in np.flatnonzero(np.isin(key, odd)[which]).tolist():
                    least[i] = different[int(key[which[i]]), text[at[i]:at[i] + self.length].tobytes()]
            k = np.flatnonzero(ids[context] > least)
            if not len(k):
                continue
            begin = (np.cumsum(size) - size)[context[k]]
            a, b = _runs(at[k], context[k])
            first = place[context[k][a]] + (at[k] - begin)[a]
            last = place[context[k][b]] + (at[k] - begin)[b] + self.length
            out.append(np.stack([ids[context[k][a]], sigs[context[k][a]], first, last]))
        return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50,
                   broadcast_bytes: int = 64 << 20) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, spans, kept) of each document; ``kept`` is binary.

    spans: maximal removed byte ranges (start, end). Kept bytes may not be UTF-8:
    strings are bytes and can end inside a character.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("sig"), F.col(text).alias("text"))
    spans = materialize(cuts(rows, length))
    size = spans.agg(F.coalesce(F.sum(F.length("cut") + 24), F.lit(0))).first()[0]
    joined = rows.join(F.broadcast(spans) if size <= broadcast_bytes else spans, ["id", "sig"], "left")

    def apply(batch):
        data, offsets = utf8_column(batch.column(1))
        removed, spans, kept = [], [], []
        for i, packed in enumerate(batch.column(2).to_pylist()):
            raw = data[offsets[i]:offsets[i + 1]].tobytes()
            ranges = np.frombuffer(packed, "<i8").reshape(-1, 2).tolist() if packed else []
            out, at = [], 0
            for a, b in ranges:
                out.append(raw[at:a])
                at = b
            out.append(raw[at:])
            kept.append(b"".join(out))
            removed.append(len(raw) - len(kept[-1]))
            spans.append([{"start": a, "end": b} for a, b in ranges])
        return [np.diff(offsets), np.array(removed, np.int64), np.array([len(x) for x in spans], np.int64),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary())]
    out = map_batches(joined.select("id", "text", "cut"), apply, [
        ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("spans", "array<struct<start:long,end:long>>"),
        ("kept_sha256", "string"), ("kept", "binary")], "text")
    return out.select(F.col("id").alias(key), "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept")
