"""N-gram Jaccard join of documents: a grouped prefix join.

A document's set holds its distinct 5-word shingles (64-bit hashes of
lower-cased words); documents link from a similarity of ``percent`` / 100 on.

1. Order. One pass counts, over all documents, how many contain each shingle
   of the lower half of the hash space (4 bytes a shingle are shuffled). The
   ``listed`` most frequent ones are broadcast (8 MB at most) and come last in
   the global order, by the logarithm of their count; all others come by hash.
   Any order gives right results; this one keeps shared passages out of
   prefixes.
2. Prefixes. A second pass takes each document's prefix: of ``n`` shingles the
   first ``n - ceil(percent * n / 100) + 1``; linked documents share one of
   them. Prefix shingles go, packed, to partitions by hash, where those of one
   document only are dropped.
3. Groups. Documents with equal sets collapse to the one with the smallest id,
   and of those, documents with equal prefixes and sizes to one group.
4. Stars. In each bucket of a prefix shingle, every group is paired with one
   centre only (by four orders of the groups, so that one document meets several
   centres), and every member of a group with its first; pairs must pass the
   size, position and sketch filters (a sketch holds the parities of 1024 hash
   buckets; its distance never exceeds the sets'). The most promising
   pair of each document is verified, which gives first components. ``turns`` times more, groups expand to
   members, and in buckets of several components every document is paired with
   a centre drawn for that bucket, if that lies in another component.
5. Rest. The pairs of a bucket that lie in different components still pass the
   same filters and are verified, unless they were. A large group of near
   copies is one component by then, so it gives no pairs. The join itself
   compares short sketches, so of documents that resemble one another without a
   link it emits next to no pairs either. Documents that share many prefix
   shingles are paired at the first one, not at each: a row of a bucket holds the
   shingles before it, and a pair with a common one has met before.
6. Components of all verified links.

Verification intersects whole sets; their texts are read again for the
candidates only (by a broadcast of ids up to ``broadcast_ids`` of them, else by
a join).

Null and empty texts and texts of white space have no shingles and link with
nothing. Texts of under five words have one. Rows of one id are one document
(their links join): if any id has different texts, all nodes are pairs of id and
text hash until the end, and those of one id are linked. Rows with a null id are returned and link with nothing.
Very long texts are hashed in pieces cut between words. Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candela.llm.components import components
from candela.llm.textops import (HashTable, cut_at_non_word, hash_windows, lower_ascii, mix, slices,
                                 utf8_column, words_of)
from candela.session import discard, materialize

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
FOLD = lower_ascii()
_CUT = cut_at_non_word(IS_WORD)
_BITS = 58  # of a shingle's hash; its class in the order stands above them


def shingles(data, offsets, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of 58 bits, row) of all shingles in row order, repeated ones included."""
    h, r, _s, _e = words_of(data, offsets, IS_WORD, FOLD, _CUT)
    n_rows = len(offsets) - 1
    words = np.bincount(r, minlength=n_rows)
    if len(h) >= width:
        w = hash_windows(h, width)
        inside = r[:len(w)] == r[width - 1:]
        w, rows = w[inside], r[:len(inside)][inside]
    else:
        w, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        first = np.searchsorted(r, short)
        whole = np.array([hash_windows(h[a:a + words[i]], int(words[i]))[0] for a, i in zip(first, short)], np.uint64)
        w, rows = np.concatenate([w, whole]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        w, rows = w[order], rows[order]
    return w >> np.uint64(64 - _BITS), rows


def _sets(w: np.ndarray, rows: np.ndarray, n_rows: int) -> list[np.ndarray]:
    ends = np.searchsorted(rows, np.arange(n_rows + 1))
    return [np.unique(w[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def frequent_shingles(docs: DataFrame, text: str, width: int, least: int, listed: int, parts: int) -> HashTable:
    """Classes (1 to 60) of the most frequent shingles, counted by documents."""
    def send(batches):
        for whole in batches:
            for batch in slices(whole, 0):
                w, rows = shingles(*utf8_column(batch.column(0)), width)
                low = w < np.uint64(1 << (_BITS - 1))
                w = np.concatenate([*_sets(w[low], rows[low], batch.num_rows), np.zeros(0, np.uint64)])
                short = (w >> np.uint64(_BITS - 33)).astype(np.uint32)
                short.sort()
                cuts = np.searchsorted(short, (np.arange(1, parts) * ((1 << 32) / parts)).astype(np.uint32))
                packed = [x.tobytes() for x in np.split(short, cuts)]
                yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array(packed, pa.binary())],
                                                 names=["part", "hashes"])

    def count(batches):
        packed = [x for batch in batches for x in batch.column(0).to_pylist()]
        if packed:
            short = np.sort(np.frombuffer(b"".join(packed), np.uint32))
            starts = np.flatnonzero(np.append(True, short[1:] != short[:-1])) if len(short) else np.zeros(0, int)
            n = np.diff(np.append(starts, len(short)))
            often = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(short[starts[often]].astype(np.int64)), pa.array(n[often])],
                                             names=["hash", "docs"])
    found = (docs.select(text).mapInArrow(send, "part int, hashes binary").repartition(parts, "part")
             .select("hashes").mapInArrow(count, "hash long, docs long")
             .orderBy(F.desc("docs"), "hash").limit(listed).toPandas())
    table = HashTable(max(1, len(found)))
    # the table's keys fill 64 bits: its slots are the highest ones
    table.insert(mix(found["hash"].to_numpy(np.uint64) + np.uint64(1)),
                 np.log2(found["docs"].to_numpy(np.float64)).astype(np.int32) if len(found) else np.zeros(0, np.int32))
    return table


def _classed(w: np.ndarray, table: HashTable) -> np.ndarray:
    """The shingles with their class above the hash, so that numbers stand in the global order."""
    out = w.copy()
    low = np.flatnonzero(w < np.uint64(1 << (_BITS - 1)))
    found = table.find(mix((w[low] >> np.uint64(_BITS - 33)) + np.uint64(1)))
    hit = found > 0
    out[low[hit]] |= found[hit].astype(np.uint64) << np.uint64(_BITS)
    return out


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _signatures(docs: DataFrame, key: str, text: str, width: int, percent: int, frequent, parts: int) -> DataFrame:
    """Rows of two kinds: a document's size, digests and sketch; packed prefixes for a partition."""
    salt = np.uint64(0x5851F42D4C957F2D)

    def sign(batches):
        for whole in batches:
            for batch in slices(whole, 1):
                n_rows = batch.num_rows
                w, rows = shingles(*utf8_column(batch.column(1)), width)
                sets = _sets(_classed(w, frequent.value), rows, n_rows)
                size = np.array([len(x) for x in sets])
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                row = np.repeat(np.arange(n_rows), size)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
                prefix = place < np.where(size > 0, size - -(-percent * size // 100) + 1, 0)[row]
                h1, h2 = mix(flat), mix(flat ^ salt)
                digests = []
                for h, take in ((h1, None), (h2, None), (h1, prefix), (h2, prefix)):
                    sums = np.zeros(n_rows, np.uint64)
                    np.add.at(sums, row if take is None else row[take], h if take is None else h[take])
                    digests.append(sums.view(np.int64))
                bits = np.bincount(row * 1024 + (h1 >> np.uint64(54)).astype(np.int64), minlength=1024 * n_rows) & 1
                sketch = np.packbits(bits.astype(bool)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n_rows + 1, dtype=np.int32) * 16), pa.array(sketch))
                keys = batch.column(0)
                known = keys.is_valid().to_numpy(zero_copy_only=False)
                kinds = keys.type
                empty = pa.nulls(n_rows, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n_rows, -1, np.int32)), keys, pa.array(size.astype(np.int64)),
                     *map(pa.array, digests), lists, empty, pa.nulls(n_rows, pa.list_(kinds)),
                     pa.nulls(n_rows, pa.list_(pa.int64()))], names=_NAMES)
                take = np.flatnonzero(prefix & known[row])
                part = (h2[take] % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                take, part = take[order], part[order]
                ends = np.searchsorted(part, np.arange(parts + 1))
                out = []
                for p in range(parts):
                    mine = take[ends[p]:ends[p + 1]]
                    if len(mine):
                        who, which = np.unique(row[mine], return_inverse=True)
                        packed = (flat[mine].tobytes() + which.astype(np.uint32).tobytes()
                                  + np.minimum(place[mine], 65535).astype(np.uint16).tobytes())
                        out.append((p, packed, keys.take(pa.array(who)).to_pylist(), size[who].tolist()))
                if out:
                    m = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in out], pa.int32()), pa.nulls(m, kinds), pa.nulls(m, pa.int64()),
                         *[pa.nulls(m, pa.int64())] * 4, pa.nulls(m, pa.list_(pa.int64())),
                         pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.list_(kinds)),
                         pa.array([x[3] for x in out], pa.list_(pa.int64()))], names=_NAMES)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        sign, f"part int, id {kind}, n long, s1 long, s2 long, p1 long, p2 long, sketch array<long>, "
              f"packed binary, ids array<{kind}>, sizes array<long>")


_NAMES = ["part", "id", "n", "s1", "s2", "p1", "p2", "sketch", "packed", "ids", "sizes"]


def _shared_prefixes(signed: DataFrame, parts: int) -> DataFrame:
    """(token, id, n, place) of the prefix shingles that two documents or more share."""
    def join(batches):
        tokens, places, ids, sizes, row, base = [], [], [], [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(0)[i].as_py()
                m = len(raw) // 14
                tokens.append(np.frombuffer(raw, np.uint64, m))
                row.append(np.frombuffer(raw, np.uint32, m, 8 * m) + base)
                places.append(np.frombuffer(raw, np.uint16, m, 12 * m))
                ids.append(batch.column(1)[i].values)
                sizes.append(batch.column(2)[i].values.to_numpy())
                base += len(ids[-1])
        if not tokens:
            return
        token, row, place = np.concatenate(tokens), np.concatenate(row).astype(np.int64), np.concatenate(places)
        ids, size = pa.chunked_array(ids).combine_chunks(), np.concatenate(sizes)
        ordered = np.sort(token)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            return
        at = np.minimum(np.searchsorted(shared, token), len(shared) - 1)
        keep = np.flatnonzero(shared[at] == token)
        for a in range(0, len(keep), 1 << 18):
            k = keep[a:a + (1 << 18)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[k].view(np.int64)), ids.take(pa.array(row[k])), pa.array(size[row[k]]),
                 pa.array(place[k].astype(np.int32))], names=["token", "id", "n", "place"])
    kind = signed.schema["id"].dataType.simpleString()
    return (signed.filter("part >= 0").select("part", "packed", "ids", "sizes").repartition(parts, "part")
            .select("packed", "ids", "sizes").mapInArrow(join, f"token long, id {kind}, n long, place int"))


def _may_link(percent: int, a: str = "", b: str = "2") -> Column:
    """The size filter, and the position filter at a shared prefix shingle.

    The latter holds at the first shared shingle, where any linked pair passes it.
    """
    x, y, i, j = (F.col(c) for c in (f"n{a}", f"n{b}", f"place{a}", f"place{b}"))
    size = (100 * F.least(x, y) >= percent * F.greatest(x, y))
    return size & ((100 + percent) * (F.least(x - i, y - j)) >= percent * (x + y))


def _with_earlier(buckets: DataFrame) -> DataFrame:
    """With ``earlier``, up to 4 tokens of the document that come right before this one in the global order.

    Two documents with a common earlier token have met there, so they need not meet
    here; at their first shared token they have none. Tokens are unsigned numbers.
    """
    before = Window.partitionBy("rep").orderBy(F.col("token") < 0, "token").rowsBetween(-4, -1)
    return buckets.withColumn("earlier", F.collect_list("token").over(before))


def _folded(sketch: Column, k: int) -> Column:
    """One of 8 words of parities that each join 2 of the sketch's 16 words (distances only shrink)."""
    return sketch[k].bitwiseXOR(sketch[k + 8])


def _rest_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that meet in a bucket, lie in different components and pass the filters.

    ``buckets`` has token, rep, n, place, component and sketch; the pairs of one
    document pair are one row, or a few if its shared tokens lie far apart.
    """
    short = F.array([_folded(F.col("sketch"), k) for k in range(8)])  # 512 parities from 1024
    rows = _with_earlier(buckets.withColumn("short", short).select(
        "token", "rep", "n", "place", "component", *[F.col("short")[k].alias(f"s{k}") for k in range(8)]))
    other = rows.withColumnsRenamed({"rep": "b", "n": "n2", "place": "place2", "component": "component2",
                                     "earlier": "earlier2", **{f"s{k}": f"t{k}" for k in range(8)}})
    apart = sum((F.bit_count(F.col(f"s{k}").bitwiseXOR(F.col(f"t{k}"))) for k in range(8)), F.lit(0))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("n2"))
    return (rows.withColumnRenamed("rep", "a")
            .join(other, (rows["token"] == other["token"]) & (F.col("a") > F.col("b"))
                  & (F.col("component") != F.col("component2")) & _may_link(percent) & near
                  & ~F.arrays_overlap("earlier", "earlier2")).select("a", "b"))


class _Join:
    def __init__(self, docs, key, text, width, percent, nodes, broadcast_ids):
        self.docs, self.key, self.text = docs, key, text
        self.width, self.percent, self.nodes, self.broadcast_ids = width, percent, nodes, broadcast_ids

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sizes and sketches allow a link, with ``far``, the sketches' relative distance."""
        n = self.nodes.select("rep", "n", "sketch")
        a = n.withColumnsRenamed({"rep": "a", "n": "na", "sketch": "sa"})
        b = n.withColumnsRenamed({"rep": "b", "n": "nb", "sketch": "sb"})
        apart = F.expr("aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (s, v) -> s + v)")
        return (pairs.join(a, "a").join(b, "b")
                .filter(100 * F.least("na", "nb") >= self.percent * F.greatest("na", "nb"))
                .withColumn("far", apart / (F.col("na") + F.col("nb")))
                .filter((100 + self.percent) * F.col("far") <= 100 - self.percent + 1e-9)
                .select(*pairs.columns, "far"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs with 100 * intersection >= percent * union."""
        width = self.width
        wanted = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        if wanted.count() <= self.broadcast_ids:
            wanted = F.broadcast(wanted)
        kind = self.docs.schema[self.key].dataType.simpleString()

        def whole_sets(batches):
            for whole in batches:
                for batch in slices(whole, 1):
                    w, rows = shingles(*utf8_column(batch.column(1)), width)
                    sets = _sets(w, rows, batch.num_rows)
                    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                                     names=["id", "shingles"])
        texts = self.docs.select(F.col(self.key).alias("id"), F.col(self.text).alias("text"))
        sets = materialize(texts.join(wanted, "id").select("id", "text")
                           .mapInArrow(whole_sets, f"id {kind}, shingles array<long>"))
        a, b = (sets.withColumnsRenamed({"id": x, "shingles": f"set_{x}"}) for x in "ab")
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        found = materialize(pairs.join(a, "a").join(b, "b").filter(100 * common >= self.percent * union)
                            .select("a", "b").distinct())  # an id may have several rows
        discard(sets)
        return found


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75, width: int = 5,
                   listed: int = 1 << 18, least: int = 16, broadcast_ids: int = 500_000, turns: int = 1) -> DataFrame:
    """(key, n_shingles, component_id) of each document; the smallest key reached by links."""
    docs = docs.select(key, text)
    known = F.col(key).isNotNull()
    h = F.xxhash64(F.lit(7), text)
    several = docs.filter(known).groupBy(key).agg(F.min(h).alias("lo"), F.max(h).alias("hi")).filter("lo != hi")
    options = (percent, width, listed, least, broadcast_ids, turns)
    if several.isEmpty():
        return _linked(docs, key, text, *options).select(F.col("id").alias(key), "n_shingles", "component_id")
    nodes = docs.select(F.when(known, F.struct(F.col(key).alias("id"), h.alias("h"))).alias("node"), F.col(text).alias("text"))
    linked = _linked(nodes, "node", "text", *options)
    return linked.select(F.col("id.id").alias(key), "n_shingles", F.col("component_id.id").alias("component_id"))


def _linked(docs: DataFrame, key: str, text: str, percent: int, width: int, listed: int, least: int,
            broadcast_ids: int, turns: int) -> DataFrame:
    """(id, n_shingles, component_id) for keys that have one text each, or are pairs (id, h) of an id and a text."""
    spark = docs.sparkSession
    paired = isinstance(docs.schema[key].dataType, StructType)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (64 << 20)))
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, text, width, least, listed, parts))
    signed = materialize(_signatures(docs, key, text, width, percent, frequent, parts))
    shared = materialize(_shared_prefixes(signed, parts)).withColumnRenamed("id", "rep")
    rows = materialize(signed.filter("part = -1").select("id", "n", "s1", "s2", "p1", "p2", "sketch"))
    discard(signed)
    sets = rows.filter("n > 0 AND id IS NOT NULL")

    # equal sets, then equal prefixes and sizes
    # (aggregates are written before they are joined to their rows: adaptive execution can then
    # split a hot key of the join, which it can't right above an aggregate)
    reps = materialize(sets.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep")))
    members = materialize(sets.select("id", "n", "s1", "s2").join(reps, ["n", "s1", "s2"]).select("id", "rep"))
    heads = members.filter("id = rep").select("rep").distinct()
    signs = sets.withColumnRenamed("id", "rep").join(heads, "rep").dropDuplicates(["rep"])
    groups = signs.groupBy("n", "p1", "p2").agg(F.min("rep").alias("gid"))
    nodes = materialize(signs.join(groups, ["n", "p1", "p2"]).select("rep", "gid", "n", "sketch"))
    join = _Join(docs, key, text, width, percent, nodes, broadcast_ids)

    placed = nodes.select("rep", "gid", F.col("rep").alias("component"))
    links = tried = None
    spent: list[DataFrame] = []

    def verify(pairs: DataFrame) -> None:
        nonlocal links, tried
        pairs = materialize(pairs)
        found = join.verified(pairs)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        discard(*spent)
        spent.clear()

    def mixed_buckets(rows: DataFrame) -> DataFrame:
        """Of (token, rep, n, place), the buckets whose documents lie in several components."""
        rows = rows.select("token", "rep", "n", "place").join(placed.select("rep", "component"), "rep")
        mixed = materialize(rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                           F.count("*").alias("members"))
                            .filter("lo != hi").select("token", "members"))
        found = materialize(rows.join(mixed, "token"))
        discard(mixed)
        return found

    def stars(rows: DataFrame, centre: Column) -> DataFrame:
        """Pairs of each document of a bucket with its ``centre`` in another component."""
        other = rows.groupBy("token").agg(F.min_by(F.struct("rep", "n", "place", "component"), centre).alias("c"),
                                          F.count("*").alias("members")).filter("members > 1").select(
            "token", F.col("c.rep").alias("centre"), F.col("c.n").alias("n2"), F.col("c.place").alias("place2"),
            F.col("c.component").alias("component2"))
        other = materialize(other)
        spent.append(other)
        pairs = (rows.join(other, "token").filter("component != component2").filter(_may_link(percent))
                 .select(F.greatest("rep", "centre").alias("a"), F.least("rep", "centre").alias("b"),
                         F.col("rep").alias("who")).distinct())
        return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")

    by_group = (shared.join(placed.filter("rep = gid").select("rep", "component"), "rep"))
    firsts = nodes.filter("rep != gid").select(F.col("rep").alias("a"), F.col("gid").alias("b"), F.col("rep").alias("who"))
    buckets = shared
    for turn in range(1 + turns):
        if turn == 0:
            # four orders of centres: several for a document, and few pairs in all
            pairs = stars(by_group, F.xxhash64("rep", F.pmod("token", F.lit(4)))).union(firsts).distinct()
        else:
            buckets = mixed_buckets(buckets)
            pairs = stars(buckets, F.xxhash64("rep", "token", F.lit(turn)))
        best = join.sketched(pairs).groupBy("who").agg(F.min_by(F.struct("a", "b"), F.struct("far", "a", "b")).alias("p"))
        verify(best.select("p.a", "p.b").distinct())
        found = components(links)
        links = found.select(F.col("node").alias("a"), F.col("component").alias("b"))  # as connected, and settled
        placed = materialize(nodes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                             .select("rep", "gid", F.coalesce("component", "rep").alias("component")))

    # what the components so far leave apart
    buckets = mixed_buckets(buckets)
    rest = _rest_pairs(buckets.join(nodes.select("rep", "sketch"), "rep"), percent)
    peers = placed.select("gid", F.col("rep").alias("b"), F.col("component").alias("component2"))
    same_prefix = (placed.join(peers, "gid").filter("rep > b AND component != component2")
                   .select(F.col("rep").alias("a"), "b"))
    met = materialize(rest.union(same_prefix).distinct())  # a pair may still meet in several buckets: once from here on
    spent.append(met)
    verify(join.sketched(met.join(tried, ["a", "b"], "left_anti")).select("a", "b"))

    if paired:  # the sets of an id are one document
        first = members.groupBy("id.id").agg(F.min("rep").alias("b")).withColumnRenamed("id", "document")
        own = members.select(F.col("id.id").alias("document"), F.col("rep").alias("a")).join(first, "document")
        links = links.unionByName(own.filter("a != b").select("a", "b").distinct())
    result = components(links).withColumnRenamed("node", "rep")
    whole = members.join(result, "rep", "left").select("id", F.coalesce("component", "rep").alias("component_id"))
    document = F.col("id.id") if paired else F.col("id")
    whole = whole.groupBy(document.alias("document")).agg(F.min("component_id").alias("component_id"))
    return (rows.select("id", "n", document.alias("document")).join(whole, "document", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))
