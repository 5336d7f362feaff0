"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are divided in halves; each half has a codebook of ``k``
centroids, fitted by k-means on a bounded sample (``sample`` vectors with the
smallest hashes of their ids). The ``k * k`` pairs of centroids are the cells
of the index, which holds every vector. For a query, a multi-sequence
traversal visits cells in the order of a lower bound of their distance: for
each half, the distance to the plane between the query's own centroid and the
cell's. It ends where the bound exceeds a reach fitted for the ``recall`` that
is wanted: neighbours at exactly the linking cosine are drawn in random
directions around sample vectors, and the reach covers the cells of that share
of them. Nearer neighbours are found more often. With ``recall`` 1 the reach is
the linking distance itself, beyond which no linked vector can lie.

Equal vectors are collapsed to one with a count before. A cell's members are
dealt to blocks of about ``block`` vectors and its visitors to blocks of about
four times as many; a join of blocks on the cell gives matrix products of
bounded size, whatever a cell holds. A product gives each vector's number of
links and a spanning forest of its links, never all pairs. Cosines are
computed in double precision, and only those of at least ``threshold`` count.

Vectors link within their length only: each length that two different vectors
have gets an index of its own, fitted on a sample of its own, and its own range
of cell numbers, so that all are joined at once. Fitting takes a small job for
each length.

Vectors that are null, zero, have a null id, or hold null or non-finite
components link with nothing. Repeated rows are equal vectors. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.components import components
from candela.llm.textops import arrow_rows
from candela.session import materialize


def unit(rows, dim: int) -> np.ndarray:
    x = np.asarray(rows, np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(11)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return _squares(x, centres).argmin(1)


class MultiIndex:
    """Codebooks of the two halves and the traversal of their product grid."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.books = [_kmeans(sample[:, :self.half], k), _kmeans(sample[:, self.half:], k)]
        self.k = len(self.books[0])
        self.gaps = [np.sqrt(_squares(c, c)) for c in self.books]

    def _halves(self, x):
        return x[:, :self.half], x[:, self.half:]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_nearest(h, c) for h, c in zip(self._halves(x), self.books))
        return a * self.k + b

    def bounds(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The lower bound from each x to the cell of its y."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for a, b, c, gap in zip(self._halves(x), self._halves(y), self.books, self.gaps):
            d, to = _squares(a, c), _nearest(b, c)
            near = d.argmin(1)
            between = gap[near, to]
            plane = (d[rows, to] - d[rows, near]) / np.where(between > 0, 2 * between, np.inf)
            total += np.maximum(plane, 0) ** 2
        return np.sqrt(total)

    def visits(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, cell) of all visits to the own cell and those after it, and the own cells."""
        orders, lists = [], []
        own = np.zeros(len(x), np.int64)
        for h, c, gap in zip(self._halves(x), self.books, self.gaps):
            d = _squares(h, c)
            near = d.argmin(1)
            own = own * self.k + near
            rows = np.arange(len(x))
            between = gap[near]
            plane = (d - d[rows, near][:, None]) / np.where(between > 0, 2 * between, np.inf)
            lower = np.maximum(plane, 0) ** 2
            order = np.argsort(lower, axis=1, kind="stable")
            orders.append(order)
            lists.append(np.take_along_axis(lower, order, 1))
        query, cell, limit = [], [], reach * reach + 1e-9
        for q in range(len(x)):
            a, b, ia, ib = lists[0][q], lists[1][q], orders[0][q], orders[1][q]
            heap = [(a[0] + b[0], 0, 0)]
            while heap:
                bound, i, j = heapq.heappop(heap)
                if bound > limit:
                    break
                at = int(ia[i]) * self.k + int(ib[j])
                if at >= own[q]:
                    query.append(q)
                    cell.append(at)
                # each cell is pushed once: along j, and along i from the first column
                if j + 1 < self.k:
                    heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
                if j == 0 and i + 1 < self.k:
                    heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return np.array(query, np.int64), np.array(cell, np.int64), own


def _forest(n_left: int, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each of the nodes 0.. reaches by the links left - n_left + right."""
    label = ids.copy()
    other = right + n_left
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[other])
        np.minimum.at(label, left, low)
        np.minimum.at(label, other, low)
        if np.array_equal(label, before):
            return label


def fitted_reach(index: MultiIndex, sample: np.ndarray, threshold: float, recall: float) -> float:
    """The bound within which a share ``recall`` of neighbours at the threshold have their cells."""
    widest = float(np.sqrt(2 - 2 * threshold))
    if recall >= 1:
        return widest
    rng = np.random.default_rng(5)
    x = sample[rng.integers(0, len(sample), 20_000)]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    bound = index.bounds(x, threshold * x + np.sqrt(1 - threshold ** 2) * side)
    return min(widest, float(np.quantile(bound, recall)))


def links(vectors: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding",
          k: int | None = None, sample: int = 20_000, block: int = 512,
          recall: float = 0.999) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups of equal vectors, link counts, forest edges); see :func:`near_duplicates`.

    The first has rep, copies and the vector; the second rep and n_links to
    vectors that differ; the third edges (a, b) that connect what is linked.
    """
    spark = vectors.sparkSession
    good = (F.col(vector).isNotNull() & (F.size(vector) > 0)
            & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(vector, lambda x: x != 0))
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("x")).filter(good & F.col("id").isNotNull())
    groups = materialize(rows.groupBy("x").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    totals = {r[0]: r[1] for r in groups.groupBy(F.size("x")).count().filter("count > 1").collect()}
    if not totals:
        return groups, spark.createDataFrame([], "rep long, n_links long"), spark.createDataFrame([], "a long, b long")
    indexes, base = {}, 0  # by length: the index, its reach and the number of its first cell
    for dim, total in sorted(totals.items()):
        picked = groups.filter(F.size("x") == dim).orderBy(F.xxhash64("rep")).limit(sample).select("x").collect()
        fitted = unit([r[0] for r in picked], dim)
        made = MultiIndex(fitted, k or int(min(512, max(4, round(total ** 0.5 / 6)))))
        indexes[dim] = made, fitted_reach(made, fitted, threshold, recall), base
        base += made.k ** 2
    index = spark.sparkContext.broadcast(indexes)

    def locate(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                whole = batch.slice(a, 256)
                dims = whole.column(2).value_lengths().to_numpy()
                for dim in np.unique(dims).tolist():
                    if dim not in index.value:
                        continue
                    made, reach, first = index.value[dim]
                    part = whole.take(pa.array(np.flatnonzero(dims == dim)))
                    flat = part.column(2).flatten().to_numpy()
                    query, cell, own = made.visits(unit(flat, dim), reach)
                    at = pa.array(query)
                    raw = [v.tobytes() for v in flat.reshape(-1, dim)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[query] == cell), pa.array(cell + first), part.column(0).take(at),
                         part.column(1).take(at), pa.array(raw, pa.binary()).take(at)],
                        names=["inside", "cell", "id", "copies", "x"])
    kind = np.float32 if groups.schema["x"].dataType.elementType.simpleString() == "float" else np.float64
    visits = materialize(groups.select("rep", "copies", "x").mapInArrow(
        locate, "inside boolean, cell long, id long, copies long, x binary"))
    sizes = visits.groupBy("cell").agg(F.ceil(F.count("*") / (4 * block)).alias("all_parts"),
                                       F.greatest(F.lit(1), F.ceil(F.sum(F.col("inside").cast("int")) / block)).alias("parts"))
    dealt = materialize(visits.join(sizes, "cell"))  # one row a cell: at most k * k a length

    def blocks(rows: DataFrame, parts: str, *fields: str) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.col(parts)).alias("part")
        return rows.groupBy("cell", part).agg(F.collect_list(F.struct(*fields)).alias("rows")).drop("part")
    visitors = blocks(dealt, "all_parts", "id", "copies", "x", "inside")
    members = blocks(dealt.filter("inside"), "parts", "id", "copies", "x").withColumnRenamed("rows", "members")

    def multiply(batches):
        def arrays(column, i):
            s = column[i].values
            raw = s.field("x").to_pylist()  # a cell's vectors have one length
            x = np.frombuffer(b"".join(raw), kind)
            return (s.field("id").to_numpy(), s.field("copies").to_numpy(), unit(x, len(x) // len(raw)), s)
        for batch in batches:
            for i in range(batch.num_rows):
                a, n, x, s = arrays(batch.column(0), i)
                b, m, y, _ = arrays(batch.column(1), i)
                inside = s.field("inside").to_numpy(zero_copy_only=False)
                linked = (x @ y.T >= threshold) & (a[:, None] != b[None, :])
                left, right = np.nonzero(linked)
                if not len(left):
                    continue
                # a visitor from the same cell is a member as well and counts its links itself
                once = ~inside[left]
                count = np.concatenate([np.bincount(left, m[right], len(a)),
                                        np.bincount(right[once], n[left[once]], len(b))]).astype(np.int64)
                ids = np.concatenate([a, b])
                label = _forest(len(a), left, right, ids)
                found = (count > 0) | (label != ids)
                yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(count[found]), pa.array(label[found])],
                                                 names=["rep", "n", "root"])
    with arrow_rows(spark, 16):  # blocks are large
        found = materialize(visitors.join(members, "cell").select("rows", "members")
                            .mapInArrow(multiply, "rep long, n long, root long"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n_links"))
    return groups, counts, found.select(F.col("rep").alias("a"), F.col("root").alias("b"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, key: str = "vec_id",
                    vector: str = "embedding", **index) -> DataFrame:
    """(key, n_links, component_id, kept) of each vector: others linked directly, smallest id reached."""
    groups, counts, edges = links(vectors, threshold, key, vector, **index)
    reps = (groups.select("x", "rep", "copies").join(counts, "rep", "left")
            .join(components(edges).withColumnsRenamed({"node": "rep"}), "rep", "left"))
    rows = vectors.select(F.col(key).alias("id"), F.when(F.col(key).isNotNull(), F.col(vector)).alias("x"))
    return (rows.join(reps, "x", "left")
            .withColumn("component_id", F.coalesce("component", "rep", "id"))
            .select(F.col("id").alias(key),
                    (F.coalesce("n_links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
                    "component_id", (F.col("id") == F.col("component_id")).alias("kept")))
