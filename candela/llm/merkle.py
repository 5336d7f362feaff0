"""Merkle manifest of a table: time-forward processing up the trees, a reversed sweep down.

A row's leaf digest is the SHA-256 of its fields (each ``-`` if null, else
UTF-8 byte count, ``:``, value). The leaves of a group, in the order of their
ids, form a tree of ``fan`` children a node up to the group's subroot (a single
leaf is its own); the subroots, in the order of the groups, form one more tree
up to the root. A digest of digests is the SHA-256 of their hex texts.

Up: nodes are labelled so that children come before their parents (by the last
leaf below them, then by level). A task goes through its nodes in label order;
a node's digest is sent to its parent through a priority queue ordered by the
receiver's label, and a parent takes all messages that bear its label. A task
holds ``levels`` levels below one ancestor, ``fan ** levels`` leaves at most,
and its queue one open path, ``fan * levels`` messages. Between tasks the queue
is external: the messages to what lies above are a written table, shuffled by
the next ancestor and sorted by label. So a tree takes as many rounds as its
height divided by ``levels``, whatever the size of a group.

Down: the same tasks in reversed label order. A node knows its children's
digests from the way up and sends each child what its proof ends with: the
siblings of this level, then its own suffix. A suffix leaves a task only for the
roots of the tasks below.

Numbering: leaves are ranged by (group, id, digest, row number) into sorted
partitions, so that no task holds a group; rows are numbered within a
partition, and partitions are summed per group.

Null groups come first, as do null ids. Rows of one id are ordered by digest;
rows that repeat are leaves of their own. Texts of any length are hashed as
they are; an empty text is ``0:``. An empty table has no leaf and no root.
Input columns other than the fields, the group and the key are not read, so
names may clash with those of results.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.session import materialize

FAN = 16
LEVELS = 3           # levels a task goes up: 4096 leaves at most


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def encoded(c: Column) -> Column:
    """``-`` if null, else the UTF-8 byte count, ``:`` and the value as text."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def height(n: int, fan: int = FAN) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // fan), h + 1
    return h


# ------------------------------------------------------------------ numbering

def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows with ``pos`` (0-based in the group by ``order``) and ``size`` (rows of the group).

    ``order`` must tell all rows apart. Nulls come first.
    """
    ranged = (rows.repartitionByRange(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
              .sortWithinPartitions(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
              .withColumn("part", F.spark_partition_id()))
    at = ranged.columns.index(group)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields) + ", inside long"

    def count(batches):
        last, n = None, 0
        for batch in batches:
            inside = []
            for g in batch.column(at).to_pylist():
                if (g,) != last:
                    last, n = (g,), 0
                inside.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inside, pa.int64())],
                                             names=[*batch.schema.names, "inside"])
    ranged = materialize(ranged.mapInArrow(count, schema))
    # one row for each partition that a group reaches
    sizes = ranged.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("part")
    sums = sizes.select(F.col(group).alias("_group"), F.col("part").alias("_part"),
                        (F.sum("n").over(before) - F.col("n")).alias("before"),
                        F.sum("n").over(Window.partitionBy(group)).alias("size"))
    return (ranged.join(sums, F.col(group).eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part")))
            .withColumn("pos", F.col("before") + F.col("inside"))
            .drop("_group", "_part", "before", "inside", "part"))


# ------------------------------------------------------------------- sweeping

def label(level: int, idx: int, size: int, fan: int) -> tuple[int, int]:
    """Children have smaller labels than their parent: (last leaf below, level)."""
    return min((idx + 1) * fan ** level, size) - 1, level


def rise(nodes, size: int, top: int, fan: int):
    """Go up from ``nodes`` ``(level, idx, digest)`` of a tree of ``size`` leaves, sorted by label, to level ``top``.

    Yields ``(level, idx, children)`` of each node above them in label order.
    The queue holds ``(label of the receiver, index of the sender, digest)``.
    """
    queue: list = []

    def send(level, idx, text):
        if level < top:
            heapq.heappush(queue, (label(level + 1, idx // fan, size, fan), idx, text))

    def receivers(until):
        while queue and (until is None or queue[0][0] < until):
            turn = queue[0][0]
            parent = turn[1], queue[0][1] // fan
            children = []
            while queue and queue[0][0] == turn:
                children.append(heapq.heappop(queue)[2])
            yield (*parent, "".join(children))
            send(*parent, digest(*children))
    for level, idx, text in nodes:
        yield from receivers(label(level, idx, size, fan))
        send(level, idx, text)
    yield from receivers(None)


def descend(nodes, size: int, suffix: str, top: int, fan: int):
    """Reversed sweep over ``nodes`` ``(level, idx, children or None, ...)`` by falling label from level ``top``.

    ``suffix`` is that of the part's highest node. Yields ``(node, suffix)`` of
    nodes without children. The queue holds ``(negated label of the receiver, suffix)``.
    """
    queue: list = []
    for node in nodes:
        level, idx, children = node[:3]
        mine = suffix if level == top else heapq.heappop(queue)[1]
        if children is None:
            yield node, mine
            continue
        for k in range(len(children) // 64):
            end, below = label(level - 1, idx * fan + k, size, fan)
            heapq.heappush(queue, ((-end, -below), children[:64 * k] + children[64 * (k + 1):] + mine))


def fold(leaf: str, pos: int, size: int, proof: str, fan: int) -> tuple[str, str]:
    """(root of the tree that ``leaf`` and the siblings at the beginning of ``proof`` give, rest of ``proof``)."""
    while size > 1:
        first = pos - pos % fan
        here, many = pos - first, min(fan, size - first) - 1
        leaf = digest(proof[:64 * here], leaf, proof[64 * here:64 * many])
        proof = proof[64 * many:]
        pos, size = pos // fan, -(-size // fan)
    return leaf, proof


def _parts(batches, key: int):
    """(key, iterator of rows without it) of consecutive rows whose first ``key`` columns are equal."""
    rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
    for k, part in groupby(rows, lambda r: r[:key]):
        yield k, (r[key:] for r in part)


def _batches(rows, names: Sequence[str], kinds: Sequence[pa.DataType], many: int):
    while part := list(islice(rows, many)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], names=list(names))


_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def _sweep(rows: DataFrame, key: int, fn, ddl: str, many: int) -> DataFrame:
    """``fn(key, rows)`` gives result rows for each part of sorted ``rows``."""
    names, kinds = zip(*[f.split() for f in ddl.split(", ")])
    types = [_KINDS.get(k) for k in kinds]
    if None in types:  # the key's own type
        from pyspark.sql.pandas.types import to_arrow_type
        from pyspark.sql.types import StructType
        types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(ddl).fields]

    def run(batches):
        yield from _batches((r for k, part in _parts(batches, key) for r in fn(k, part)), names, types, many)
    return rows.mapInArrow(run, ddl)


def _height(size: Column, fan: int, most: int) -> Column:
    """``min(height(size), most)`` as a column."""
    out = F.lit(0)
    for h in range(1, most + 1):
        out = F.when(size > F.lit(fan ** (h - 1)), F.lit(h)).otherwise(out)
    return out


def up(leaves: DataFrame, fan: int = FAN, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """(nodes above ``leaves`` (grp, pos, size, leaf) by round, (grp, size, subroot) of each group)."""
    tallest = leaves.agg(F.max("size")).first()[0]
    now = leaves.select("grp", F.col("pos").alias("idx"), "size", F.col("leaf").alias("digest"))
    roots = now.filter("size = 1").select("grp", "size", F.col("digest").alias("subroot"))
    rounds: list[DataFrame] = []
    for base in range(0, height(tallest or 0, fan), levels):
        last = base + levels

        def sweep(key, part, base=base, last=last):
            grp, block, size = key
            for level, idx, children in rise(((base, i, d) for i, d in part), size, min(last, height(size, fan)), fan):
                yield grp, block, size, level, idx, children, digest(children)
        parts = (now.filter(F.col("size") > fan ** base)
                 .select("grp", F.floor(F.col("idx") / fan ** levels).alias("block"), "size", "idx", "digest")
                 .repartition("grp", "block").sortWithinPartitions("grp", "block", "idx"))
        risen = materialize(_sweep(parts, 3, sweep, "grp string, block long, size long, level int, idx long, "
                                                    "children string, digest string", 512))
        rounds.append(risen)
        highest = risen.filter(F.col("level") == _height(F.col("size"), fan, last))
        roots = roots.unionByName(highest.filter(F.col("size") <= fan ** last)
                                  .select("grp", "size", F.col("digest").alias("subroot")))
        now = highest.filter(F.col("size") > fan ** last).select("grp", "idx", "size", "digest")
    return rounds, roots


def down(rounds: list[DataFrame], leaves: DataFrame, tops: DataFrame, finish, ddl: str, fan: int = FAN,
         levels: int = LEVELS) -> DataFrame:
    """Rows that ``finish(leaf row, head, suffix)`` gives for each of ``leaves``.

    ``leaves`` begins with grp, size, pos; ``tops`` (grp, size, suffix, gpos, groups,
    subroot) has one row for each group. ``head`` is (grp, size, gpos, groups, subroot).
    """
    carried = leaves.columns[3:]
    none = [F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in carried]
    tops = tops.withColumn("tall", _height(F.col("size"), fan, len(rounds) * levels))
    above = None
    for k in range(max(len(rounds), 1) - 1, -1, -1):
        base, last = k * levels, (k + 1) * levels
        # the first row of a part holds what its highest node gets from above
        heads = (tops.filter((F.col("tall") > base) & (F.col("tall") <= last) | (F.lit(k == 0) & (F.col("tall") == 0)))
                 .select("grp", F.lit(0).cast("long").alias("block"), "size", "suffix", "gpos", "groups", "subroot"))
        if above is not None:
            heads = heads.unionByName(above.withColumnRenamed("idx", "block"))
        heads = heads.select("grp", "block", "size", F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("idx"),
                             F.col("suffix").alias("children"), "gpos", "groups", "subroot", *none)
        plain = [F.lit(None).cast("long").alias("gpos"), F.lit(None).cast("long").alias("groups"),
                 F.lit(None).cast("string").alias("subroot")]
        block = F.floor(F.col("idx") / fan ** levels).alias("block")
        rows = heads
        if rounds:
            rows = rows.unionByName(rounds[k].select("grp", "block", "size", "level", "idx", "children", *plain, *none))
        ground = (leaves.withColumnRenamed("pos", "idx").select("grp", block, "size", "idx", *carried) if k == 0 else
                  rounds[k - 1].filter((F.col("level") == base) & (F.col("size") > fan ** base))
                  .select("grp", block, "size", "idx", *none))
        rows = rows.unionByName(ground.select("grp", "block", "size", F.lit(base).alias("level"), "idx",
                                              F.lit(None).cast("string").alias("children"), *plain, *carried))
        width = F.lit(0).cast("long")
        for lv in range(last, base - 1, -1):
            width = F.when(F.col("level") == lv, F.lit(fan ** lv).cast("long")).otherwise(width)
        end = F.when(F.col("level").isNull(), F.col("size")).otherwise(
            F.least((F.col("idx") + 1) * width, F.col("size")) - 1)
        parts = (rows.withColumn("end", end).repartition("grp", "block")
                 .sortWithinPartitions("grp", "block", F.col("end").desc(), F.col("level").desc())
                 .select("grp", "block", "size", "level", "idx", "children", "gpos", "groups", "subroot", *carried))

        def sweep(key, part, base=base, last=last, k=k):
            grp, _block, size = key
            _level, _idx, suffix, gpos, groups, subroot = next(part)[:6]
            head = (grp, size, gpos, groups, subroot)
            for node, mine in descend(part, size, suffix, min(last, height(size, fan)), fan):
                if k == 0:
                    yield finish((node[1], *node[6:]), head, mine)
                else:
                    yield grp, node[1], size, mine, gpos, groups, subroot
        if k:
            above = materialize(_sweep(parts, 3, sweep, "grp string, idx long, size long, suffix string, gpos long, "
                                                        "groups long, subroot string", 256))
    return _sweep(parts, 3, sweep, ddl, 2048)


def manifest(rows: DataFrame, key: str, group: str, fields: Sequence[str], tampered: dict[str, Column] | None = None,
             where: Column | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    ``proof_sha256`` is the digest of the row's siblings, level by level via the
    subroot to the root. ``folded_root`` is the root that these siblings give
    with the row's leaf, where ``tampered`` replaces fields of the rows that
    satisfy ``where``; ``verified`` says whether that is the root.
    """
    shown = leaf_digest([F.col(c) for c in fields])
    if tampered:
        changed = leaf_digest([tampered.get(c, F.col(c)) for c in fields])
        shown = F.when(F.coalesce(where, F.lit(False)), changed).otherwise(shown)
    # written before it is ranged: the row number must stay when tasks run again
    made = materialize(rows.select(F.col(key).alias("key"), F.col(group).cast("string").alias("grp"),
                                   leaf_digest([F.col(c) for c in fields]).alias("leaf"), shown.alias("shown"),
                                   F.monotonically_increasing_id().alias("number")))
    leaves = materialize(numbered(made, "grp", ["key", "leaf", "number"]).drop("number"))
    rounds, subroots = up(leaves, fan, levels)
    subroots = materialize(subroots)
    # one more tree, over the subroots
    forest = materialize(numbered(subroots.select(F.lit("").alias("all"), F.col("grp").alias("name"), "subroot",
                                                  F.col("size").alias("leaves")), "all", ["name"]))
    crown = forest.select(F.col("all").alias("grp"), "size", "pos", "name", "leaves", F.col("subroot").alias("leaf"))
    crown_rounds, top = up(crown, fan, levels)
    root = top.select("subroot").collect()  # one row
    crown_top = top.select("grp", "size", F.lit("").alias("suffix"), F.lit(0).cast("long").alias("gpos"),
                           F.lit(1).cast("long").alias("groups"), "subroot")
    tops = materialize(down(crown_rounds, crown, crown_top, lambda leaf, head, suffix:
                            (leaf[1], leaf[2], suffix, leaf[0], head[1], leaf[3]),
                            "grp string, size long, suffix string, gpos long, groups long, subroot string", fan, levels))
    root = root[0][0] if root else None
    kind = leaves.schema["key"].dataType.simpleString()

    def prove(leaf, head, suffix):
        pos, own_key, own, given = leaf
        _grp, size, gpos, groups, subroot = head
        sub, rest = fold(given, pos, size, suffix, fan)
        folded, _ = fold(sub, gpos, groups, rest, fan)
        return own_key, own, subroot, digest(suffix), folded
    proved = down(rounds, leaves.select("grp", "size", "pos", "key", "leaf", "shown"), tops, prove,
                  f"key {kind}, leaf string, subroot string, proof_sha256 string, folded_root string", fan, levels)
    whole = F.lit(root).cast("string")
    return proved.select(F.col("key").alias(key), "leaf", "subroot", whole.alias("root"), "proof_sha256", "folded_root",
                         (F.col("folded_root") == whole).alias("verified"))
