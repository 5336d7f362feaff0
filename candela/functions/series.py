"""Ordered-series building blocks: positions, rolling frames, recursive averages.

A price series is the rows of one key (``by``, normally the ticker) ordered by
``order`` (the bar date). Indicators look back a fixed number of *rows*
(rolling frames) or recurse from the first row (exponential averages).

A plain ``Window.partitionBy(ticker)`` would give a whole ticker to one task;
a ticker can hold a third of all rows. Windows here are partitioned by
``(key, superblock)`` instead:

1. ``with_position`` numbers the rows of each series without ordering a whole
   series in one task: rows are cut into calendar chunks, chunk sizes are
   counted (partial aggregation), prefix-summed over the small chunk table and
   added to a row number inside each (key, chunk).
2. Positions are grouped into blocks and blocks into superblocks. ``scan``
   shuffles the rows once by (key, superblock); every superblock also receives
   a copy of the rows before it that rolling frames look back at (the halo).
   All windows of the pass run on that partitioning and one sort.
3. Rolling frames are ``rowsBetween`` frames over positions.
4. A recursive average ``y = q*y_prev + s`` is, inside a block that starts
   from ``C``, ``y_j = q^(j+1) C + q^j * sum_{i<=j} q^-i s_i``: a running sum.
   The local part needs no other block. The carries ``C`` of all blocks follow
   from the blocks' last local values alone, a table with one row per block:
   groups of ``FAN`` blocks are folded, then groups of groups, until one group
   holds a series, and the carries are handed down again (``block_carries``).
   Nothing is cut off: a carry holds the whole history, however small it gets.
   An average over others (the MACD signal recurses over EMA12 - EMA26) is part
   of the same linear recursion, so it needs no second pass.

All expressions are built-in functions; nothing leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.session import materialize

POS = "_pos"
BLK = "_blk"
SB = "_sb"
HALO = "_halo"
CHUNK = "_chunk"

BLOCK = 256           # positions per block (fewer where q^-BLOCK would overflow)
SUPERBLOCK = 16       # blocks per superblock
FAN = 64              # blocks folded together on each level of the carries
CHUNK_DAYS = 2048     # calendar days per numbering chunk of daily bars
CHUNK_HOURS = 2048    # hours per numbering chunk of bars with a time of day


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(other, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def with_position(df: DataFrame, by: str | Sequence[str], order: str) -> DataFrame:
    """Add ``_pos``: 0-based rank of each row inside its series.

    ``(by, order)`` must be unique (bars are) and ``order`` not NULL; a NULL
    key is a series of its own. The work per task is bounded by the rows of one
    (key, calendar chunk), independent of series length.
    """
    keys = _keys(by)
    if isinstance(df.schema[order].dataType, T.DateType):
        chunk = F.floor(F.datediff(F.col(order), F.lit("1970-01-01")) / F.lit(CHUNK_DAYS))
    else:
        chunk = F.floor(F.unix_timestamp(F.col(order).cast("timestamp")) / F.lit(3600 * CHUNK_HOURS))
    chunked = df.withColumn(CHUNK, chunk)
    sizes = chunked.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_chunk_rows"))
    before = Window.partitionBy(*keys).orderBy(CHUNK)
    offsets = sizes.select(
        *keys, CHUNK,
        (F.sum("_chunk_rows").over(before) - F.col("_chunk_rows")).alias("_chunk_offset"))
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
    return (null_safe_join(chunked, offsets, [*keys, CHUNK])
            .withColumn(POS, F.col("_chunk_offset") + F.row_number().over(inside) - 1)
            .drop(CHUNK, "_chunk_offset"))


@dataclass(frozen=True)
class Ewm:
    """One recursive average ``y = (1 - alpha) * y_prev + alpha * x``.

    ``value`` is a column, or ``{name: weight}`` over earlier averages of the
    same scan (of column values). The recursion starts at position ``start``
    with ``y = x`` (pandas ``ewm(adjust=False)`` skipping ``start`` leading
    NULLs); earlier rows give NULL. A column must be non-NULL from ``start`` on.
    """
    name: str
    value: str | dict[str, float]
    alpha: float
    start: int = 0

    @property
    def decay(self) -> float:
        return 1.0 - self.alpha

    @property
    def inputs(self) -> dict[str, float]:
        return self.value if isinstance(self.value, dict) else {}


def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def block_size(specs: Sequence[Ewm]) -> int:
    """Positions per block, such that the weights q^-j of a block stay finite."""
    least = min([s.decay for s in specs if s.decay > 0], default=1.0)
    return BLOCK if least >= 1.0 else max(1, min(BLOCK, int(250 / -math.log10(least))))


def rolling_mean(value: str, n: int):
    """pandas ``rolling(n).mean()``: NULL until ``n`` values are in the frame."""
    def build(w: Window) -> Column:
        frame = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count(F.col(value)).over(frame) == n, F.avg(F.col(value)).over(frame))
    return build


def rolling_std(value: str, n: int):
    """pandas ``rolling(n).std()`` (sample, ddof=1): NULL until ``n`` values."""
    def build(w: Window) -> Column:
        frame = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count(F.col(value)).over(frame) == n,
                      F.stddev_samp(F.col(value)).over(frame))
    return build


def lagged(value: str, k: int = 1):
    """Value ``k`` rows earlier in the series (NULL at the start)."""
    def build(w: Window) -> Column:
        return F.lag(F.col(value), k).over(w)
    return build


def _weight(decay: float, power: Column | int) -> Column:
    return F.pow(F.lit(decay), F.lit(power) if isinstance(power, int) else power)


def _carried(s: Ewm, of: Ewm, j: Column) -> Column:
    """What the carry of ``of`` adds to ``s`` at offset ``j`` of a block, for one unit."""
    q, p = s.decay, of.decay
    scale = s.alpha * s.inputs[of.name] * p
    if math.isclose(q, p):
        return F.lit(scale) * (j + 1) * _weight(q, j)
    return F.lit(scale / (q - p)) * (_weight(q, j + 1) - _weight(p, j + 1))


def _transfer(specs: Sequence[Ewm], size: int) -> list[list[float]]:
    """State at a block's end from the state at its start: a matrix."""
    by_name = {s.name: s for s in specs}
    out = []
    for s in specs:
        row = {s.name: s.decay ** size}
        for name, weight in s.inputs.items():
            q, p = s.decay, by_name[name].decay
            step = size * q ** (size - 1) if math.isclose(q, p) else (q ** size - p ** size) / (q - p)
            row[name] = s.alpha * weight * p * step
        out.append([row.get(x.name, 0.0) for x in specs])
    return out


def _power(m: list[list[float]], n: int) -> list[list[float]]:
    size = len(m)
    result = [[float(i == j) for j in range(size)] for i in range(size)]
    for _ in range(n):
        result = [[sum(result[i][k] * m[k][j] for k in range(size)) for j in range(size)] for i in range(size)]
    return result


def _next(matrix: list[list[float]], state: Column, end: Column) -> list[Column]:
    fields = []
    for i, row in enumerate(matrix):
        value = end[f"e{i}"]
        for j, weight in enumerate(row):
            if weight:
                value = value + state[f"c{j}"] * F.lit(weight)
        fields.append(value.alias(f"c{i}"))
    return fields


def block_carries(ends: DataFrame, keys: Sequence[str], matrix: list[list[float]]) -> DataFrame:
    """(keys, block, c0, c1, ...): the state before each block from 1 on.

    ``ends`` has ``BLK`` and the blocks' local end values e0, e1, ...; blocks of
    a key are numbered without gaps. A group holds at most ``FAN`` blocks, on
    every level.
    """
    m = len(matrix)
    state_type = "struct<" + ",".join(f"c{i}:double" for i in range(m)) + ">"
    values = F.struct(F.col(BLK).alias("k"), *[F.col(f"e{i}") for i in range(m)])
    groups = (ends.groupBy(*keys, F.floor(F.col(BLK) / FAN).alias("_group"))
              .agg(F.array_sort(F.collect_list(values)).alias("_ends")))
    zero = F.struct(*[F.lit(0.0).alias(f"c{i}") for i in range(m)])
    last = ends.agg(F.max(BLK)).first()[0]
    if last is not None and last >= FAN:
        groups = materialize(groups)
        top = F.aggregate("_ends", zero, lambda c, e: F.struct(*_next(matrix, c, e)))
        ends_above = (groups.filter(F.size("_ends") == FAN)
                      .select(*keys, F.col("_group").alias(BLK), top.alias("_top"))
                      .select(*keys, BLK, *[F.col(f"_top.c{i}").alias(f"e{i}") for i in range(m)]))
        above = block_carries(materialize(ends_above), keys, _power(matrix, FAN))
        above = above.select(*keys, F.col(BLK).alias("_group"), F.struct(*[f"c{i}" for i in range(m)]).alias("_start"))
        groups = null_safe_join(groups, above, [*keys, "_group"], "left")
        start = F.coalesce(F.col("_start"), zero)
    else:
        start = zero

    def step(acc: Column, e: Column) -> Column:
        state = F.struct(*_next(matrix, acc["state"], e))
        row = F.struct((e["k"] + 1).alias("k"), state.alias("c"))
        return F.struct(state.alias("state"), F.array_append(acc["rows"], row).alias("rows"))
    none = F.expr(f"cast(array() as array<struct<k:bigint,c:{state_type}>>)")
    rows = F.aggregate("_ends", F.struct(start.cast(state_type).alias("state"), none.alias("rows")), step,
                       lambda acc: acc["rows"])
    return (groups.select(*keys, F.explode(rows).alias("_row"))
            .select(*keys, F.col("_row.k").alias(BLK), "_row.c.*"))


def scan(df: DataFrame, by: str | Sequence[str], rolling: dict[str, Callable] | None = None,
         lookback: int = 0, prepare: Callable[[DataFrame], DataFrame] | None = None,
         specs: Sequence[Ewm] = (), seeds: dict[str, str] | None = None,
         history: str | None = None) -> DataFrame:
    """One pass over positioned rows: rolling frames, then recursive averages.

    ``rolling`` maps names to ``f(window) -> Column`` (window ordered by
    position) that look at most ``lookback`` rows back; ``prepare`` adds the
    averages' inputs. Output: the input columns plus all added ones; one row
    per input row.

    To continue a series, put its last rows first: ``history`` names a boolean
    column that marks them, and ``seeds`` maps averages to the columns that
    hold their values on the last one of them (NULL elsewhere).
    """
    keys = _keys(by)
    rolling = rolling or {}
    size = block_size(specs)
    halo_blocks = math.ceil(lookback / size)
    pos = F.col(POS)
    blk = F.floor(pos / size)
    offset = pos % size
    own_sb = F.floor(blk / SUPERBLOCK)
    x = df.withColumn(BLK, blk)
    if halo_blocks:
        targets = F.sequence(own_sb, F.floor((blk + halo_blocks) / SUPERBLOCK))
        x = x.withColumn(SB, F.explode(targets)).withColumn(HALO, F.col(SB) != own_sb)
    else:
        x = x.withColumn(SB, own_sb).withColumn(HALO, F.lit(False))
    # one order for all windows of the pass: blocks ascend with positions
    w_rows = Window.partitionBy(*keys, SB).orderBy(BLK, POS)
    w_block = Window.partitionBy(*keys, SB, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    if rolling:
        x = x.select("*", *[fn(w_rows).alias(name) for name, fn in rolling.items()])
    x = x.filter(~F.col(HALO)).drop(HALO)
    if prepare is not None:
        x = prepare(x)
    if not specs:
        return x.drop(BLK, SB)

    x = _local_parts(x, specs, size, w_block, seeds, history)
    x = materialize(x.drop(SB))  # read by the blocks' ends and by the rows
    ends = x.filter(offset == size - 1).select(*keys, BLK, *[F.col(_local(i)).alias(f"e{i}") for i in range(len(specs))])
    carries = block_carries(ends, keys, _transfer(specs, size))
    x = null_safe_join(x, carries, [*keys, BLK], "left")
    return _whole(x, specs, size, [F.coalesce(F.col(f"c{i}"), F.lit(0.0)) for i in range(len(specs))],
                  [f"c{i}" for i in range(len(specs))])


def _local(i: int) -> str:
    return f"_local_{i}"


def _local_parts(x: DataFrame, specs: Sequence[Ewm], size: int, w_block: Window, seeds: dict[str, str] | None,
                 history: str | None) -> DataFrame:
    """``x`` with each average as it is if its block starts from zero."""
    pos, offset = F.col(POS), F.col(POS) % size
    names = {s.name: _local(i) for i, s in enumerate(specs)}
    for layer in ([s for s in specs if not s.inputs], [s for s in specs if s.inputs]):
        columns = []
        for s in layer:
            v = (sum((F.col(names[n]) * F.lit(w) for n, w in s.inputs.items()), F.lit(0.0)) if s.inputs
                 else F.col(s.value).cast("double"))
            term = (F.when(pos < s.start, F.lit(0.0)).when(pos == s.start, v).otherwise(F.lit(s.alpha) * v))
            if history is not None:
                seed = F.col(seeds[s.name]) if seeds and s.name in seeds else F.lit(None).cast("double")
                term = F.when(F.col(history), F.coalesce(seed, F.lit(0.0))).otherwise(term)
            y = (term if s.decay == 0 else
                 _weight(s.decay, offset) * F.sum(term * _weight(s.decay, -offset)).over(w_block))
            columns.append(y.alias(names[s.name]))
        if columns:
            x = x.select("*", *columns)
    return x


def _whole(x: DataFrame, specs: Sequence[Ewm], size: int, carry: list[Column], helpers: Sequence[str]) -> DataFrame:
    """The averages from their local parts and the carries of their blocks."""
    pos, offset = F.col(POS), F.col(POS) % size
    number = {s.name: i for i, s in enumerate(specs)}
    out = []
    for i, s in enumerate(specs):
        y = F.col(_local(i)) + _weight(s.decay, offset + 1) * carry[i]
        for name in s.inputs:
            y = y + _carried(s, specs[number[name]], offset) * carry[number[name]]
        out.append(F.when(pos >= s.start, y).alias(s.name))
    kept = [c for c in x.columns if c not in (BLK, *helpers, *[_local(i) for i in range(len(specs))])]
    return x.select(*kept, *out)


def bounded_scan(df: DataFrame, by: str | Sequence[str], order: str, rolling: dict[str, Callable] | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None, specs: Sequence[Ewm] = (),
                 seeds: dict[str, str] | None = None, history: str | None = None) -> DataFrame:
    """:func:`scan` in one plan, with nothing stored: one shuffle by ``by``, for series that the calendar bounds.

    A series goes to one task, so this is for a micro-batch of daily bars (unique
    by key and day), where a series has a row for each day at most. The blocks'
    end values of a series are one array, folded up to the row's block.
    """
    keys = _keys(by)
    size = block_size(specs)
    x = df.withColumn(POS, (F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1).cast("long"))
    x = x.withColumn(BLK, F.floor(F.col(POS) / size))
    w_rows = Window.partitionBy(*keys).orderBy(BLK, POS)
    w_block = Window.partitionBy(*keys, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    if rolling:
        x = x.select("*", *[fn(w_rows).alias(name) for name, fn in rolling.items()])
    if prepare is not None:
        x = prepare(x)
    if not specs:
        return x.drop(BLK)
    x = _local_parts(x, specs, size, w_block, seeds, history)
    end = F.struct(F.col(BLK).alias("k"), *[F.col(_local(i)).alias(f"e{i}") for i in range(len(specs))])
    whole = Window.partitionBy(*keys).orderBy(BLK, POS).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = x.select("*", F.collect_list(F.when(F.col(POS) % size == size - 1, end)).over(whole).alias("_ends"))
    zero = F.struct(*[F.lit(0.0).alias(f"c{i}") for i in range(len(specs))])
    matrix = _transfer(specs, size)
    before = F.slice("_ends", F.lit(1), F.col(BLK).cast("int"))  # the blocks before this one
    x = x.select("*", F.aggregate(before, zero, lambda c, e: F.struct(*_next(matrix, c, e))).alias("_carry")).drop("_ends")
    return _whole(x, specs, size, [F.col("_carry")[f"c{i}"] for i in range(len(specs))], ["_carry"])


def rolling(df: DataFrame, by: str | Sequence[str], columns: dict[str, Callable],
            halo: int) -> DataFrame:
    """Window expressions that look at most ``halo`` rows back (see ``scan``)."""
    return scan(df, by, columns, lookback=halo)


def ewm(df: DataFrame, by: str | Sequence[str], specs: Sequence[Ewm]) -> DataFrame:
    """Recursive averages of ``specs`` over positioned rows (see ``scan``)."""
    return scan(df, by, specs=specs)
