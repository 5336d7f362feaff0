"""Spelling variants: words one edit apart, joined by pivotal bigrams.

**Words.** Maximal runs of ASCII and Latin-1 letters, A-Z lower-cased, are found
and counted on whole Arrow columns; a task merges its counts before they are
shuffled. ``slips`` optionally deletes a code point of some runs (a reproducible
misspelling, by a checksum of the id and the run).

**Pivots.** All bigrams of a word are ordered from rare to frequent; the
alphabet bounds their number (8,100), so the order is broadcast. The prefix of
a word is its first three bigrams in this order (with repetitions of the
third). One edit touches two bigrams at most, so two disjoint ones of the
prefix, chosen by dynamic programming for the least total frequency, can't both
be lost: of two words within one edit, a pivot of the word whose prefix ends
earlier is in the other's prefix.

**Join.** Pivots meet prefix bigrams under position limits: the edit lies left
or right of the bigram that both words share, so it stands at the same distance
from the beginning or from the end. Of the side with the edit, one half is
untouched as well. A key is the digest of all that must be equal then (bigram,
position, both lengths, the untouched side and half), so words meet only if
about half of their letters agree in place. No pair within one edit is lost:
each case of length, side and half has a key of its own. Met pairs are verified
by edit distance.

**Groups.** A word's form is its near word of largest count (ties: the smallest
in code-point order) if that count is at least ``ratio`` times its own; its root
is where forms end. Counts rise ``ratio``-fold along forms, so paths are short,
and pointers double in each round.

Null texts have no words; a null id counts as an empty one in ``slips``. Rows
that repeat count again. Very long texts are read in pieces cut where no word
is; a single run stays whole, however long. Empty tables give no words. Only the
id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.textops import chunks, lower_ascii, slices, utf8_column
from candela.session import materialize

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
MERGE_WORDS = 200_000   # words a task counts before it sends them
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_C3 = 0xC3               # the lead byte of U+00C0 to U+00FF, and of no other code point
_OTHER = ~_LETTER        # bytes that begin a code point which is no letter here
_OTHER[128:0xC2] = _OTHER[_C3] = False
_FOLD = lower_ascii()


def _cut(data: np.ndarray, lo: int, hi: int) -> int | None:
    at = np.flatnonzero(_OTHER[data[lo:hi]])
    return lo + int(at[-1]) if len(at) else None


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def checksums(start: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of ``data[starts:starts + lengths]`` continued from the crc32 values ``start``."""
    out = start.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-lengths, kind="stable")
    long = int(np.searchsorted(-lengths[order], -64, "left"))  # above 64 bytes: one by one
    for k in order[:long]:
        s = int(starts[k])
        out[k] = zlib.crc32(data[s:s + int(lengths[k])].tobytes(), int(start[k])) ^ 0xFFFFFFFF
    order = order[long:]
    state, at, left = out[order], starts[order], -lengths[order]
    for k in range(int(-left[0]) if len(left) else 0):
        n = int(np.searchsorted(left, -k, "left"))  # words longer than k come first
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + k]) & 255] ^ (state[:n] >> 8)
    out[order] = state
    return out ^ np.uint32(0xFFFFFFFF)


def _piece_words(keys: list, rows, starts, part: np.ndarray, slips: int | None, least: int):
    """(words, counts) of a piece of the text column."""
    c3 = part == _C3
    inside = _LETTER[part] | c3
    inside[1:] |= c3[:-1]
    first = np.zeros(len(part), bool)
    first[starts] = True
    begin = inside & first
    begin[1:] |= inside[1:] & ~inside[:-1]
    at = np.flatnonzero(begin)
    if not len(at):
        return None
    letters = _FOLD[part[inside]]
    # runs stand in ``letters`` without gaps
    place = (np.cumsum(inside) - 1)[at]
    lengths = np.diff(place, append=len(letters))
    more = np.concatenate([[0], np.cumsum((letters & 0xC0) == 0x80)])  # bytes that continue a code point
    points = lengths - (more[place + lengths] - more[place])
    slipped: Counter = Counter()
    keep = points >= least
    if slips:
        row = rows[np.searchsorted(starts, at, "right") - 1]
        crc = checksums(np.array([zlib.crc32(f"{k}:".encode()) for k in keys], np.uint32)[row], letters, place, lengths)
        hit = crc % slips == 0
        keep &= ~hit
        for k in np.flatnonzero(hit & (points > least)):
            run = letters[place[k]:place[k] + lengths[k]].tobytes().decode()
            gone = int(crc[k]) % len(run)
            slipped[run[:gone] + run[gone + 1:]] += 1
    offsets = np.concatenate([[0], np.cumsum(lengths[keep])]).astype(np.int32)
    data = letters[np.repeat(keep, lengths)]
    words = pa.StringArray.from_buffers(int(keep.sum()), pa.py_buffer(offsets), pa.py_buffer(data))
    found = pc.value_counts(words)
    return (pa.concat_arrays([found.field(0), pa.array(list(slipped), pa.string())]),
            pa.concat_arrays([found.field(1), pa.array(list(slipped.values()), pa.int64())]))


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", slips: int | None = None,
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points and ``min_count`` occurrences."""
    def run(batches):
        held: list = []

        def merged(tables):
            t = pa.Table.from_arrays([pa.chunked_array([w for w, _ in tables]), pa.chunked_array([n for _, n in tables])],
                                     names=["word", "n"]).group_by("word").aggregate([("n", "sum")])
            t = t.combine_chunks()
            return [(t.column("word").combine_chunks(), t.column("n_sum").combine_chunks())]
        many = 0
        for whole in batches:
            for batch in slices(whole, 1):
                keys = ["" if k is None else k for k in batch.column(0).to_pylist()]
                data, offsets = utf8_column(batch.column(1))
                for rows, starts, a, b in chunks(data, offsets, cut=_cut):
                    found = _piece_words(keys, rows, starts, data[a:b], slips, min_length)
                    if found is not None:
                        held.append(found)
                        many += len(found[0])
                if many > MERGE_WORDS:
                    held = merged(held)
                    many = len(held[0][0])
                    if many > MERGE_WORDS // 2:
                        yield pa.RecordBatch.from_arrays(list(held[0]), names=["word", "n"])
                        held, many = [], 0
        for words, n in merged(held) if held else []:
            yield pa.RecordBatch.from_arrays([words, n], names=["word", "n"])
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).filter("text IS NOT NULL")
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


# ---------------------------------------------------------------------- pivots

def ordered_grams(word: str, rank: dict[str, tuple]) -> list[tuple[tuple, int]]:
    """(rank, position) of the bigrams in the prefix."""
    grams = sorted((rank[word[i:i + 2]], i) for i in range(len(word) - 1))
    return [g for g in grams if g[0] <= grams[2][0]]


def choose_pivots(prefix: list[tuple[tuple, int]]) -> list[tuple[tuple, int]]:
    """The two disjoint bigrams of ``prefix`` with the least total frequency."""
    by_place = sorted(prefix, key=lambda g: g[1])
    rarest: list = []   # of the bigrams up to this one
    best, least = [], None
    for k, g in enumerate(by_place):
        last = k - 1 if k and by_place[k - 1][1] <= g[1] - 2 else k - 2  # the last one that g doesn't overlap
        if last >= 0:
            total = rarest[last][0][0] + g[0][0]
            if least is None or total < least:
                best, least = [rarest[last], g], total
        rarest.append(min(rarest[-1], g) if rarest else g)
    return best


def gram_keys(word: str, at: int) -> list[int]:
    """Digests of what a word within one edit must share, if it shares the bigram at ``at``."""
    n, out = len(word), []
    for other in (n - 1, n, n + 1):
        lengths = f"{min(n, other)},{max(n, other)}"
        room = min(n, other) - at - 2          # the edit is to the right
        if room >= (n == other):
            half = room // 2
            out.append(f"r{lengths},{at}|{word[:at + 2 + half]}")
            out.append(f"R{lengths},{at}|{word[:at + 2]}|{word[n - (room - half):]}")
        room = min(at, at + other - n)          # the edit is to the left
        if room >= (n == other):
            half = room // 2
            out.append(f"l{lengths},{n - at}|{word[at - half:]}")
            out.append(f"L{lengths},{n - at}|{word[:room - half]}|{word[at:]}")
    return [xxhash.xxh64_intdigest(k.encode()) - (1 << 63) for k in out]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of ``words`` (word, n) exactly one edit apart.

    Words have at least four code points; each occurs once.
    """
    grams = (words.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1),
                                                lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
             .groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect())  # bounded by the alphabet
    rank = words.sparkSession.sparkContext.broadcast({g: (n, g) for g, n in grams})

    def keys(batches):
        order = rank.value
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                rows: list = []
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    prefix = ordered_grams(word, order)
                    last = prefix[-1][0]
                    pivots = {i for _, i in choose_pivots(prefix)}
                    for _, i in prefix:
                        rows += [(k, word, n, last[0], last[1], i in pivots) for k in gram_keys(word, i)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()])],
                    names=["key", "word", "n", "last", "last_gram", "pivot"])
    made = materialize(words.select("word", "n").mapInArrow(
        keys, "key long, word string, n long, last long, last_gram string, pivot boolean"))
    end = F.struct("last", "last_gram")
    pivots = made.filter("pivot").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), end.alias("a_end"))
    prefixes = made.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), end.alias("b_end"))
    met = pivots.join(prefixes, "key").filter("a <> b AND a_end <= b_end").filter(F.levenshtein("a", "b", 1) == 1)
    pairs = (met.select(F.least("a", "b").alias("word"), F.when(F.col("a") < F.col("b"), F.col("a_n")).otherwise(F.col("b_n")).alias("n"),
                        F.greatest("a", "b").alias("other"),
                        F.when(F.col("a") < F.col("b"), F.col("b_n")).otherwise(F.col("a_n")).alias("other_n")).distinct())
    pairs = materialize(pairs)
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n)."""
    words = materialize(words)
    near = (near_words(words).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")))
    best_n = -F.col("best.minus")
    is_form = best_n >= ratio * F.col("n")
    judged = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, best_n).alias("form_n")))
    paths = materialize(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = materialize(paths.join(ahead, "root", "left")
                             .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        paths = longer.drop("moved")
        if longer.filter("moved").limit(1).count() == 0:
            break
    return (judged.join(paths, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
