"""Benchmark decontamination: broadcast hash set of the benchmark's word windows.

Texts are lower-cased (A-Z) and divided into words of letters and digits. A
window is ``n`` consecutive words of a benchmark item; an item of fewer words,
but not none, is one window. The windows' 64-bit hashes are broadcast, behind
a check of their number. Map tasks slide over all words of whole documents,
probe the set, and compare the words themselves before a hit counts. There is
no shuffle at all, so hot sources or passages need no care.

Null and empty texts have no words and no hits. Very long texts are hashed in
pieces cut between words; windows run over the cuts. Repeated rows and items
are judged one by one. An empty benchmark hits nothing. Items with a null id
are left out, unless ``unnamed`` is set: then their windows count like others,
and a hit by any of them adds one null at the end of ``items``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.textops import (HashTable, cut_at_non_word, hash_windows, lower_ascii, map_batches,
                                 utf8_column, words_of)

IS_WORD = np.ones(256, bool)
for _a, _b in ((0x00, 0x30), (0x3A, 0x61), (0x7B, 0x80)):
    IS_WORD[_a:_b] = False
FOLD = lower_ascii()
IS_WORD_RAW = IS_WORD | IS_WORD[FOLD]
_CUT = cut_at_non_word(IS_WORD_RAW)


def _words(data, offsets):
    return words_of(data, offsets, IS_WORD_RAW, FOLD, _CUT)


def _joined(data, starts, ends) -> bytes:
    return b" ".join([FOLD[data[a:b]].tobytes() for a, b in zip(starts, ends)])


class WindowSet:
    """The benchmark's windows: by width a table of hashes, the words, and the items."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        self.widths: dict[int, list] = {}
        data, offsets = utf8_column(pa.array([t for _, t in items], pa.string()))
        h, r, s, e = _words(data, offsets)
        ends = np.searchsorted(r, np.arange(len(items) + 1))
        found: dict[int, dict] = {}
        for i, (item, _text) in enumerate(items):
            a, b = int(ends[i]), int(ends[i + 1])
            width = min(n, b - a)
            for k in range(a, b - width + 1 if width else a):
                words = _joined(data, s[k:k + width], e[k:k + width])
                key = int(hash_windows(h[k:k + width], width)[0])
                found.setdefault(width, {}).setdefault(key, {}).setdefault(words, set()).add(item)
        for width, by_hash in found.items():
            table = HashTable(len(by_hash))
            table.insert(np.array(list(by_hash), np.uint64), np.arange(len(by_hash), dtype=np.int32))
            self.widths[width] = [table, list(by_hash.values()), self._sieve(table.keys)]

    @staticmethod
    def _sieve(keys) -> np.ndarray:
        """One bit for 20 bits of the hash: few windows of a document pass it."""
        sieve = np.zeros(1 << 20, bool)
        sieve[(keys[keys != 0] >> np.uint64(44)).astype(np.int64)] = True
        return sieve

    def hits(self, data, h, r, s, e):
        """Yield ``(first word, width, items)`` for each occurrence of a window."""
        for width, (table, entries, sieve) in self.widths.items():
            w = hash_windows(h, width)
            at = np.flatnonzero(sieve[(w >> np.uint64(44)).astype(np.int64)])
            at = at[r[at] == r[at + width - 1]]
            index = table.find(w[at])
            for k, i in zip(at[index >= 0].tolist(), index[index >= 0].tolist()):
                items = entries[i].get(_joined(data, s[k:k + width], e[k:k + width]))
                if items:
                    yield k, width, items


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 13, text: str = "text",
         item_id: str = "item_id", item_text: str = "text",
         max_benchmark_bytes: int = 64 << 20, unnamed: bool = False) -> DataFrame:
    """``docs`` with n_words, n_hit, items, spans and cleaned.

    n_hit: words inside any occurrence of a window; items: ids (as strings) of
    items with occurring windows (null for those of null id); spans: maximal runs of hit words as byte
    ranges; cleaned: the text without these. A benchmark of over
    ``max_benchmark_bytes`` raises ValueError: its windows would not fit a
    broadcast (divide it and scan once for each part).
    """
    size = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    if size > max_benchmark_bytes:
        raise ValueError(f"the benchmark has {size} bytes; {max_benchmark_bytes} can be broadcast")
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(item_text)).collect()
    windows = docs.sparkSession.sparkContext.broadcast(
        WindowSet([(i, t) for i, t in rows if unnamed or i is not None], n))
    column = docs.columns.index(text)

    def judge(batch):
        data, offsets = utf8_column(batch.column(column))
        n_rows = batch.num_rows
        h, r, s, e = _words(data, offsets)
        cover = np.zeros(len(h) + 1, np.int64)
        items: dict[int, set] = {}
        for k, width, found in windows.value.hits(data, h, r, s, e):
            cover[k] += 1
            cover[k + width] -= 1
            items.setdefault(int(r[k]), set()).update(found)
        hit = np.cumsum(cover[:-1]) > 0
        spans: dict[int, list] = {}
        if items:
            # a run ends where the next word isn't hit or belongs to another row
            joins = np.zeros(len(h), bool)
            joins[1:] = hit[1:] & hit[:-1] & (r[1:] == r[:-1])
            first = np.flatnonzero(hit & ~joins)
            last = np.flatnonzero(hit & ~np.append(joins[1:], False))
            for row, a, b in zip(r[first].tolist(), s[first].tolist(), e[last].tolist()):
                spans.setdefault(row, []).append((a - int(offsets[row]), b - int(offsets[row])))
        texts = batch.column(column)
        cleaned = texts.to_pylist() if spans else texts
        for row, found in spans.items():
            raw = data[offsets[row]:offsets[row + 1]].tobytes()
            at, kept = 0, []
            for a, b in found:
                kept.append(raw[at:a])
                at = b
            cleaned[row] = (b"".join(kept) + raw[at:]).decode()
        return [np.bincount(r, minlength=n_rows).astype(np.int64),
                np.bincount(r[hit], minlength=n_rows).astype(np.int64),
                pa.array([sorted(items.get(i, ()), key=lambda x: (x is None, x)) for i in range(n_rows)],
                         pa.list_(pa.string())),
                pa.array([[{"start": a, "end": b} for a, b in spans.get(i, ())] for i in range(n_rows)],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(cleaned, pa.string()) if spans else texts]
    return map_batches(docs, judge, [
        ("n_words", "long"), ("n_hit", "long"), ("items", "array<string>"),
        ("spans", "array<struct<start:long,end:long>>"), ("cleaned", "string")], text)


def contaminated(one_in: int = 20):
    """The contamination rule: some hit, and at least one word of ``one_in`` is hit."""
    return (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = 13,
                  one_in: int = 20, text: str = "text", unnamed: bool = False) -> DataFrame:
    """``docs`` without contaminated documents, or with their hit spans cut out.

    ``unnamed`` as in :func:`scan`.
    ``remove="documents"`` drops a document by :func:`contaminated`;
    ``remove="spans"`` keeps every document and cuts the hit words' spans.
    """
    scanned = scan(docs.select("*"), benchmark, n, text, unnamed=unnamed)
    if remove == "documents":
        return scanned.filter(~contaminated(one_in)).select(*docs.columns)
    if remove != "spans":
        raise ValueError(f"remove is {remove!r}, not documents or spans")
    return scanned.select(*[F.col("cleaned").alias(c) if c == text else F.col(c) for c in docs.columns])
