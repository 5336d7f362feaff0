"""Token ids of whole texts through a table of pre-tokens.

The two public vocabulary files divide a text into pre-tokens (letters,
digits, other signs, white space) and encode each by itself, so ids of a text
are the joined ids of its pre-tokens. Here the division runs on byte classes
with numpy for all rows at once, pre-tokens are looked up by their 64-bit hash
in a bounded table of the worker process, and only unknown ones go to the
``tokenizers`` library. The byte classes hold for ASCII and the letters of
Latin-1. A row with any other character, an apostrophe that may begin a
contraction, or a special string goes to the library as a whole, so its ids
are the library's by definition.
"""

from __future__ import annotations

import os

import numpy as np

from candela.llm.textops import HashTable, chunks, cut_before_space, hash_spans, trim

#: Bytes divided at once; the table of pre-tokens needs the worker's memory more than these temporaries.
PIECE_BYTES = 1 << 18

SPACE, LETTER, DIGIT, OTHER, ODD = range(5)


def _classes() -> np.ndarray:
    c = np.full(256, ODD, np.uint8)
    c[32:127] = OTHER
    for a, b in ((65, 91), (97, 123)):
        c[a:b] = LETTER
    c[48:58] = DIGIT
    c[[9, 10, 13, 32]] = SPACE
    return c


_CLASS = _classes()
_ODD = _CLASS == ODD
_SUFFIX = np.zeros(256, bool)
_SUFFIX[[ord(x) for x in "sStTrRvVmMlLdD"]] = True


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte; 0xC3 and the byte after it make one letter of Latin-1."""
    c = _CLASS[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[lead + 1 < len(data)]
    if len(lead):
        second = data[lead + 1]
        kind = np.where((second == 0x97) | (second == 0xB7), OTHER, LETTER)  # the signs × and ÷
        c[lead], c[lead + 1] = kind, kind
    return c


def _odd_places(data: np.ndarray) -> np.ndarray:
    """Bytes that the classes don't cover, contractions, and "<|" of special strings."""
    odd = np.flatnonzero(_ODD[data])
    if len(odd):  # most are the two bytes of a Latin-1 letter
        letter = (data[odd] == 0xC3) | (data[np.maximum(odd - 1, 0)] == 0xC3) & (odd > 0)
        odd = odd[~letter]
    quote = np.flatnonzero(data[:-1] == 39)
    bar = np.flatnonzero(data[:-1] == 60)
    return np.concatenate([odd, quote[_SUFFIX[data[quote + 1]]], bar[data[bar + 1] == 124]])


def byte_level_spans(data, classes, first):
    """Spaces join the word after them; the rest of a white-space run is a pre-token."""
    begin = first.copy()
    begin[1:] |= classes[1:] != classes[:-1]
    white = classes == SPACE
    after = np.flatnonzero(~white[1:] & white[:-1] & ~first[1:]) + 1
    begin[after - 1] = True
    begin[after[data[after - 1] == 32]] = False
    s = np.flatnonzero(begin)
    return s, np.append(s[1:], len(data))


def word_spans(data, classes, first):
    """White space is dropped and each digit stands alone."""
    begin = first.copy()
    begin[1:] |= classes[1:] != classes[:-1]
    begin |= classes == DIGIT
    s = np.flatnonzero(begin)
    e = np.append(s[1:], len(data))
    keep = classes[s] != SPACE
    return s[keep], e[keep]


def lower_latin1(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    upper = (data >= 65) & (data <= 90)
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    upper |= after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[upper] += 32
    return out


class PreTokenEncoder:
    """Ids or lengths of whole texts, with a table of at most ``capacity`` pre-tokens."""

    def __init__(self, path: str, capacity: int = 1 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        by_byte = self.library.normalizer is None
        self.lower = not by_byte
        self.spans = byte_level_spans if by_byte else word_spans
        names = self.library.get_vocab()
        size = max(names.values()) + 1
        self.marks = np.zeros(size, bool)  # ids that begin (byte level) or end (words) a pre-token
        for name, i in names.items():
            self.marks[i] = name.startswith("\u0120") if by_byte else name.endswith("</w>")
        self.newline = names.get("\u010a", -1)
        self.capacity = capacity
        self._reset()
        del names
        trim()

    def _reset(self) -> None:
        self.table = HashTable(self.capacity)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int32)
        self.used = 0

    def library_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list[str], block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """(ids joined, lengths) of pre-tokens, many to a call of the library.

        Words go out joined such that the library divides them again at the
        same places, and the ids show these: byte-level words that begin with
        a space have the only id with a space in front, others are divided by
        line ends; ids of the other vocabulary tell where a word ends. A block
        whose ids don't give as many words is encoded word by word.
        """
        if self.lower:
            kinds = [np.arange(len(words))]
        else:
            spaced = np.array([w[0] == " " and len(w) > 1 and w[1] != " " for w in words], bool)
            other = np.array([w[0].isspace() for w in words], bool) & ~spaced
            kinds = [np.flatnonzero(spaced), np.flatnonzero(~spaced & ~other), np.flatnonzero(other)]
        order, flat, lens = [], [], []
        for kind, members in enumerate(kinds):
            joint = (" ", "", "\n", None)[0 if self.lower else kind + 1]
            for a in range(0, len(members), block):
                mine = members[a:a + block]
                text = [words[i] for i in mine.tolist()]
                order.append(mine)
                if joint is not None:
                    ids = np.array(self.library_ids([joint.join(text)])[0], np.uint32)
                    if joint == "\n":
                        ends = np.append(np.flatnonzero(ids == self.newline), len(ids))
                        n = np.diff(ends, prepend=-1) - 1
                        ids = ids[ids != self.newline]
                    elif joint == "":
                        n = np.diff(np.append(np.flatnonzero(self.marks[ids]), len(ids)))
                    else:
                        n = np.diff(np.flatnonzero(self.marks[ids]), prepend=-1)
                    if len(n) == len(text) and int(n.sum()) == len(ids) and (n > 0).all():
                        flat.append(ids)
                        lens.append(n)
                        continue
                each = self.library_ids(text)
                lens.append(np.array([len(x) for x in each], np.int64))
                flat.append(np.array([x for y in each for x in y], np.uint32))
        order, flat, lens = np.concatenate(order), np.concatenate(flat), np.concatenate(lens)
        # back to the words' order
        start = np.cumsum(lens) - lens
        back = np.argsort(order)
        n = lens[back]
        at = np.repeat(start[back] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return flat[at], n.astype(np.int32)

    def _learn(self, data, s, e, h, miss) -> np.ndarray:
        """Encode the unknown pre-tokens by the library; their indexes."""
        new, at = np.unique(h[miss], return_index=True)
        where = miss[at]
        raw = data.tobytes()
        flat, lens = self._encode([raw[a:b].decode() for a, b in zip(s[where].tolist(), e[where].tolist())])
        n, base = len(new), self.table.count
        for name, need in (("pool", self.used + len(flat)), ("start", base + n), ("length", base + n)):
            have = getattr(self, name)
            if need > len(have):
                setattr(self, name, np.concatenate([have, np.zeros(max(need - len(have), len(have)), have.dtype)]))
        self.pool[self.used:self.used + len(flat)] = flat
        self.length[base:base + n] = lens
        self.start[base:base + n] = self.used + np.cumsum(lens) - lens
        self.used += len(flat)
        index = np.arange(base, base + n, dtype=np.int32)
        self.table.insert(new, index)
        return index[np.searchsorted(new, h[miss])]

    def pieces(self, data: np.ndarray, offsets: np.ndarray):
        """Yield ``(rows, hashes, indexes)`` of the pre-tokens, and ``(row, ids)`` of library rows.

        The two kinds come as ``("table", rows, hashes, indexes)`` and
        ``("library", row, ids)``; each row is wholly of one kind.
        """
        # Rows that the byte classes don't cover are found first: a long row may span chunks.
        plain = np.ones(len(offsets) - 1, bool)
        for rows, starts, a, b in chunks(data, offsets, PIECE_BYTES, cut_before_space):
            part = data[a:b]
            odd = _odd_places(part)
            if len(odd):
                plain[rows[np.searchsorted(starts, odd, "right") - 1]] = False
        for row in np.flatnonzero(~plain):
            text = data[offsets[row]:offsets[row + 1]].tobytes().decode()
            yield "library", int(row), np.array(self.library_ids([text])[0], np.uint32)
        for rows, starts, a, b in chunks(data, offsets, PIECE_BYTES, cut_before_space):
            part = data[a:b]
            if self.lower:
                part = lower_latin1(part)
            first = np.zeros(len(part), bool)
            first[starts] = True
            classes = _byte_classes(part)
            s, e = self.spans(part, classes, first)
            r = rows[np.searchsorted(starts, s, "right") - 1]
            keep = plain[r]
            if not keep.all():
                s, e, r = s[keep], e[keep], r[keep]
            h = hash_spans(part, s, e)
            yield "table", r, h, (part, s, e)

    def indexes(self, h, where) -> np.ndarray:
        part, s, e = where
        if self.table.count + len(h) > self.table.capacity and self.table.count > self.capacity // 2:
            self._reset()
        if len(h) > self.table.capacity:
            self.table = HashTable(len(h))
        index = self.table.find(h)
        miss = np.flatnonzero(index < 0)
        if len(miss):
            index[miss] = self._learn(part, s, e, h, miss)
        return index

    def lengths(self, h, where) -> np.ndarray:
        index = self.indexes(h, where)  # may replace the arrays
        return self.length[index]

    def counts(self, data: np.ndarray, offsets: np.ndarray, frequent=None) -> np.ndarray:
        """Tokens of each row. ``frequent``: a first table of hash to length, looked up before."""
        n = np.zeros(len(offsets) - 1, np.int64)
        for kind, rows, *rest in self.pieces(data, offsets):
            if kind == "library":
                n[rows] = len(rest[0])
                continue
            h, (part, s, e) = rest
            if frequent is None:
                lens = self.lengths(h, (part, s, e))
            else:
                lens = frequent.find(h)
                miss = np.flatnonzero(lens < 0)
                if len(miss):
                    lens[miss] = self.lengths(h[miss], (part, s[miss], e[miss]))
            n += np.bincount(rows, weights=lens, minlength=len(n)).astype(np.int64)
        return n

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all rows' ids joined, row offsets into them)."""
        n_rows = len(offsets) - 1
        counts, library, parts = np.zeros(n_rows, np.int64), {}, []
        for kind, rows, *rest in self.pieces(data, offsets):
            if kind == "library":
                library[rows] = rest[0]
                counts[rows] = len(rest[0])
                continue
            index = self.indexes(*rest)
            lens = self.length[index].astype(np.int64)
            counts += np.bincount(rows, weights=lens, minlength=n_rows).astype(np.int64)
            total = int(lens.sum())
            at = np.repeat(self.start[index] - (np.cumsum(lens) - lens), lens) + np.arange(total)
            parts.append(self.pool[at])
        offs = np.zeros(n_rows + 1, np.int64)
        np.cumsum(counts, out=offs[1:])
        plain = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        if not library:
            return plain, offs
        out = np.zeros(int(offs[-1]), np.uint32)
        from_library = np.zeros(n_rows, bool)
        for row, ids in library.items():
            out[offs[row]:offs[row + 1]] = ids
            from_library[row] = True
        out[np.repeat(~from_library, counts)] = plain
        return out, offs


_encoders: dict[tuple[str, int], PreTokenEncoder] = {}


def encoder(path: str, capacity: int = 1 << 20) -> PreTokenEncoder:
    """This worker process's encoder for a vocabulary file; it lasts over tasks."""
    if (path, capacity) not in _encoders:
        _encoders[path, capacity] = PreTokenEncoder(path, capacity)
    return _encoders[path, capacity]
