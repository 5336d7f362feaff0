"""Operators against brute force, and on nulls, empty and long texts, ties, repeats and empty tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from candela.llm.queries import URL_RULES, vocabulary
from candela.llm.ship import prepared

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
ROW = "doc_id long, text string, source string, n_tokens string, score int, part int, spans int"


@pytest.fixture(scope="module")
def texts():
    """Invented texts with copies, near copies, shared passages, odd characters and edge cases."""
    rng = random.Random(3)
    words = ["the", "of", "and", "is", "Éa", "größe", "it's", "don't", "12", "3", "x!", "##", "…", "中文", "naïve", "a_b"]
    words += ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    out = []
    for _ in range(60):
        t = [rng.choice(words) for _ in range(rng.randint(0, 200))]
        out.append(" ".join(t) if rng.random() < .8 else "\n".join(" ".join(t[k:k + 8]) for k in range(0, len(t), 8)))
    for k in range(40):
        t = out[k % 12].split(" ")
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        out.append(" ".join(t))
    out += [f"{out[k][:50]} {passage} {k}" for k in range(20)] + [out[0]] * 8
    out += ["", None, " \n\t ", "one", "one", "two words", "a b c d", "a b c d", "a b c d e", "tail  \n ", "  lead",
            "<|endoftext|> in text", "x" * 3000, "ab " * 3000, "\u0130stanbul İ", "nul\x00byte", "\x1c\x1d sep"]
    out.append(" ".join(rng.choice(words) for _ in range(20_000)))
    rng.shuffle(out)
    return [(k * 3 + 5, t) for k, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With columns whose names clash with those of results, a repeated row and a null id."""
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, "n", 1, 2, 3) for i, t in texts]
    rows += [rows[4], (None, "a text without an id " * 10, "s0", None, None, None, None)]
    return prepared(spark).createDataFrame(rows, ROW).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return prepared(spark).createDataFrame([], ROW)


def library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


# ------------------------------------------------------------------ tokens

def test_token_counts(docs, nothing, texts):
    from candela.llm.token_counts import count_tokens
    path = vocabulary("byte_bpe_50k.json")
    ids = library("byte_bpe_50k.json")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, path).collect()}
    for i, t in texts:
        n = len(ids(t))
        assert got[i] == (len((t or "").encode()), n, n > 1024), t
    assert count_tokens(docs, path).count() == docs.count()
    assert count_tokens(docs, path).columns.count("n_tokens") == 1
    assert count_tokens(nothing, path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pretoken_ids_equal_the_library(name):
    import pyarrow as pa

    from candela.llm.pretokens import PreTokenEncoder
    from candela.llm.textops import utf8_column
    rng = random.Random(1)
    signs = ["a", "Z", "é", "É", "×", "ß", " ", "  ", "\n", "\t", "'", "'s", "'LL", "1", "23", "!", "<|endoftext|>", "中",
             "\u00a0", "–", "\r\n", "_", "the", " and", "İ", "\x1c", "\x0b", "e\u0301"]
    texts = ["".join(rng.choice(signs[:16] if rng.random() < .7 else signs) for _ in range(rng.randrange(30)))
             for _ in range(3000)] + [None, ""]
    coder = PreTokenEncoder(vocabulary(name), capacity=200)  # the table is dropped and filled again
    data, offsets = utf8_column(pa.array(texts))
    ids, offs = coder.ids(data, offsets)
    want = coder.library_ids([t or "" for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == want
    assert coder.counts(data, offsets).tolist() == [len(x) for x in want]


def test_token_files_round_trip(spark, docs, nothing, texts, tmp_path):
    from candela.llm.token_files import Shard, read_tokens, write_tokens
    path = vocabulary("word_bpe_49k.json")
    ids = library("word_bpe_49k.json")
    write_tokens(docs, str(tmp_path / "t"), path, shard_bytes=20_000)
    got = read_tokens(spark, str(tmp_path / "t"), with_ids=True).orderBy("start").collect()
    assert len(got) == docs.count()
    start, by_id = 0, dict(texts)
    for r in got:
        assert r.start == start
        want = np.array(ids(by_id.get(r.doc_id, "a text without an id " * 10)) + [2], "<u4").tobytes()
        assert (bytes(r.ids), r.n_tokens, r.ids_crc32) == (want, len(want) // 4, zlib.crc32(want))
        start += r.n_tokens
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda x: (x is not None, x))
    shard = Shard(bytes(spark.read.parquet(str(tmp_path / "t")).orderBy("part", "number").first().blob))
    whole = shard.tokens(0, shard.n_tokens)
    for a, b in ((0, 1), (3, 3), (5, 90), (shard.n_tokens - 7, shard.n_tokens)):
        assert np.array_equal(shard.tokens(a, b), whole[a:b])
    assert len(shard.symbols) < shard.n_tokens
    write_tokens(nothing, str(tmp_path / "e"), path)
    assert read_tokens(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("top", [3, 60_000, 61_439, 61_440, 65_534, 65_535, 65_536, 70_000, 250_000])
def test_grammars_on_both_sides_of_16_bits(top):
    """Ids near the top of a vocabulary of any size are compressed and read back, whole and in ranges."""
    from candela.llm.token_files import Shard, compress
    rng = np.random.default_rng(top)
    phrases = [rng.integers(max(3, top - 500), top + 1, rng.integers(3, 40)) for _ in range(30)]
    documents = [np.append(np.concatenate([phrases[k] for k in rng.integers(0, 30, rng.integers(1, 30))]), 2) for _ in range(120)]
    documents += [np.array([2])] * 3 + [np.array([top, 2])]
    ids, ends = np.concatenate(documents).astype(np.uint32), np.cumsum([len(d) for d in documents])
    shard = Shard(compress(ids, ends))
    assert np.array_equal(shard.tokens(0, len(ids)), ids) and np.array_equal(shard.document_ends(), ends)
    for k in (0, 7, 119, 120, 123):
        assert np.array_equal(shard.document(k), documents[k])
    for a, b in ((5, 6), (17, 900), (len(ids) - 3, len(ids))):
        assert np.array_equal(shard.tokens(a, b), ids[a:b])
    assert len(shard.symbols) < len(ids) / 4


def test_packing(docs, nothing, texts):
    from candela.llm.packing import SmallPlan, pack_documents, sequences
    path = vocabulary("byte_bpe_50k.json")
    ids = library("byte_bpe_50k.json")
    packed = pack_documents(docs, path, capacity=64, with_ids=True)
    rows = packed.collect()
    by_id = dict(texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(by_id) | {None}
    lengths = []
    for i, t in texts:
        want = np.array(ids(t) + [2], "<u4")
        mine = sorted(by_doc[i], key=lambda r: r.piece)
        times = max(1, sum(r.piece == 0 for r in mine))
        assert len(mine) % times == 0
        mine = mine[::times]
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert b"".join(bytes(r.ids) for r in mine) == want.tobytes()
        assert [r.start for r in mine] == [sum(x.length for x in mine[:k]) for k in range(len(mine))]
        assert all(r.length == 64 for r in mine[1:]) and all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in mine)
    for seq in by_sequence.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    for r in rows:
        lengths.append(r.length)
    plain = SmallPlan({n: lengths.count(n) for n in set(lengths)}, {}, 64).new  # best fit decreasing alone
    assert len(by_sequence) <= plain * 1.03 + 2
    assert sequences(packed).agg({"n_tokens": "sum"}).first()[0] == sum(lengths)
    assert pack_documents(nothing, path).count() == 0


def test_configurations_use_every_slot_once():
    from candela.llm.packing import LargePlan
    rng = np.random.default_rng(2)
    lengths = rng.integers(20, 64, 5000)
    histogram = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    for groups in (1, 3, 16, 1000):
        plan = LargePlan(histogram, 64, groups)
        length = np.repeat(list(histogram), list(histogram.values()))
        rank = np.concatenate([np.arange(c) for c in histogram.values()])
        fill = np.bincount(plan.sequence(length, rank), length, plan.sequences)
        assert fill.max() <= 64 and fill.min() > 0


@pytest.mark.parametrize("times", [1, 40])
def test_few_sizes_pack_tightly(spark, times):
    """At most 64 sizes stand for 640 lengths, whatever the count; sequences stay within 1 % of the lower bound."""
    from candela.llm.packing import LargePlan, pack
    rng = np.random.default_rng(3)
    lengths = np.tile(np.clip(rng.gamma(3.0, 150.0, 6000).astype(int), 2, 1024), times)
    large = {int(n): int(c) for n, c in zip(*np.unique(lengths[(lengths >= 384) & (lengths < 1024)], return_counts=True))}
    plan = LargePlan(large, 1024, 64)
    assert len(large) > 400 and 32 <= len(plan.first) <= 64
    rank = np.concatenate([np.arange(c) for c in large.values()])
    fill = np.bincount(plan.sequence(np.repeat(list(large), list(large.values())), rank),
                       np.repeat(list(large), list(large.values())), plan.sequences)
    assert fill.max() <= 1024
    if times == 1:
        rows = [(i, 0, 0, int(n), i) for i, n in enumerate(lengths)]
        items = prepared(spark).createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
        got = pack(items).groupBy("sequence_id").agg({"length": "sum"}).collect()
        assert sum(r[1] for r in got) == lengths.sum() and max(r[1] for r in got) <= 1024
        assert len(got) <= 1.01 * -(-int(lengths.sum()) // 1024)


# ------------------------------------------------------------------- lines

def test_line_dedup(spark, nothing):
    from candela.llm.lines import dedup_lines
    rows = [(k, f"menu {k % 2}\n own {k}\n\nfooter\t\n own {k}", "a", 7) for k in range(30)]
    rows += [(100 + k, f"footer\nmenu 0\nrare {k // 2}", None, 7) for k in range(12)]
    rows += [(200 + k, "footer\nfooter", "small", 7) for k in range(9)]
    rows += [(300, None, "a", None), (301, "", "a", 0), (302, "footer", "a", 6), rows[0]]
    rows += [(400 + k, "copy\nof one page", "a", 7) for k in range(40)]  # one text: keeps its lines
    rows += [(500 + k, f"foot\n{k}", "nine", 7) for k in range(9)] + [(600 + k, f"foot\n{k}", "four", 7) for k in range(4)]
    df = prepared(spark).createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    pages, seen = defaultdict(int), defaultdict(int)
    for t, s in {(t, s) for _, t, s, _ in rows}:
        pages[s] += 1
        for line in {x.strip(" \t\r") for x in (t or "").split("\n")} - {""}:
            seen[s, line] += 1

    def keep(s, line):
        line = line.strip(" \t\r")
        return not line or seen[s, line] < 5 or seen[s, line] <= 0.1 * pages[s]
    assert keep("a", "copy") and not keep("nine", "foot") and keep("four", "foot") and not keep("a", "menu 0")
    want = []
    for i, t, s, n in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if keep(s, x)]
        new = None if t is None else "\n".join(kept)
        want.append((i, new, s, len(lines), len(lines) - len(kept)))
    for limits in ({}, {"broadcast_rows": 0}, {"site_rows": 1}):  # sites' lines broadcast, and joined
        got = dedup_lines(df, **limits).collect()
        assert sorted((r.doc_id, r.text, r.source, r.n_lines, r.n_dropped) for r in got if r.text is not None) == sorted(
            w for w in want if w[1] is not None) if all(r.source for r in got) else True
        key = lambda w: (w[0], str(w[1]), str(w[2]))
        assert sorted(((r.doc_id, r.text, r.source, r.n_lines, r.n_dropped) for r in got), key=key) == sorted(want, key=key)
        assert all(r.n_chars == len(r.text) for r in got if r.n_dropped)
    assert dedup_lines(nothing).count() == 0


def test_line_dedup_is_native(spark):
    from candela.llm.lines import dedup_lines
    df = prepared(spark).createDataFrame([(1, "a\nb", "s")], "doc_id long, text string, source string")
    plan = dedup_lines(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ----------------------------------------------------------------- quality

def test_quality(spark, docs, nothing):
    from candela.llm.quality import held_out, score, train
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        w = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 80))]
        bad = i % 5 == 0
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w)))
        labels.append((i, 0 if bad else 1))
    d = prepared(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    lab = spark.createDataFrame(labels + [(0, None), (9999, 1)], "doc_id long, quality int")
    w = train(d, lab.filter(~held_out()))
    got = {r.doc_id: r for r in score(d, w).withColumn("held", held_out()).collect()}
    for i, y in labels:
        assert got[i].held == (zlib.crc32(str(i).encode()) % 4 == 2)
        if got[i].held:
            assert got[i].predicted == y
    edge = score(docs, w)
    assert edge.count() == docs.count() and edge.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert edge.filter("predicted != CAST(score >= 0.7 AS INT)").count() == 0
    assert score(nothing, w).count() == 0
    assert not train(d, lab.limit(0)).any() and not train(nothing.select("doc_id", "text"), lab).any()
    assert np.array_equal(w, train(d.repartition(7), lab.filter(~held_out())))  # whatever the partitions


# ----------------------------------------------------------------- Jaccard

def components_of(nodes, links):
    up = {i: i for i in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


def shingle_sets(texts, width=5):
    out = {}
    for i, t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER))
        out[i] = set() if not w else {tuple(w)} if len(w) < width else {tuple(w[k:k + width]) for k in range(len(w) - width + 1)}
    return out


@pytest.mark.parametrize("options", [{}, {"least": 2, "broadcast_ids": 0}])
def test_jaccard(docs, texts, options):
    from candela.llm.jaccard import link_documents
    sets = shingle_sets(texts)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components_of(sets, links)
    rows = link_documents(docs, **options).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_jaccard_at_the_limit_and_empty(spark, nothing):
    from candela.llm.jaccard import link_documents
    base = [f"w{k}" for k in range(11)]  # 7 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base + ["z"])), (4, " ".join(base[2:])),
            (5, "A B"), (6, "a b"), (7, "b a"), (8, ""), (9, None)]
    got = {r[0]: r[2] for r in link_documents(prepared(spark).createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = shingle_sets(rows)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    assert got == components_of(sets, links)
    assert link_documents(nothing).count() == 0


def test_components_of_long_paths(spark):
    from candela.llm.components import components
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(prepared(spark).createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{k: 100 for k in range(101, 140)}}


# ----------------------------------------------------------- repeated bytes

def cut_by_brute_force(texts, length):
    least, out = {}, {}
    rows = sorted((i, (t or "").encode()) for i, t in texts)
    for i, b in rows:
        for s in range(len(b) - length + 1):
            least.setdefault(b[s:s + length], i)
    for i, b in rows:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if least[b[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard,options", [(4 << 20, {}), (700, {"broadcast_bytes": 0})])
def test_repeats(docs, nothing, texts, monkeypatch, shard, options):
    from candela.llm import suffix
    monkeypatch.setattr(suffix.parts_of, "__defaults__", (shard, None))
    want = cut_by_brute_force(texts, 50)
    rows = suffix.remove_repeats(docs, **options).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
            assert sum(x.end - x.start for x in r.spans) == r.n_removed
        else:
            assert r.n_removed == 0
    assert suffix.remove_repeats(nothing).count() == 0


def test_small_shards_and_runs_merge(texts, monkeypatch):
    """Shards of a few texts, cut in the middle of long ones, give the same cuts as one."""
    import pyarrow as pa

    from candela.llm import suffix
    from candela.llm.textops import utf8_column
    data, offsets = utf8_column(pa.array([t for _, t in texts], pa.string()))
    for limit in (150, 5000):
        seen = []
        for part in suffix.parts_of(data, offsets, 50, limit):
            first, last, anchor, piece, _sums = suffix.anchors(part, 50, 16)
            assert ((anchor >= last) & (anchor <= first + 34)).all()
            for a, b, k in zip(first.tolist(), last.tolist(), piece.tolist()):
                seen += [(int(part.rows[k]), int(part.base[k] - part.starts[k]) + x) for x in range(a, b + 1)]
        want = [(i, s) for i in range(len(texts)) for s in range(int(offsets[i + 1] - offsets[i]) - 49)]
        assert sorted(seen) == want


def test_merged_strings_of_one_key(monkeypatch):
    from candela.llm import suffix
    monkeypatch.setattr(suffix, "_all_hashes", lambda text, width: np.full(max(0, len(text) - width + 1), 5, np.uint64))
    monkeypatch.setattr(suffix._Merged, "RUN", 60)

    def blob(*runs):
        return b"".join([np.uint32(len(runs)).tobytes(), np.array([d for d, _, _ in runs]).tobytes(),
                         np.zeros(len(runs), np.int64).tobytes(), np.array([p for _, p, _ in runs], np.uint64).tobytes(),
                         np.array([len(t) for _, _, t in runs], np.uint16).tobytes(), b"".join(t for _, _, t in runs)])
    a, b = b"a" * 50, b"b" * 50
    m = suffix._Merged(50)
    for doc, place, text in ((9, 0, a), (4, 3, b), (2, 7, a), (8, 1, b)):
        m.add(blob((doc, place, text)))
    got = [(x[0], x[2], x[3]) for cuts in m.cuts() for x in cuts.T.tolist()]
    assert sorted(got) == [(8, 1, 51), (9, 0, 50)]


def test_suffix_array_and_prefixes():
    from candela.llm.suffix import big_endian_words, common_prefixes, suffix_array
    rng = np.random.default_rng(0)
    for text in (rng.integers(97, 99, 900), np.zeros(300, int), np.tile(rng.integers(0, 256, 90), 6)):
        data = text.astype(np.uint8)
        raw, words = data.tobytes(), big_endian_words(data)
        order = suffix_array(words, 64)
        padded = [raw[i:i + 64].ljust(64, b"\0") for i in order]
        assert padded == sorted(padded) and sorted(order.tolist()) == list(range(len(raw)))
        got = common_prefixes(words, order, 64)[order]
        for k in range(1, len(order)):
            n = next((j for j in range(64) if padded[k][j] != padded[k - 1][j]), 64)
            assert got[k] == n


# -------------------------------------------------------------- embeddings

def test_embeddings(spark):
    from candela.llm.embeddings import near_duplicates
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    near = x[rng.integers(0, 40, 200)] + rng.normal(size=(200, 16)).astype(np.float32) * 0.12
    x = np.concatenate([x, near, np.repeat(x[:1], 50, 0), x[5:8] * 2]).astype(np.float32)
    rows = [(int(i), v.tolist(), 0) for i, v in zip(rng.permutation(5000), x)]
    odd = [(9001, None, 0), (9002, [0.0] * 16, 0), (9003, [float("nan")] * 16, 0), (9004, [None] + [1.0] * 15, 0),
           (9005, [1.0, 2.0], 0), (9006, [float("inf")] * 16, 0), (9007, [], 0)]
    df = prepared(spark).createDataFrame(rows + odd, "vec_id long, embedding array<float>, component_id int").repartition(3)
    u = np.array([v for _, v, _ in rows], np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    ids = [i for i, _, _ in rows]
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    want = components_of(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked))])
    n_links = dict(zip(ids, linked.sum(1).tolist()))
    for options in ({"recall": 1.0}, {"recall": 1.0, "block": 8, "k": 5}):  # exact; small blocks split cells
        got = {r.vec_id: r for r in near_duplicates(df, **options).collect()}
        assert {i: (got[i].n_links, got[i].component_id) for i in ids} == {i: (n_links[i], want[i]) for i in ids}
        assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _, _ in odd)
    found = sum(r.n_links for r in near_duplicates(df).collect())
    assert found >= 0.9 * sum(n_links.values())
    assert near_duplicates(df.limit(0)).count() == 0


# --------------------------------------------------------- decontamination

def words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOWER))


def test_decontamination(spark, docs, nothing, texts):
    from candela.llm.decontaminate import contaminated, decontaminate, scan
    by_id = dict(texts)
    some = [t for t in by_id.values() if t and len(words(t)) > 40][:6]
    items = [(k, " ".join(t.split(" ")[5:30])) for k, t in enumerate(some)]
    items += [(20, "two words"), (21, "one"), (22, None), (23, "!!"), (24, items[0][1]), (100, "THE"), (None, "of")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(0, len(w) - min(13, len(w)) + 1) if w and i is not None else 0):
            windows[tuple(w[k:k + min(13, len(w))])].add(str(i))
    widths = {len(w) for w in windows}
    rows = scan(docs, bench).withColumn("bad", contaminated()).collect()
    assert len(rows) == docs.count()
    kept = sorted(str(r.doc_id) for r in decontaminate(docs, bench).select("doc_id").collect())
    for r in rows:
        w = words(by_id.get(r.doc_id, "a text without an id " * 10))
        hit, found = set(), set()
        for n in widths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        assert (r.n_words, r.n_hit, r["items"]) == (len(w), len(hit), sorted(found))
        assert r.bad == (len(hit) > 0 and 20 * len(hit) >= len(w))
        raw = (by_id.get(r.doc_id, "") or "").encode()
        for s in r.spans if r.doc_id is not None else []:
            assert words(raw[s.start:s.end].decode())
        assert len(words(r.cleaned)) <= len(w) - len(hit)
    assert kept == sorted(str(r.doc_id) for r in rows if not r.bad)
    assert decontaminate(docs, bench, remove="spans").count() == docs.count()
    assert decontaminate(docs, bench).columns == docs.columns
    assert scan(nothing, bench).count() == 0 and scan(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    with pytest.raises(ValueError):
        scan(docs, bench, max_benchmark_bytes=10)


# -------------------------------------------------------------------- urls

def judged(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S)[0]
    path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
    host = host.encode().translate(LOWER).decode()
    fits = []
    for rule, verdict in rules:
        h, s, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(s + p):
            fits.append((len(rule), len(h), rule, verdict))
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_urls(spark, monkeypatch):
    from candela.llm import urls
    made = [f"{s}{h}{p}" for s in ("http://", "HTTPS://", "", "x://y://") for h in
            ("net", "a.NET", "example.net", "b.example.net", "xexample.net", "example.com", "org", "w.org", "", "u@h.net:80", ".net")
            for p in ("", "/", "/en/", "/en", "/de/x?y=/fr/", "/fr/#a", "?q", "#/en/", "/de/\n?x", "/É/中")]
    rows = [(k, u, "h", "p") for k, u in enumerate([*made, made[3], None, ""])]
    df = prepared(spark).createDataFrame(rows, "page_id long, url string, host string, path string")
    rules = [*URL_RULES, ("example.net/", "block"), ("w.org/fr/", "block"), ("bad.example/", "block")]
    for r in urls.judge_urls(df, rules).collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(rows[r.page_id][1], rules), rows[r.page_id][1]
    assert urls.judge_urls(df.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, []).collect()} == {"allow"}
    with pytest.raises(ValueError):
        urls.build_index([("net/", "maybe")], "/tmp/none")


def test_url_digest_collisions(tmp_path, monkeypatch):
    from candela.llm import urls
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda b: len(b) % 3)
    urls.build_index(URL_RULES, str(tmp_path / "i"))
    index = urls.UrlIndex(str(tmp_path / "i"))
    rule, verdict = index.judge(["a.example.net", "net", "com", "x.org"], ["/en/1", "/", "/", "/fr/"])
    assert rule == ["example.net/en/", "net/", None, "org/fr/"] and verdict == ["allow", "block", "allow", "allow"]
