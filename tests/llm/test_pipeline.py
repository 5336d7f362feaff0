"""The corpus pipeline's stages against brute force, with copies, repeated rows, null ids and empty tables."""

import random
import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline as P
from candela.llm.ship import prepared

DOCS = "doc_id long, source string, text string, n_chars long, quality string"


def made(spark, rows):
    return prepared(spark).createDataFrame([(i, s, t, None if t is None else len(t), "x") for i, s, t in rows],
                                           DOCS).repartition(3)


def without_boilerplate(rows, ratio=0.1, least=P.LEAST_TEXTS):
    """(id, source, text) without the lines that over ``ratio`` of a source's distinct texts have."""
    texts, seen = defaultdict(set), defaultdict(set)
    for _, s, t in rows:
        texts[s].add(t)
        for line in {x.strip(" \t\r") for x in (t or "").split("\n")} - {""}:
            seen[s, line].add(t)

    def keep(s, line):
        n = len(seen[s, line.strip(" \t\r")])
        return n < least or n <= ratio * len(texts[s])
    return [(i, s, None if t is None else "\n".join(x for x in t.split("\n") if keep(s, x))) for i, s, t in rows]


def in_order(rows):
    return sorted(((r[0], r[1], r[2]) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_line_dedup_keeps_copies(spark):
    """A group of copies with a third of all rows, a pair of copies on a ten-page site, a footer on a site of nine."""
    rng = random.Random(8)
    text = lambda n: "\n".join(" ".join(f"w{rng.randrange(5000)}" for _ in range(8)) for _ in range(n))
    copy, pair = text(12), text(6)
    rows = [(k, "big", f"{text(4)}\n menu\t") for k in range(60)] + [(100 + k, "big", copy) for k in range(30)]
    rows += [(200 + k, "ten", text(3)) for k in range(8)] + [(210, "ten", pair), (211, "ten", pair)]
    rows += [(300 + k, "nine", f"{text(3)}\n\nfooter") for k in range(9)]
    rows += [(400 + k, None, f"{text(2)}\nfooter") for k in range(12)] + [(420, None, None), (421, None, ""), (422, "alone", "x")]
    rows += [rows[0], rows[0], (None, "big", copy)]
    df = made(spark, rows)
    got = P.line_dedup(spark, df, "").collect()
    assert in_order((r.doc_id, r.source, r.text) for r in got) == in_order(without_boilerplate(rows))
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    by_id = {r.doc_id: r.text for r in got}
    assert [by_id[100 + k] for k in range(30)] == [copy] * 30 and by_id[210] == by_id[211] == pair
    assert not any(t and ("menu" in t or "footer" in t) for t in by_id.values())
    assert P.line_dedup(spark, df.limit(0), "").count() == 0


def test_line_dedup_of_texts_joined(spark):
    from candela.llm.lines import dedup_lines
    rows = [(k, "s", f"own {k}\nmenu") for k in range(20)] + [(50 + k, "s", "copy\nof it") for k in range(10)]
    got = dedup_lines(made(spark, rows), least_texts=P.LEAST_TEXTS, broadcast_rows=0).collect()
    assert in_order((r.doc_id, r.source, r.text) for r in got) == in_order(without_boilerplate(rows))


def shingles(t):
    words = (t or "").lower().split()
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def without_near_copies(rows):
    """One row for each (id, text), of the ids that are the smallest of their component; null ids stay."""
    sets, up = defaultdict(list), {}
    for i, _, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
            up[i] = i
    for a in sets:
        for b in sets:
            if a < b and any(x and 4 * len(x & y) >= 3 * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((up[a], up[b]))
                up = {i: lo if c == hi else c for i, c in up.items()}
    return sorted({(i, s, t) for i, s, t in rows if i is None or up[i] == i}, key=str)


def test_near_dedup_keeps_one_row_of_an_id_and_text(spark):
    rng = random.Random(9)
    text = lambda: " ".join(f"w{rng.randrange(3000)}" for _ in range(60))
    a, b, c = text(), text(), text()
    rows = [(5, "s", a), (5, "s", a), (9, "s", a + " more"), (9, "s", a + " more"), (7, "s", b), (7, "s", b), (7, "s", b),
            (None, "s", c), (None, "s", c), (None, "s", text()), (None, "s", b), (None, "s", None), (None, "s", None),
            (11, "s", None), (11, "s", None), (12, "s", ""), (12, "s", ""), (13, "s", None), (14, "s", text())]
    got = P.near_dedup(spark, made(spark, rows), "").collect()
    got = sorted(((r.doc_id, r.source, r.text) for r in got), key=str)
    assert got == without_near_copies(rows)
    assert len(got) == 10
    once = made(spark, [(1, "s", a), (2, "s", a), (3, "s", b)])
    assert sorted(r.doc_id for r in P.near_dedup(spark, once, "").collect()) == [1, 3]
    assert P.near_dedup(spark, once.limit(0), "").count() == 0


def test_items_without_an_id_count(spark, tmp_path):
    """op9 against its SQL and the pipeline's stage, with benchmark items whose id is null."""
    import __spark_entry__ as E
    from oracle_harness import compare
    passage = [" ".join(f"p{k}w{j}" for j in range(20)) for k in range(3)]
    rows = [(1, "s", f"x {passage[0]} y"), (2, "s", f"a {passage[1]}"), (3, "s", f"{passage[0]} {passage[2]}"),
            (4, "s", "nothing of it"), (5, "s", "Tiny item and more words"), (6, "s", None), (7, "s", "")]
    docs = made(spark, rows)
    items = [(None, passage[0]), (8, passage[1]), (9, passage[2]), (None, "tiny item"), (None, passage[0]), (None, None)]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    sql = E.oracle_sql()["op9_decontaminate"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'").replace(
        "FROM benchmark", f"FROM '{tmp_path}/benchmark.parquet/*.parquet'")  # Spark writes folders
    r = compare(spark, "op9", E.queries()["op9_decontaminate"], sql, str(tmp_path))
    assert r["values_match"], r
    kept = P.benchmark_decontamination(spark, docs, str(tmp_path))
    assert sorted(x.doc_id for x in kept.collect()) == [4, 6, 7] and kept.columns == docs.columns


# ------------------------------------------------------- all stages, and run()

CLASHING = "doc_id long, source string, text string, n_chars long, score string, n_lines string, items string"


def corpus():
    """(rows, labels, benchmark items): good and bad documents with copies, near copies, passages and odd rows."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    line = lambda: " ".join(word() for _ in range(8))
    rows, labels, passage = [], [], " ".join(word() for _ in range(26))
    for i in range(400):
        lines = [line() for _ in range(rng.randint(3, 7))]
        bad = i % 5 == 0
        if bad:
            lines = [" ".join(w.upper() + "!!" for w in x.split()) for x in lines]
        elif i % 3 == 0:
            lines.append("home about contact login")
        if i % 40 == 7:
            lines.insert(1, f"{word()} {passage}")
        rows.append((i, f"site{i % 4}", "\n".join(lines)))
        labels.append((i, 0 if bad else 1))
    copy = "\n".join(line() for _ in range(6))
    rows += [(1000 + k, "site1", copy) for k in range(60)]                       # over a tenth of a source
    rows += [(1100 + k, "site2", f"{rows[k + 1][2]} {word()}") for k in range(3)]  # near copies
    rows += [(None, "site3", copy), (None, "site3", copy), (None, "site3", line()), (1200, "small", copy), (1201, None, line())]
    rows += [(1300, "small", "\n".join(line() for _ in range(120))), rows[1], rows[1], rows[402]]
    return rows, labels, [(1, passage), (None, " ".join(rows[2][2].split()[:14])), (3, None), (4, "")], passage


def written(spark, folder, rows, labels, items):
    docs = prepared(spark).createDataFrame([(i, s, t, None if t is None else len(t), "x", "y", "z") for i, s, t in rows],
                                           CLASHING)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def uncontaminated(rows, items, n=13):
    windows = set()
    for _, t in items:
        w = (t or "").split()
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    kept = []
    for row in rows:
        w = (row[2] or "").lower().replace("!", " ").split()
        hit = {p for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows for p in range(k, k + n)}
        if not hit or 20 * len(hit) < len(w):
            kept.append(row)
    return kept


def pieces(rows, capacity=1024):
    from tokenizers import Tokenizer

    from candela.llm.queries import vocabulary
    coder = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    out = []
    for i, _, t in rows:
        ids = np.array(coder.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at, length, piece = 0, (len(ids) - 1) % capacity + 1, 0
        while at < len(ids):
            out.append((i, piece, at, length, zlib.crc32(ids[at:at + length].tobytes())))
            at, length, piece = at + length, capacity, piece + 1
    return sorted(out, key=str)


def packed(rows):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for found in by_sequence.values():
        ends = [0, *(a + n for a, n in sorted(found))]
        assert [a for a, _ in sorted(found)] == ends[:-1] and ends[-1] <= 1024
    return sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str)


def test_stages_and_run_equal_brute_force(spark, tmp_path):
    rows, labels, items, passage = corpus()
    docs = written(spark, tmp_path, rows, labels, items)
    bad = {i for i, y in labels if not y}
    good = [r for r in rows if r[0] not in bad]
    clean = without_boilerplate(good)
    apart = without_near_copies(clean)
    left = uncontaminated(apart, items)
    assert len(rows) > len(good) > len(apart) > len(left) and any(passage in r[2] for r in apart)
    assert [r[2] for r in apart if r[0] == 1000] == [rows[400][2]]  # one document of the copies, with its text
    want = dict(zip([name for name, _ in P.STAGES], [good, clean, apart, left, None]))
    given = rows
    for name, stage in P.STAGES:
        df = spark.createDataFrame([(i, s, t, None if t is None else len(t), "x", "y", "z") for i, s, t in given], CLASHING)
        got = stage(spark, df, str(tmp_path)).collect()
        if want[name] is None:
            assert packed(got) == pieces(given), name
        else:
            assert in_order((r.doc_id, r.source, r.text) for r in got) == in_order(want[name]), name
            assert list(got[0].asDict()) == docs.columns, name
            given = want[name]
    assert packed(P.run(spark, str(tmp_path)).collect()) == pieces(left)


def test_run_on_empty_tables_and_odd_texts(spark, tmp_path):
    written(spark, tmp_path / "empty", [], [], [])
    assert P.run(spark, str(tmp_path / "empty")).count() == 0
    odd = [(1, "s", None), (1, "s", None), (None, None, None), (2, "s", ""), (2, "s", ""), (3, None, " \n\t"), (3, None, "\n")]
    docs = written(spark, tmp_path / "odd", odd, [], [])
    rest = P.near_dedup(spark, P.line_dedup(spark, docs, ""), "")
    rest = P.benchmark_decontamination(spark, rest, str(tmp_path / "odd"))
    want = sorted(set(odd), key=str)
    assert sorted(((r.doc_id, r.source, r.text) for r in rest.collect()), key=str) == want
    assert packed(P.packing(spark, rest, "").collect()) == pieces(want)
    assert P.quality(spark, docs, str(tmp_path / "odd")).count() == 0  # without labels all scores are 0.5
