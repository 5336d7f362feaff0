"""DuckDB SQL for the queries of the training-data operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op9_decontaminate"] = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
        FROM item WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM doc, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, dw.n, i FROM dw JOIN iw USING (n, win)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLES["op10_url_filters"] = rf"""
WITH part AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM part),
rules(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                             ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
  SELECT page_id, rh || rp AS rule, rv,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT u.page_id, host, path, rule, coalesce(rv, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM fit WHERE k = 1) f ON u.page_id = f.page_id"""

ORACLES["op2_line_dedup"] = r"""
WITH page AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
distinct_text AS (SELECT row_number() OVER () AS page, source, text FROM (SELECT DISTINCT source, text FROM documents)),
line AS (
  SELECT DISTINCT page, source, trim(l, chr(32) || chr(9) || chr(13)) AS k
  FROM (SELECT page, source, unnest(string_split(text, chr(10))) AS l FROM distinct_text)
  WHERE trim(l, chr(32) || chr(9) || chr(13)) <> ''),
site AS (SELECT source, count(*) AS n FROM distinct_text GROUP BY 1),
drops AS (
  SELECT source, k FROM line GROUP BY source, k
  HAVING count(*) > 0.1 * (SELECT n FROM site WHERE site.source IS NOT DISTINCT FROM line.source)
     AND count(*) >= 5),
dropped AS (SELECT source, list(k) AS ks FROM drops GROUP BY 1),
judged AS (
  SELECT doc_id, p.source, text, lines,
         list_filter(lines, lambda l: NOT list_contains(coalesce(ks, []), trim(l, chr(32) || chr(9) || chr(13)))) AS kept
  FROM page p LEFT JOIN dropped d ON p.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text,
       CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped
FROM judged"""

ORACLES["op8_embedding_near_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
good AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT v.vec_id, coalesce(l.n, 0) AS n_links, r.c AS component_id, v.vec_id = r.c AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY 1) l ON l.a = v.vec_id
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) r ON r.a = v.vec_id"""

# crc32 as SQL: a table of 256 entries by its rule, then one step for each byte of the text.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc32(text: str) -> str:
    """Unsigned crc32 of a SQL text; ``t`` of the table above must be in scope."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode({text}))),
         lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))),
         lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])))"""


ORACLES["op12_spelling_variants"] = rf"""
WITH RECURSIVE {CRC_TABLE},
run AS (
  SELECT doc_id, w, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS sent
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
               '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents)
  GROUP BY ALL),
summed AS (SELECT w, n, {crc32("sent")} AS h FROM run, crc_table),
word AS (
  SELECT w, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2)
                    ELSE w END AS w, n FROM summed)
  GROUP BY 1 HAVING length(w) >= 6 AND sum(n) >= 5),
less AS (
  SELECT w, n, i, substr(w, 1, i) || substr(w, i + 2) AS rest FROM (SELECT w, n, unnest(range(length(w))) AS i FROM word)),
pair AS (
  SELECT DISTINCT a.w AS a, b.w AS b FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.w <> b.w
  UNION SELECT less.w, word.w FROM less JOIN word ON less.rest = word.w
  UNION SELECT word.w, less.w FROM less JOIN word ON less.rest = word.w),
near AS (
  SELECT a AS w, word.w AS o, word.n AS o_n, row_number() OVER (PARTITION BY a ORDER BY word.n DESC, word.w) AS k,
         count(*) OVER (PARTITION BY a) AS n_near
  FROM pair JOIN word ON pair.b = word.w),
judged AS (
  SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN o_n >= 5 * word.n THEN o END AS form,
         CASE WHEN o_n >= 5 * word.n THEN o_n END AS form_n
  FROM word LEFT JOIN (SELECT * FROM near WHERE k = 1) x ON x.w = word.w),
path AS (
  SELECT w, w AS here, 0 AS step FROM judged
  UNION ALL SELECT path.w, form, step + 1 FROM path JOIN judged ON judged.w = path.here WHERE form IS NOT NULL),
root AS (SELECT w, arg_max(here, step) AS root FROM path GROUP BY 1)
SELECT judged.w AS word, form, root, n, n_near, form_n FROM judged JOIN root ON root.w = judged.w"""

FAN = 16
ORACLES["op11_merkle_manifest"] = rf"""
WITH RECURSIVE {CRC_TABLE},
field AS (
  SELECT doc_id, source, lang, n_chars, text,
         coalesce({crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0, false) AS tampered FROM documents, crc_table),
coded AS (
  SELECT doc_id, source, tampered,
         {" || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars"))} AS front,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS back,
         coalesce(octet_length(encode(text)) || ':' || translate(text, '{UPPER}', '{LOWER}'), '-') AS back_low FROM field),
leaf AS (
  SELECT doc_id, source, sha256(front || back) AS leaf,
         sha256(front || CASE WHEN tampered THEN back_low ELSE back END) AS shown FROM coded),
placed AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaf),
node AS (
  SELECT tree, 0 AS level, pos AS idx, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // {FAN}, sha256(string_agg(h, '' ORDER BY idx)), count(*) OVER (PARTITION BY tree)
  FROM node WHERE n > 1 GROUP BY tree, level, idx // {FAN}),
subroot AS (SELECT tree, h FROM node WHERE n = 1),
crown AS (
  SELECT 0 AS level, tree AS idx, h, count(*) OVER () AS n FROM subroot
  UNION ALL
  SELECT level + 1, idx // {FAN}, sha256(string_agg(h, '' ORDER BY idx)), count(*) OVER ()
  FROM crown WHERE n > 1 GROUP BY level, idx // {FAN}),
step AS (
  SELECT id, level, p, string_agg(h, '' ORDER BY idx) FILTER (WHERE idx < p) AS lo, string_agg(h, '' ORDER BY idx) FILTER (WHERE idx > p) AS hi
  FROM (SELECT id, level, pos // CAST(pow({FAN}, level) AS BIGINT) AS p, idx, h
        FROM placed JOIN node ON node.tree = placed.tree AND n > 1
         AND idx // {FAN} = pos // CAST(pow({FAN}, level + 1) AS BIGINT))
  GROUP BY ALL
  UNION ALL
  SELECT id, 100 + level, p, string_agg(h, '' ORDER BY idx) FILTER (WHERE idx < p), string_agg(h, '' ORDER BY idx) FILTER (WHERE idx > p)
  FROM (SELECT id, level, tree // CAST(pow({FAN}, level) AS BIGINT) AS p, idx, h
        FROM placed JOIN crown ON n > 1 AND idx // {FAN} = tree // CAST(pow({FAN}, level + 1) AS BIGINT))
  GROUP BY ALL),
path AS (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY level) AS k, coalesce(lo, '') AS lo, coalesce(hi, '') AS hi FROM step),
proof AS (SELECT id, sha256(string_agg(lo || hi, '' ORDER BY k)) AS p FROM path GROUP BY 1),
folded AS (
  SELECT id, CAST(0 AS BIGINT) AS k, shown AS h FROM placed
  UNION ALL
  SELECT folded.id, path.k, sha256(lo || h || hi) FROM folded JOIN path ON path.id = folded.id AND path.k = folded.k + 1),
top AS (SELECT id, arg_max(h, k) AS h FROM folded GROUP BY 1),
root AS (SELECT h FROM crown WHERE n = 1)
SELECT doc_id, leaf, subroot.h AS subroot, root.h AS root, coalesce(p, sha256('')) AS proof_sha256,
       top.h AS folded_root, top.h = root.h AS verified
FROM placed JOIN subroot ON subroot.tree = placed.tree JOIN top ON top.id = placed.id LEFT JOIN proof ON proof.id = placed.id, root"""
