"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

import math

from concord.llm import quality_rules as Q

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _folded(col: str) -> str:
    return f"translate(coalesce({col}, ''), '{_UPPER}', '{_LOWER}')"


OP10 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_folded('text')}, '{_ALNUM}') AS w
           FROM documents),
i AS (SELECT item_id, regexp_extract_all({_folded('text')}, '{_ALNUM}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS m,
               array_to_string(list_slice(w, k, k + least(len(w), 10) - 1), ' ') AS words
        FROM i, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(k) WHERE len(w) > 0),
lens AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, m, k, array_to_string(list_slice(w, k, k + m - 1), ' ') AS words
       FROM d, lens, unnest(range(1, greatest(len(w) - m + 2, 1))) AS u(k)),
hit AS (SELECT DISTINCT doc_id, dw.m, k, item_id FROM dw JOIN win USING (m, words)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP2 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_folded('text')}, '{_WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + least(len(w), 5) - 1), ' ') AS s
       FROM d, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS u(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b USING (s)
      WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
      WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce((SELECT min(y) FROM r WHERE r.x = d.doc_id), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

#: CRC-32 by bytes: a table by recursion, folded over the hexadecimal digits of the text.
_CRC_TABLE = """
t(n, k, c) AS (
  SELECT n, 0, n FROM range(256) r(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM t WHERE k < 8),
tab AS (SELECT list(c ORDER BY n) AS tab FROM t WHERE k = 8)"""


def _crc(col: str) -> str:
    digits = (f"list_transform(regexp_extract_all(hex(encode(coalesce({col}, ''))), '..'), "
              "lambda x: ('0x' || x)::BIGINT)")
    return (f"xor(list_reduce({digits}, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), "
            "4294967295::BIGINT), 4294967295)")


OP4 = f"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
             {_crc('text')} AS crc, ({_crc('source')} % 12)::INT AS old
      FROM documents, tab),
n AS (SELECT k, count(old) AS n FROM range(16) s(k) LEFT JOIN r ON old = k GROUP BY k),
b AS (SELECT sum(n)::BIGINT // 16 AS base, sum(n)::BIGINT % 16 AS extra FROM n),
by_size AS (SELECT *, row_number() OVER (PARTITION BY old ORDER BY size, doc_id, crc) AS rk FROM r),
over AS (SELECT k, row_number() OVER (ORDER BY size DESC, k) AS pick
         FROM n JOIN by_size ON old = k, b WHERE n.n > base AND rk = n.n - base),
rest AS (SELECT k, row_number() OVER (ORDER BY k) + (SELECT count(*) FROM over) AS pick
         FROM n, b WHERE n.n <= base),
want AS (SELECT n.k, n.n, base + (pick <= extra)::INT AS want
         FROM n JOIN (SELECT * FROM over UNION ALL SELECT * FROM rest) USING (k), b),
room AS (SELECT k, sum(greatest(want - n, 0)) OVER (ORDER BY k) AS upto,
                greatest(want - n, 0) AS room FROM want),
going AS (SELECT by_size.*, row_number() OVER (ORDER BY old, doc_id, crc, size) - 1 AS i
          FROM by_size JOIN want ON old = k WHERE rk <= n - want),
placed AS (
  SELECT doc_id, size, crc, k AS shard FROM going JOIN room ON i < upto AND i >= upto - room
  UNION ALL
  SELECT doc_id, size, crc, old FROM by_size JOIN want ON old = k WHERE rk > n - want)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, crc, size) - 1 AS slot,
       NULL::INT AS grown_shard
FROM placed
"""

OP5 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n,
                  sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)
"""

def op8() -> str:
    """Base counts, histograms, pooled references and Jensen-Shannon distances."""
    common = ", ".join(f"('{lang}', {i}, '{w}')" for lang, ws in Q.COMMON_WORDS.items()
                       for i, w in enumerate(ws.split()))
    patterns = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "space": r"\x20\x09",
                "newline": r"\x0A\x0D", "stop": ".,;:!?", "symbol": "#*$%&|<>",
                "quote": r"''\x22()-"}
    of = {k: f"length(regexp_replace(t, '[^{p}]', '', 'g'))" for k, p in patterns.items()}
    of["high"] = r"length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))"
    of["other"] = f"length(t) - ({' + '.join(of.values())})"
    counts = [of[k] for k in Q.CLASSES]
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / (x[1] + x[2])) ELSE 0 END"
    distance = ("sqrt(greatest(0, list_sum(list_transform(list_zip(p, q), lambda x: 0.5 * (("
                + part.format("x[1]") + ") + (" + part.format("x[2]") + "))))))")
    noise = 8 * math.log(2)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
pos AS (SELECT r, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM d),
tri AS (SELECT r, i, count(*) OVER (PARTITION BY r, w1, w2, w3) AS n FROM (
          SELECT r, i, x AS w1, lead(x) OVER s AS w2, lead(x, 2) OVER s AS w3 FROM pos
          WINDOW s AS (PARTITION BY r ORDER BY i)) WHERE w3 IS NOT NULL),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM tri WHERE n > 1) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '{_WORD}') GROUP BY r),
common(lang, bin, word) AS (VALUES {common}),
bins AS (SELECT r, bin, count(*) AS n FROM d JOIN pos USING (r)
         JOIN common c ON c.lang = d.lang AND {_folded('x')} = c.word GROUP BY r, bin),
allbins AS (SELECT r, bin, coalesce(b.n, 0) AS n FROM d JOIN common c ON c.lang = d.lang LEFT JOIN bins b USING (r, bin)),
hist AS (SELECT r, list(n ORDER BY bin) AS h, sum(n) AS s FROM allbins GROUP BY r),
f AS (SELECT r, doc_id, d.lang, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             [{', '.join(counts)}] AS chars, list_append(coalesce(h, []), (len(w) - coalesce(s, 0))::BIGINT) AS words
      FROM d LEFT JOIN lines USING (r) LEFT JOIN rep USING (r) LEFT JOIN hist USING (r)),
g AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f),
rc AS (SELECT lang, list(n ORDER BY i) AS ref FROM (SELECT lang, i, sum(v) AS n FROM (
         SELECT lang, unnest(chars) AS v, generate_subscripts(chars, 1) AS i FROM g WHERE NOT base_failed) GROUP BY ALL) GROUP BY lang),
rw AS (SELECT lang, list(n ORDER BY i) AS ref FROM (SELECT lang, i, sum(v) AS n FROM (
         SELECT lang, unnest(words) AS v, generate_subscripts(words, 1) AS i FROM g WHERE NOT base_failed) GROUP BY ALL) GROUP BY lang),
pq AS (SELECT g.*, list_sum(chars)::DOUBLE AS nc, rc.ref AS qc, rw.ref AS qw FROM g LEFT JOIN rc USING (lang) LEFT JOIN rw USING (lang)),
dist AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, nc, len(chars) AS bc, len(words) AS bw,
    (SELECT {distance} FROM (SELECT list_transform(chars, lambda x: x / greatest(1, list_sum(chars))) AS p,
                               list_transform(qc, lambda x: x / greatest(1, list_sum(qc))) AS q)) AS dc,
    (SELECT {distance} FROM (SELECT list_transform(words, lambda x: x / greatest(1, list_sum(words))) AS p,
                               list_transform(qw, lambda x: x / greatest(1, list_sum(qw))) AS q)) AS dw
  FROM pq)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND NOT coalesce(nc >= {Q.CHAR_MIN} AND dc * dc > {Q.CHAR_LIMIT ** 2} + (bc - 1) / (nc * {noise}), false)
  AND NOT coalesce(n_words >= {Q.WORD_MIN} AND dw * dw > {Q.WORD_LIMIT ** 2} + (bw - 1) / (n_words * {noise}), false) AS kept
FROM dist
"""


OP11 = """
WITH e AS (SELECT vec_id, label::BIGINT AS label, embedding::DOUBLE[] AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL),
v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(x, lambda c: floor(256 * c)) AS v
      FROM e WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             list_inner_product(a.v, b.v)::BIGINT AS score
      FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INT AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
               sha256(octet_length(encode(role))::VARCHAR || ':' || role || text)) AS w
      FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, w, conv_id - conv_id % 5 AS base, ({_crc('conv_id::VARCHAR')} % 9)::INT AS h
      FROM o, tab),
r AS (SELECT h.conv_id, list_concat(list_slice(coalesce(b.w, []), 1, h), list_slice(h.w, h + 1, len(h.w))) AS w
      FROM h LEFT JOIN o b ON b.conv_id = h.base),
m AS (SELECT conv_id, d, list_slice(w, 1, d) AS p, len(w) = d AS ends,
             CASE WHEN d > 0 THEN octet_length(encode(w[d].text)) ELSE 0 END AS size
      FROM r, unnest(range(0, len(w) + 1)) AS u(d)),
n AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
      FROM m GROUP BY p, d),
c AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n FROM n WHERE d > 0 GROUP BY ALL),
q AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM n LEFT JOIN c ON c.p = n.p),
a AS (SELECT list_slice(p, 1, k) AS p, n_children = 0 AS leaf, (n_convs - 1) * size AS saved
      FROM q, unnest(range(0, d + 1)) AS u(k)),
s AS (SELECT p, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved FROM a GROUP BY p)
SELECT q.conv_id, q.d AS depth, u.conv_id AS parent_conv_id, q.n_convs, q.n_children, s.n_leaves,
       s.saved AS saved_tokens, q.ends_sha256
FROM q JOIN s ON s.p = q.p LEFT JOIN n u ON q.d > 0 AND u.d = q.d - 1 AND u.p = list_slice(q.p, 1, q.d - 1)
"""

OP13 = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
ok AS (SELECT r, vec_id, label, x FROM e WHERE vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL
         AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
         AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.r, b.r AS other, b.vec_id FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r
      WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
n AS (SELECT r, count(*) AS n FROM l GROUP BY r),
g AS (SELECT r, r AS other FROM e UNION SELECT g.r, l.other FROM g JOIN l ON l.r = g.other),
c AS (SELECT g.r, min(e.vec_id) AS component_id FROM g JOIN e ON e.r = g.other GROUP BY g.r)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id,
       coalesce(e.vec_id = c.component_id, false) AS kept
FROM e LEFT JOIN n USING (r) JOIN c USING (r)
"""

ORACLE_SQL: dict[str, str] = {"op8_quality_rules": op8(),
                              "op4_min_cost_flow_sharding": OP4, "op5_warc_splittable": OP5,
                              "op2_ngram_jaccard_join": OP2,
                              "op10_decontamination": OP10,
                              "op11_hard_negatives": OP11, "op12_prefix_trie": OP12,
                              "op13_embedding_near_dedup": OP13}
