"""SQL (DuckDB dialect) that says the same as the registered queries, from the given tables alone.

Operators 1, 6, 8, 9 and 10 (models, byte-pair merging, a block tree, the
tokenizer's ids) and 7 (XXH64) have none; tests hold them against brute force.
"""

from __future__ import annotations

from .decontam import WINDOW
from .licenses import COVERAGE, SLACK, WORD, template_pairs
from .lpf import LENGTH
from .vafile import K, QUERY_EVERY, SCALE

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '{WORD}')"

TOP_K = f"""
WITH e AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM e q JOIN e c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= {K}"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item, w[i:i + {WINDOW - 1}] AS pattern FROM starts),
n AS (SELECT DISTINCT len(pattern) AS n FROM p),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n),
m AS (SELECT DISTINCT doc_id, i, n, item FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS pattern FROM places) JOIN p USING (pattern)),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM m) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)"""

_PAIRS = ", ".join(f"({t}, '{label}', {phrase}, {pairs}, {place}, '{a}', '{b}')"
                   for t, label, phrase, pairs, place, a, b in template_pairs() if t)

LICENSES = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT * FROM (VALUES {_PAIRS}) AS t(template, label, phrase, pairs, place, t1, t2)),
places AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d),
pair AS (SELECT doc_id, i - 1 AS word_at, w[i] AS t1, w[i + 1] AS t2 FROM places),
hit AS (SELECT doc_id, template, label, phrase, pairs, word_at, place, word_at - place AS diagonal, count(*) OVER (PARTITION BY doc_id, template, word_at - place) AS votes
        FROM pair JOIN t USING (t1, t2)),
diag AS (SELECT DISTINCT doc_id, template, diagonal FROM hit WHERE NOT phrase AND votes >= 2),
near AS (SELECT diag.doc_id, diag.template, diag.diagonal, any_value(label) AS label, any_value(pairs) AS pairs,
                list({{'p': CAST(place AS BIGINT), 'f': CAST([] AS BIGINT[])}} ORDER BY word_at, place DESC) AS l
         FROM diag JOIN hit ON hit.doc_id = diag.doc_id AND hit.template = diag.template AND hit.votes >= 2 AND abs(hit.diagonal - diag.diagonal) <= {SLACK}
         GROUP BY ALL HAVING count(DISTINCT place) >= {COVERAGE} * any_value(pairs)),
run AS (SELECT doc_id, label, pairs, list_reduce(
            [{{'p': CAST(-1 AS BIGINT), 'f': list_transform(range(pairs + 1), lambda i: CAST(0 AS BIGINT))}}] || l,
            lambda s, h: {{'p': h.p, 'f': list_transform(s.f, lambda x, i: CASE WHEN i - 1 > h.p THEN greatest(x, s.f[h.p + 1] + 1) ELSE x END)}}).f[pairs + 1] AS held
        FROM near),
span AS (SELECT doc_id, label, true AS phrase, min(word_at) AS a, 1.0 AS held FROM hit WHERE phrase
         GROUP BY doc_id, template, label, pairs, diagonal HAVING count(*) = pairs
         UNION ALL SELECT doc_id, label, false, NULL, held / pairs FROM run WHERE held >= {COVERAGE} * pairs),
found AS (SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(a) FILTER (phrase) AS first_word, max(a) FILTER (phrase) AS last_word,
                 coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (phrase)), ','), '') AS base_labels,
                 array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(held) AS score FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN found USING (doc_id)"""

SUFFIX_DEDUP = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
n AS (SELECT doc_id, t, octet_length(t) AS n FROM d),
places AS (SELECT doc_id, t, unnest(range(1, n - {LENGTH - 1} + 1)) AS i FROM n WHERE n >= {LENGTH}),
s AS (SELECT doc_id, i, t[i:i + {LENGTH - 1}] AS s FROM places),
first AS (SELECT s, min(doc_id) AS least FROM s GROUP BY s HAVING count(*) > 1),
copy AS (SELECT DISTINCT doc_id, i FROM s JOIN first USING (s) WHERE doc_id > least),
apart AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {LENGTH} THEN 0 ELSE 1 END AS new FROM copy),
runs AS (SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS z
         FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM apart) GROUP BY doc_id, run),
gap AS (SELECT doc_id, coalesce(lag(z) OVER part, 1) AS from_byte, a AS to_byte FROM runs WINDOW part AS (PARTITION BY doc_id ORDER BY a)
        UNION ALL SELECT doc_id, max(z), NULL FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(hex(CASE WHEN coalesce(to_byte, n + 1) > from_byte THEN t[from_byte:coalesce(to_byte, n + 1) - 1]
                                            ELSE encode('') END), '' ORDER BY from_byte) AS k FROM gap JOIN n USING (doc_id) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed FROM runs GROUP BY doc_id)
SELECT n.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(from_hex(k), t)) AS kept_sha256
FROM n LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)"""

# CRC-32 by its table, a shortest path backwards by recursion, and the least of the cheapest edits forwards.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
        FROM (SELECT CAST(range AS BIGINT) AS n FROM range(256))),
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
fault AS (SELECT raw.*, xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT)),
                            lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 20 AS f FROM raw, crc),
damaged AS (
    SELECT c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM fault, (SELECT unnest([1, 2]) AS copy) WHERE f <> 0 AND (copy = 1 OR f = 3)),
placed AS (
    SELECT c, i, turn, role, text, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core
    FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)),
row AS (
    SELECT c, i, turn, role, text, left(role, 1) AS initial, core = '' AS blank, core <> '' AND again AS duplicate,
           core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS truncated, core = '' OR again AS gone FROM placed),
size AS (SELECT c, max(i) AS n FROM row GROUP BY c),
back AS (
    SELECT c, n + 1 AS i, CAST(0 AS BIGINT) AS b0, CAST(10 AS BIGINT) AS b1, CAST(5 AS BIGINT) AS b2, CAST(0 AS BIGINT) AS b3 FROM size
    UNION ALL
    SELECT c, i, least(r0, r2 + 5, r3 + 10), least(r1, r2 + 5, r3 + 10), least(r2, r3 + 5), least(r3, r2 + 5)
    FROM (SELECT row.c, row.i,
                 least(2 + b0, CASE WHEN gone THEN 1000000000 ELSE least(1 + b2, CASE initial WHEN 'u' THEN b2 WHEN 's' THEN b1 ELSE 1000000000 END) + e END) AS r0,
                 least(2 + b1, CASE WHEN gone THEN 1000000000 ELSE least(1 + b2, CASE initial WHEN 'u' THEN b2 ELSE 1000000000 END) + e END) AS r1,
                 least(2 + b2, CASE WHEN gone THEN 1000000000 ELSE least(1 + b3, CASE initial WHEN 'a' THEN b3 ELSE 1000000000 END) + e END) AS r2,
                 least(2 + b3, CASE WHEN gone THEN 1000000000 ELSE least(1 + b2, CASE initial WHEN 'u' THEN b2 ELSE 1000000000 END) + e END) AS r3
          FROM back JOIN (SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS e FROM row) AS row ON row.c = back.c AND row.i = back.i - 1)),
b AS (SELECT c, i, [b0, b1, b2, b3] AS b FROM back),
walk AS (
    SELECT c, CAST(1 AS BIGINT) AS i, 0 AS s, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM size
    UNION ALL
    SELECT c, CASE edit WHEN 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN s WHEN 'K' THEN kept ELSE nxt END, audit || edit,
           CASE edit WHEN 'D' THEN lines WHEN 'K' THEN lines || [role || ':' || text]
                     ELSE lines || [CASE nxt WHEN 2 THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END] END
    FROM (SELECT w.*, role, text, nxt, kept,
                 CASE WHEN w.i <= n AND 2 + after.b[s + 1] = now.b[s + 1] THEN 'D' WHEN 5 + now.b[nxt + 1] = now.b[s + 1] THEN 'I'
                      WHEN NOT gone AND kept IS NOT NULL AND after.b[kept + 1] + e = now.b[s + 1] THEN 'K' ELSE 'R' END AS edit
          FROM (SELECT walk.*, n, CASE s WHEN 2 THEN 3 ELSE 2 END AS nxt FROM walk JOIN size USING (c)) w
          JOIN b AS now ON now.c = w.c AND now.i = w.i
          LEFT JOIN b AS after ON after.c = w.c AND after.i = w.i + 1
          LEFT JOIN (SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS e FROM row) AS row ON row.c = w.c AND row.i = w.i,
          LATERAL (SELECT CASE WHEN initial = 's' AND s = 0 THEN 1 WHEN initial = 'u' AND s <> 2 THEN 2 WHEN initial = 'a' AND s = 2 THEN 3 END AS kept)
          WHERE w.i <= n OR s IN (1, 2))),
made AS (SELECT walk.c, audit, array_to_string(lines, chr(10)) AS body FROM walk JOIN size USING (c) WHERE walk.i = n + 1 AND s IN (0, 3)),
stat AS (
    SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (truncated) AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY i) AS before FROM row) GROUP BY c),
conv AS (SELECT DISTINCT c, conv_id FROM raw)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(b.b[1], 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM conv LEFT JOIN stat USING (c) LEFT JOIN b ON b.c = conv.c AND b.i = 1 LEFT JOIN made ON made.c = conv.c"""

JACCARD_JOIN = """
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d),
class AS (SELECT list_sort(s) AS s, min(doc_id) AS rep, CAST(len(s) AS BIGINT) AS n FROM s WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
token AS (SELECT rep, n, unnest(s) AS t FROM class),
common AS (SELECT a.rep AS a, b.rep AS b, a.n AS an, b.n AS bn, count(*) AS i FROM token a JOIN token b ON a.t = b.t AND a.rep < b.rep GROUP BY ALL),
link AS (SELECT a, b FROM common WHERE 100 * i >= 80 * (an + bn - i)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT rep AS a, rep AS b FROM class UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
least AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(least.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN class ON list_sort(s.s) = class.s LEFT JOIN least USING (rep)"""

HARD_NEGATIVES = """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3"""

ORACLES = {
    "op2_top_k": TOP_K,
    "op3_decontamination": DECONTAMINATION,
    "op4_licenses": LICENSES,
    "op5_suffix_dedup": SUFFIX_DEDUP,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_jaccard_join": JACCARD_JOIN,
    "op13_hard_negatives": HARD_NEGATIVES,
}
