"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = f"""
d AS (SELECT row_number() OVER () AS rid, * REPLACE (coalesce(text, '') AS text) FROM documents),
l AS (SELECT rid, regexp_extract_all(text, '{_WORD}') AS ws FROM d),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM l)"""

OP4 = rf"""
WITH {_WORDS},
win AS (SELECT rid, i, string_agg(word, ' ') OVER win50 AS g, count(*) OVER win50 AS n FROM w
        WINDOW win50 AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
g AS (SELECT rid, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS least FROM win JOIN d USING (rid) WHERE n = 50),
gone AS (SELECT DISTINCT rid, i + k AS i FROM g, range(0, 50) r(k) WHERE least < doc_id),
m AS (SELECT w.rid, w.i, word, gone.i IS NOT NULL AS removed FROM w LEFT JOIN gone ON w.rid = gone.rid AND w.i = gone.i)
SELECT doc_id, count(m.i) AS n_words, count(m.i) FILTER (WHERE removed) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY m.i) FILTER (WHERE NOT removed), '')) AS kept_sha256
FROM d LEFT JOIN m USING (rid) GROUP BY rid, doc_id"""

OP6 = rf"""
WITH {_WORDS},
x AS (SELECT rid, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM w
      WINDOW o AS (PARTITION BY rid ORDER BY i)),
y AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM x WHERE c IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM y, range(0, 3) r(k) WHERE n >= 2 GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY rid),
m AS (SELECT doc_id, source, len(ws) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN l USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
s AS (SELECT *, base_failed OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 50 * n_words
             OR 1000 * n_dup_lines > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words AS soft FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE soft) AS k FROM s GROUP BY source),
p AS (SELECT sum(k) / sum(n) AS m, var_pop(k / n) AS v FROM h),
q AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 2), 10000) ELSE 10000 END AS size FROM p),
r AS (SELECT source, (k + m * size) / (n + size) AS rate, m FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (soft AND rate >= 1.5 * m AND rate >= 0.1)) AS kept
FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source"""

OP7 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tokens,
             24 + length(replace(replace(role, '~', '~0'), '<|', '~1')) + length(replace(replace(text, '~', '~0'), '<|', '~1')) AS size
      FROM c),
b AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY i) - tokens AS before FROM t),
s AS (SELECT *, before // 1024 AS own, greatest(before // 1024 + 1, (before + tokens) // 1024) AS following FROM b),
sys AS (SELECT conv_id, min(i) AS i, arg_min(size, i) AS size FROM s WHERE role = 'system' GROUP BY conv_id),
spans AS (SELECT DISTINCT conv_id, own FROM s),
history AS (SELECT s.conv_id, s.own AS home, spans.own, s.i, s.size FROM s JOIN spans ON s.conv_id = spans.conv_id
            AND spans.own = following WHERE before + tokens > following * 1024 - 128),
placed AS (SELECT conv_id, own, i, size FROM s UNION ALL SELECT conv_id, own, i, size FROM history),
records AS (SELECT conv_id, own, min(i) AS first, sum(size) AS size FROM placed GROUP BY conv_id, own),
sizes AS (SELECT r.conv_id, sum(r.size + CASE WHEN sys.i < r.first THEN sys.size ELSE 0 END) AS formatted_chars
          FROM records r LEFT JOIN sys ON r.conv_id = sys.conv_id GROUP BY r.conv_id)
SELECT s.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       any_value(formatted_chars)::BIGINT AS formatted_chars
FROM s JOIN sizes ON s.conv_id = sizes.conv_id GROUP BY s.conv_id"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = rf"""
WITH RECURSIVE l AS (SELECT row_number() OVER () AS rid, doc_id,
                            regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM l WHERE len(ws) >= 4),
x AS (SELECT rid, string_agg(word, ' ') OVER four AS g, count(*) OVER four AS n FROM w
      WINDOW four AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
g AS (SELECT DISTINCT rid, g FROM x WHERE n = 4
      UNION ALL SELECT rid, array_to_string(ws, ' ') FROM l WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
pairs AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.rid < b.rid GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM pairs p JOIN n x ON x.rid = p.a JOIN n y ON y.rid = p.b
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rid AS a, rid AS b FROM l UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
SELECT o.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(m.doc_id) AS component_id
FROM l o LEFT JOIN n USING (rid) JOIN reach r ON r.a = o.rid JOIN l m ON m.rid = r.b GROUP BY o.rid, o.doc_id"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP10 = rf"""
WITH l AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM l),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS ws FROM benchmark),
iw AS (SELECT item, ws, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS i, least(len(ws), 10) AS m FROM b WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item, m, array_to_string(ws[i:i + m - 1], ' ') AS g FROM iw),
sizes AS (SELECT DISTINCT m FROM windows),
dw AS (SELECT w.rid, w.i, s.m, array_to_string(l.ws[w.i:w.i + s.m - 1], ' ') AS g FROM w JOIN l USING (rid), sizes s
       WHERE w.i + s.m - 1 <= len(l.ws)),
hits AS (SELECT rid, i, dw.m, item FROM dw JOIN windows ON dw.g = windows.g AND dw.m = windows.m),
words AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM hits, range(0, 10) r(k) WHERE k < m GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM l LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)"""

OP12 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
f AS (SELECT doc_id, part, CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
             + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END AS mask FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic,
             bit_count(mask) AS many FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT v.c || w.c || x.c || y.c || z.c AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
      FROM c v, c w, c x, c y, c z WHERE v.b + w.b + x.b + y.b + z.b = 31 AND (v.b | w.b | x.b | y.b | z.b) = 31),
s AS (SELECT filter_order, step::INTEGER AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
      FROM o, range(1, 6) r(step))
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (WHERE mask & (own | before) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (WHERE mask = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * (120 // greatest(many, 1))) FILTER (WHERE mask & own <> 0), 0)::BIGINT AS shapley
FROM m, s GROUP BY part, filter_order, step"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS ts FROM documents),
g AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS docs, sum(len(ts))::HUGEINT AS total FROM d),
b AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS ts FROM benchmark),
q AS (SELECT iid, item_id, term, count(*) AS reps FROM (SELECT iid, item_id, unnest(ts) AS term FROM b) GROUP BY ALL),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term, docs),
m AS (SELECT rid, doc_id, 25 + ((75 * len(ts)::HUGEINT * docs) // total)::BIGINT AS m FROM d, g WHERE len(ts) > 0),
s AS (SELECT iid, item_id, m.rid, m.doc_id, sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY iid, item_id, m.rid, m.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id, rid) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10"""

ORACLE = {"op4_recompression": OP4, "op6_quality": OP6, "op7_chat": OP7, "op8_jaccard": OP8, "op10_decontaminate": OP10,
          "op11_rank": OP11, "op12_audit": OP12}
