"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from textmill.llm.licenses import TEMPLATES

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, source, t,
             list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
      FROM d),
wins AS (SELECT rid, unnest(range(len(w) - 4)) AS i, w FROM w WHERE len(w) >= 5),
keyed AS (SELECT rid, i, array_to_string(w[i + 1:i + 5], ' ') AS g FROM wins),
twice AS (SELECT rid, i FROM keyed QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY rid),
m AS (SELECT w.rid, doc_id, source, len(w)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN covered USING (rid)),
f AS (SELECT *, n_words < 10 AS a, 100 * n_repeat_words > 20 * n_words AS b FROM m),
h AS (SELECT source, count(*) AS n, sum(a::INT) AS a, sum(b::INT) AS b FROM f WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT avg(a / n) AS ma, var_pop(a / n) AS va, avg(b / n) AS mb, var_pop(b / n) AS vb FROM h),
p AS (SELECT ma, mb, CASE WHEN va > 0 THEN least(1e6, greatest(1, ma * (1 - ma) / va - 1)) ELSE 1e6 END AS ka,
             CASE WHEN vb > 0 THEN least(1e6, greatest(1, mb * (1 - mb) / vb - 1)) ELSE 1e6 END AS kb FROM s),
bad AS (SELECT source FROM h, p WHERE (a + ma * ka) / (n + ka) > 0.5 OR (b + mb * kb) / (n + kb) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, a OR b AS base_failed,
       source IS NOT NULL AND source IN (SELECT source FROM bad) AS host_failed,
       NOT (a OR b) AND NOT (source IS NOT NULL AND source IN (SELECT source FROM bad)) AS kept
FROM f
"""

LINE_DEDUP = r"""
WITH l AS (SELECT rid, doc_id, i, x[i] AS line,
                  translate(regexp_replace(x[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
           FROM (SELECT rid, doc_id, x, unnest(range(1, len(x) + 1)) AS i
                 FROM (SELECT row_number() OVER () AS rid, doc_id,
                              string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
many AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
f AS (SELECT *, key IN (SELECT key FROM many) AS gone FROM l)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY rid, doc_id
"""

_VALUES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())

LICENSES = rf"""
WITH x AS (SELECT 'd' AS kind, row_number() OVER () AS rid, doc_id, NULL AS template, coalesce(text, '') AS t FROM documents
           UNION ALL SELECT 't', NULL, NULL, template, body FROM (VALUES {_VALUES}) v(template, body)),
w AS (SELECT kind, rid, doc_id, template, list_filter(regexp_split_to_array(
             translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda y: y <> '') AS w
      FROM x),
s AS (SELECT kind, rid, doc_id, template, len(w) AS n, i, array_to_string(w[i + 1:i + 5], ' ') AS g
      FROM (SELECT *, unnest(range(len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
t AS (SELECT DISTINCT template, n, g FROM s WHERE kind = 't'),
size AS (SELECT template, count(*) AS n_shingles FROM t GROUP BY template),
h AS (SELECT s.rid, s.doc_id, t.template, t.n, s.i, s.g FROM s JOIN t USING (g) WHERE s.kind = 'd'),
win AS (SELECT rid, doc_id, template, n, g, unnest([i // n, i // n - 1]) AS k, i FROM h),
held AS (SELECT rid, doc_id, template, k * n AS start, count(DISTINCT g) AS found FROM win
         WHERE k >= 0 AND i + 5 <= k * n + 2 * n GROUP BY ALL)
SELECT doc_id, template, max(found)::BIGINT AS n_found, any_value(n_shingles)::BIGINT AS n_shingles,
       min(start)::BIGINT AS first_word
FROM held JOIN size USING (template) WHERE 100 * found >= 75 * n_shingles GROUP BY rid, doc_id, template
"""

SUFFIXES = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
wins AS (SELECT rid, doc_id, unnest(range(len(x) // 2 - 99)) AS s, x FROM d WHERE len(x) >= 200),
late AS (SELECT rid, s FROM (SELECT rid, doc_id, s, md5(substr(x, 2 * s + 1, 200)) AS w FROM wins)
         QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, s) > 1),
runs AS (SELECT rid, min(s) AS a, max(s) + 100 AS b FROM (
           SELECT rid, s, sum(fresh) OVER (PARTITION BY rid ORDER BY s) AS run FROM (
             SELECT rid, s, CASE WHEN s > lag(s) OVER (PARTITION BY rid ORDER BY s) + 100 THEN 1 ELSE 0 END AS fresh FROM late))
         GROUP BY rid, run),
kept AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM runs),
rest AS (SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS tail,
                string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS y
         FROM kept JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(y, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN rest USING (rid)
"""

# The checksum is computed bit by bit, since there is no function for it.
SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS mark, run, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (SELECT run, k, hex(encode(mark)) AS x FROM counted),
crc AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                        lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384::BIGINT) ELSE y // 2 END)),
               4294967295::BIGINT) AS h FROM bytes),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                        ELSE run END AS word, k FROM crc),
words AS (SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT word, n, p, left(word, p) || substr(word, p + 2) AS rest
        FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS m FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(near, (-m, encode(near))) AS near FROM pairs GROUP BY word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN near END AS form,
                 CASE WHEN m >= 2 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS tip, 0 AS depth FROM forms
          UNION ALL SELECT chain.word, form, depth + 1 FROM chain JOIN forms ON tip = forms.word WHERE form IS NOT NULL),
ends AS (SELECT word, arg_max(tip, depth) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

LEXICAL = r"""
WITH found AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text,
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
d AS (SELECT * FROM found WHERE len(t) > 0),
s AS (SELECT count(*)::BIGINT AS big_n, sum(len(t))::BIGINT AS l FROM d),
q AS (SELECT DISTINCT qid, item_id, unnest(regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM (SELECT row_number() OVER () AS qid, * FROM benchmark)),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, s GROUP BY term),
scored AS (SELECT qid, item_id, rid, doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // l))))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank
           FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op4_quality_rules": QUALITY,
    "op7_license_scan": LICENSES,
    "op11_suffix_dedup": SUFFIXES,
    "op12_spelling_variants": SPELLING,
    "op13_lexical_search": LEXICAL,
}
