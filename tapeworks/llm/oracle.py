"""DuckDB SQL for the queries that SQL can express, over whole tables. Words and rules as in the operators."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

# Rates and the prior as in ``quality_rules``; a document is its row, since ids may repeat.
_RULES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")
_PRIORS = ", ".join(f"""
    sum(fail_{r} / host_docs * host_docs) / sum(host_docs) AS mean_{r},
    sum((fail_{r} / host_docs) * (fail_{r} / host_docs) * host_docs) / sum(host_docs)
      - (sum(fail_{r} / host_docs * host_docs) / sum(host_docs)) ** 2 AS var_{r}""" for r in _RULES)
_WEIGHTS = ", ".join(
    f"least(greatest(CASE WHEN var_{r} > 1e-12 THEN mean_{r} * (1 - mean_{r}) / var_{r} - 1 ELSE usual END, 1.0),"
    f" usual + 1) AS weight_{r}, least(greatest(mean_{r}, 0.0), 1.0) AS m_{r}" for r in _RULES)
_WORST = ", ".join(f"(fail_{r} + m_{r} * weight_{r}) / (host_docs + weight_{r})" for r in _RULES)

QUALITY_RULES = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT r, doc_id, host, t, regexp_extract_all(t, '{WORD}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM texts),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
windows AS (
  SELECT r, i, concat_ws(' ', word, lead(word, 1) OVER s, lead(word, 2) OVER s, lead(word, 3) OVER s,
                         lead(word, 4) OVER s) AS five, lead(word, 4) OVER s AS fifth
  FROM words WINDOW s AS (PARTITION BY r ORDER BY i)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS c FROM windows WHERE fifth IS NOT NULL)
  WHERE c > 1),
covered AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS place FROM again, range(5) AS five(k)) GROUP BY r),
counted AS (
  SELECT r, doc_id, host, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)),
failing AS (
  SELECT host, count(*)::DOUBLE AS host_docs,
    count_if(n_words < 10)::DOUBLE AS fail_few_words,
    count_if(n_repeat_words > 0.2::DOUBLE * n_words)::DOUBLE AS fail_repeats,
    count_if(n_symbols > 0.1::DOUBLE * n_words)::DOUBLE AS fail_symbols,
    count_if(n_dup_lines * 10 > n_words)::DOUBLE AS fail_dup_lines,
    count_if(n_words > 0 AND NOT word_chars::DOUBLE / n_words BETWEEN 2 AND 15)::DOUBLE AS fail_word_length
  FROM counted GROUP BY host),
moments AS (SELECT sum(host_docs) / count(*) AS usual, {_PRIORS} FROM failing),
priors AS (SELECT {_WEIGHTS} FROM moments),
hosts AS (SELECT host, host_docs, greatest({_WORST}, 0.0) AS host_rate FROM failing, priors)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND host_rate <= 0.5 AS kept,
       counted.host, host_docs::BIGINT AS host_docs, round(host_rate, 9) AS host_rate
FROM counted JOIN hosts ON counted.host IS NOT DISTINCT FROM hosts.host
"""

# All pairs of texts that share an n-gram are compared, without bands.
NGRAM_JOIN = rf"""
WITH RECURSIVE classes AS (
  SELECT row_number() OVER (ORDER BY min(doc_id), text) AS c, text, min(doc_id) AS first, count(*) AS n_copies
  FROM documents WHERE text IS NOT NULL GROUP BY text),
words AS (SELECT c, regexp_extract_all(text, '{WORD}') AS w FROM classes),
grams AS (
  SELECT DISTINCT c, w[i:i + 4] AS gram
  FROM (SELECT c, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT c, count(*) AS n FROM grams GROUP BY c),
shared AS (
  SELECT x.c AS a, y.c AS b, count(*) AS n FROM grams x JOIN grams y ON x.gram = y.gram AND x.c <> y.c
  GROUP BY x.c, y.c),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.c = a JOIN sizes q ON q.c = b
  WHERE 10 * shared.n >= 8 * (p.n + q.n - shared.n)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
groups AS (SELECT a AS c, least(min(classes.first), min(own.first)) AS group_id
           FROM reach JOIN classes ON classes.c = reach.b JOIN classes own ON own.c = reach.a GROUP BY a),
counts AS (SELECT a AS c, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(first, doc_id) AS class_id, coalesce(n_copies, 1) AS n_copies,
       coalesce(n_links, 0) AS n_links, coalesce(group_id, first, doc_id) AS group_id
FROM documents LEFT JOIN classes ON documents.text = classes.text
LEFT JOIN groups ON groups.c = classes.c LEFT JOIN counts ON counts.c = classes.c
"""

# Whole windows of lines are compared, without fingerprints.
LINE_DEDUP = rf"""
WITH keyed AS (
  SELECT md5(concat_ws(chr(31), coalesce(doc_id::VARCHAR, chr(30)), text)) AS doc, doc_id, text,
         string_split(text, chr(10)) AS lines FROM documents),
raw AS (
  SELECT doc, any_value(doc_id) AS doc_id, any_value(lines) AS lines FROM keyed WHERE text IS NOT NULL GROUP BY doc),
counted AS (
  SELECT doc, doc_id, line - 1 AS line, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS h,
         len(regexp_extract_all(raw, '{WORD}')) AS n
  FROM (SELECT doc, doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) AS line FROM raw)),
lines AS (
  SELECT *, row_number() OVER s AS place, sum(n) OVER s - n AS start, sum(n) OVER (PARTITION BY doc) AS total
  FROM counted WHERE n > 0 WINDOW s AS (PARTITION BY doc ORDER BY line)),
windows AS (
  SELECT doc, doc_id, place, total - start AS remaining, string_agg(h, chr(10)) OVER (
    PARTITION BY doc ORDER BY start RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING) AS run
  FROM lines),
placed AS (
  SELECT doc, place, first_value(doc) OVER s AS doc0, first_value(place) OVER s AS place0
  FROM windows WHERE remaining >= 50
  WINDOW s AS (PARTITION BY run ORDER BY doc_id IS NULL, doc_id, doc, place)),
pairs AS (SELECT DISTINCT doc, doc0, place - place0 AS shift FROM placed WHERE doc <> doc0 OR place <> place0),
same AS (
  SELECT p.doc, p.doc0, p.shift, x.line, x.n,
         x.place - row_number() OVER (PARTITION BY p.doc, p.doc0, p.shift ORDER BY x.place) AS run
  FROM pairs p JOIN lines x ON x.doc = p.doc JOIN lines y ON y.doc = p.doc0 AND y.place = x.place - p.shift AND y.h = x.h),
gone AS (
  SELECT doc, list(DISTINCT line) AS gone
  FROM (SELECT doc, line, sum(n) OVER (PARTITION BY doc, doc0, shift, run) AS words FROM same)
  WHERE words >= 50 GROUP BY doc)
SELECT doc_id, coalesce(len(lines), 0)::INTEGER AS n_lines, coalesce(len(gone), 0)::INTEGER AS n_removed,
       CASE WHEN gone IS NULL THEN text
            ELSE coalesce(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)), '')
       END AS text
FROM keyed LEFT JOIN gone USING (doc)
"""

_FIELDS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in (
    "doc_id", "source", "lang", "{n_chars}", "text"))
# The CRC of a text of digits, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(d) + 1), lambda i: ascii(d[i])::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                           lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""

# Whole levels are built at once, and each leaf is folded step by step.
MERKLE = f"""
WITH RECURSIVE drawn AS (
  SELECT row_number() OVER () AS r, *, doc_id::VARCHAR AS d FROM documents),
hashed AS (
  SELECT r, doc_id, coalesce('=' || lang, '') AS tree, sha256({_FIELDS.replace("{n_chars}", "n_chars")}) AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN sha256({_FIELDS.replace("{n_chars}", "(n_chars + 1)")})
              ELSE sha256({_FIELDS.replace("{n_chars}", "n_chars")}) END AS claim
  FROM drawn),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j,
         count(*) OVER (PARTITION BY tree) AS c FROM hashed),
nodes AS (
  SELECT tree, 0 AS h, j, c, leaf AS node FROM placed
  UNION ALL
  SELECT tree, h + 1, j // 2, (c + 1) // 2, sha256(string_agg(node, '' ORDER BY j)) FROM nodes
  WHERE c > 1 GROUP BY tree, h, c, j // 2),
subroots AS (
  SELECT tree, node AS subroot, h AS tall, row_number() OVER (ORDER BY tree) - 1 AS k, count(*) OVER () AS c
  FROM nodes WHERE c = 1),
crown AS (
  SELECT 0 AS h, k, c, subroot AS node FROM subroots
  UNION ALL
  SELECT h + 1, k // 2, (c + 1) // 2, sha256(string_agg(node, '' ORDER BY k)) FROM crown
  WHERE c > 1 GROUP BY h, c, k // 2),
path AS (
  SELECT p.r, s.h AS step, o.node AS other, o.j < s.j AS before
  FROM placed p JOIN nodes s ON s.tree = p.tree AND s.j = p.j >> s.h AND s.c > 1
  LEFT JOIN nodes o ON o.tree = s.tree AND o.h = s.h AND o.j = xor(s.j, 1)
  UNION ALL
  SELECT p.r, t.tall + s.h, o.node, o.k < s.k
  FROM placed p JOIN subroots t ON t.tree = p.tree JOIN crown s ON s.k = t.k >> s.h AND s.c > 1
  LEFT JOIN crown o ON o.h = s.h AND o.k = xor(s.k, 1)),
folded AS (
  SELECT r, 0 AS step, claim AS node FROM placed
  UNION ALL
  SELECT f.r, f.step + 1, sha256(CASE WHEN p.other IS NULL THEN f.node WHEN p.before THEN p.other || f.node
                                      ELSE f.node || p.other END)
  FROM folded f JOIN path p ON p.r = f.r AND p.step = f.step),
proofs AS (SELECT r, string_agg(other, '' ORDER BY step) AS others FROM path GROUP BY r)
SELECT doc_id, leaf, subroot, root.node AS root, sha256(coalesce(others, '')) AS proof_sha256,
       ends.node AS folded_root, ends.node = root.node AS verified
FROM placed JOIN subroots USING (tree) LEFT JOIN proofs USING (r)
JOIN (SELECT r, arg_max(node, step) AS node FROM folded GROUP BY r) ends USING (r)
JOIN (SELECT node FROM crown WHERE c = 1) root ON true
"""

WARC = """
WITH paged AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
placed AS (
  SELECT *, row_number() OVER s AS place, first_value(page_id) OVER s AS first
  FROM paged WINDOW s AS (PARTITION BY payload ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first END AS refers_to
FROM placed
"""

# A stretch of 3q equal pairs q words apart holds three multiples of q in a row; where three such pairs are
# equal, all pairs at that distance are compared.
PERIODIC = rf"""
WITH drawn AS (
  SELECT row_number() OVER () AS r, doc_id, doc_id::VARCHAR AS d,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
hashed AS (SELECT r, doc_id, w, len(w) AS n, {_CRC} AS h FROM drawn),
planned AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS parts FROM hashed),
words AS (
  SELECT r, i, w[CASE WHEN i < a OR a IS NULL THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM planned)),
lattice AS (
  SELECT r, q, unnest(range(n // q)) AS k FROM (SELECT r, n, unnest(range(1, n // 4 + 1)) AS q FROM planned)),
anchors AS (
  SELECT q, l.r, k FROM lattice l JOIN words x ON x.r = l.r AND x.i = k * q JOIN words y ON y.r = l.r AND y.i = k * q + q
  WHERE x.word = y.word),
periods AS (
  SELECT DISTINCT a.r, a.q FROM anchors a JOIN anchors b ON b.r = a.r AND b.q = a.q AND b.k = a.k + 1
  JOIN anchors c ON c.r = a.r AND c.q = a.q AND c.k = a.k + 2),
same AS (
  SELECT p.r, q, x.i, x.i - row_number() OVER (PARTITION BY p.r, q ORDER BY x.i) AS part
  FROM periods p JOIN words x ON x.r = p.r JOIN words y ON y.r = x.r AND y.i = x.i + q AND y.word = x.word),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY r, q, part
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
told AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         arg_max({{'start': start, 'length': length, 'period': period}}, [length, -start, -period]) AS best
  FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.r, string_agg(word, ' ' ORDER BY w.i) AS collapsed
  FROM words w LEFT JOIN dropped x ON x.r = w.r AND x.i = w.i WHERE x.i IS NULL GROUP BY w.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
       best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM planned LEFT JOIN told USING (r) LEFT JOIN kept USING (r)
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": QUALITY_RULES,
    "op9_ngram_join": NGRAM_JOIN,
    "op10_line_dedup": LINE_DEDUP,
    "op11_merkle_manifest": MERKLE,
    "op12_warc": WARC,
    "op13_periodic_runs": PERIODIC,
}
