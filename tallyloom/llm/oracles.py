"""DuckDB SQL of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from tallyloom.llm.quality_rules import RULES, Risk

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"

LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line FROM docs),
full_lines AS (
  SELECT doc_id, pos, line, row_number() OVER w AS n, count(*) OVER (PARTITION BY doc_id) AS n_lines,
    lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3
  FROM lines WHERE regexp_matches(line, '{_WORD}') WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
windows AS (
  SELECT doc_id, n, least(n_lines, 3) AS width, CASE WHEN n_lines = 1 THEN line
    WHEN n_lines = 2 THEN line || chr(10) || line2 ELSE line || chr(10) || line2 || chr(10) || line3 END AS content
  FROM full_lines WHERE n = 1 OR n <= n_lines - 2),
later AS (
  SELECT doc_id, n, width FROM windows
  QUALIFY row_number() OVER (PARTITION BY width, content ORDER BY doc_id, n) > 1),
covered AS (SELECT DISTINCT doc_id, n + o AS n FROM later, range(0, 3) AS t(o) WHERE o < width),
marked AS (
  SELECT l.doc_id, l.pos, l.line, f.n IS NOT NULL AS full_line, c.n IS NOT NULL AS gone
  FROM lines l LEFT JOIN full_lines f ON f.doc_id = l.doc_id AND f.pos = l.pos
  LEFT JOIN covered c ON c.doc_id = f.doc_id AND c.n = f.n),
joined AS (
  SELECT doc_id, count(*) FILTER (full_line) AS n_lines, count(*) FILTER (gone) AS n_removed,
    string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS left_text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed,
  CASE WHEN coalesce(j.n_removed, 0) = 0 THEN d.text WHEN j.n_removed = j.n_lines THEN '' ELSE j.left_text END AS text
FROM docs d LEFT JOIN joined j ON j.doc_id = d.doc_id
"""


def _rules_sql() -> str:
    share = Risk().max_false_rejection / len(RULES)
    grid = ", ".join(f"('{r}', {c})" for r, (_, _, cuts) in RULES.items() for c in cuts)
    tests = sum(len(cuts) for _, _, cuts in RULES.values())
    over = " UNION ALL ".join(
        f"SELECT doc_id, lang, text, '{r}' AS rule, {n} AS num, {d} AS den FROM measures WHERE NOT base_failed"
        for r, (n, d, _) in RULES.items())
    return f"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '{_WORD}')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM docs)),
repeated AS (
  SELECT doc_id, count(DISTINCT i + o) AS n
  FROM (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, content) > 1), range(0, 8) AS t(o)
  GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, lang, text, len(words) AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN repeated r ON r.doc_id = d.doc_id),
measures AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
ratios AS ({over}),
judged AS (SELECT doc_id, min(quality) AS label FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
texts AS (
  SELECT lang, text, rule, any_value(num) AS num, any_value(den) AS den, min(label) AS good
  FROM ratios JOIN judged USING (doc_id) GROUP BY lang, text, rule),
tests AS (
  SELECT lang, rule, cutoff, count(*) FILTER (good = 1) AS n_good,
    count(*) FILTER (good = 1 AND 1000 * num > cutoff * den) AS lost,
    count(*) FILTER (good = 0 AND 1000 * num > cutoff * den) AS caught
  FROM texts JOIN (VALUES {grid}) AS g(rule, cutoff) USING (rule)
  GROUP BY lang, rule, cutoff),
tails AS (
  SELECT *, CASE WHEN lost > n_good * {share} THEN 1 ELSE list_sum(list_transform(range(0, lost + 1), lambda i:
      exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({share}) + (n_good - i) * ln(1 - {share})))) END AS tail
  FROM tests),
chosen AS (
  SELECT lang, rule, cutoff FROM tails
  WHERE tail * (SELECT count(DISTINCT lang) FROM tests) * {tests} <= {Risk().error} AND caught > lost
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY caught - lost DESC, cutoff DESC) = 1),
rejected AS (
  SELECT DISTINCT doc_id FROM ratios r JOIN chosen c ON c.lang = r.lang AND c.rule = r.rule WHERE 1000 * num > cutoff * den)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM measures
"""


WARC = """
WITH captures AS (
  SELECT page_id, lower(url) AS url, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS bytes,
    to_timestamp(coalesce(page_id, 0)) AS captured_at FROM pages),
firsts AS (SELECT digest, min(page_id) AS first_id FROM captures WHERE bytes >= 100 GROUP BY digest),
keyed AS (
  SELECT *, regexp_replace(url, '^[a-z][a-z0-9+.-]*://', '') AS rest FROM captures)
SELECT page_id, bytes AS payload_bytes, k.digest AS payload_digest,
  CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
  row_number() OVER (ORDER BY array_to_string(list_reverse(string_split(regexp_extract(rest, '^([^/?#:]*)', 1), '.')), ',')
    || ')' || regexp_replace(rest, '^[^/?#]*', ''), captured_at, page_id) - 1 AS position
FROM keyed k LEFT JOIN firsts f ON f.digest = k.digest
"""

TOPK = """
WITH whole AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scores AS (
  SELECT a.rid AS query, a.vec_id AS query_id, b.rid, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id, rid) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5
"""

_RATE = 1 << 40


MIXING = f"""
WITH docs AS (
  SELECT doc_id, source, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
    CAST(len(list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '')) AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM docs GROUP BY source),
filling AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER w AS place,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS among
  FROM sources WINDOW w AS (ORDER BY 3 * source_size * (10 // weight), source NULLS LAST)),
border AS (
  SELECT place AS first_open, rest, among FROM filling WHERE 10 * rest <= cap * (10 // weight) * among ORDER BY place LIMIT 1),
targets AS (
  SELECT f.source, f.source_size, CASE WHEN place < first_open THEN CAST(cap AS DOUBLE) ELSE CAST(weight AS DOUBLE) * CAST(b.rest AS DOUBLE) / CAST(b.among AS DOUBLE) END AS target,
    CASE WHEN place < first_open THEN 3 * {_RATE}::HUGEINT WHEN f.source_size = 0 THEN 0::HUGEINT
      ELSE (weight::HUGEINT * b.rest::HUGEINT * {_RATE}::HUGEINT) // (f.source_size::HUGEINT * b.among::HUGEINT) END AS rate,
    ('0x' || substr(md5('mix|' || coalesce(f.source, '')), 1, 10))::BIGINT::HUGEINT AS drawn
  FROM filling f, border b),
halves AS (SELECT *, substr(hash, 1, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f') AS falling FROM docs),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY falling, CASE WHEN falling THEN -size ELSE size END, hash, doc_id NULLS LAST) - 1)::HUGEINT AS rank
  FROM halves)
SELECT doc_id, size, source_size, target,
  CAST(((rank + 1) * rate + drawn) // {_RATE}::HUGEINT - (rank * rate + drawn) // {_RATE}::HUGEINT AS BIGINT) AS copies, copies * size AS taken
FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
"""

COLLOCATIONS = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
one AS (SELECT lang, unnest(w) AS a FROM words),
f1 AS (SELECT lang, a, count(*) AS f FROM one GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
two AS (SELECT lang, w, unnest(range(1, len(w))) AS i FROM words),
f2 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM two GROUP BY ALL),
f3 AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f FROM two WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
pairs AS (
  SELECT p.*, x.f AS l, y.f AS r, (1000000::HUGEINT * p.f * p.f) // (x.f::HUGEINT * y.f) AS score FROM f2 p
  JOIN f1 x ON x.lang = p.lang AND x.a = p.a JOIN f1 y ON y.lang = p.lang AND y.a = p.b WHERE p.f >= 10),
covering AS (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3),
longest AS (SELECT lang, a, b, max(f) AS f FROM covering GROUP BY ALL),
triples AS (
  SELECT t.*, x.f AS l1, bc.f AS r1, ab.f AS l2, z.f AS r2,
    (1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * bc.f) AS s1, (1000000::HUGEINT * t.f * t.f) // (ab.f::HUGEINT * z.f) AS s2
  FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.a = t.a JOIN f1 z ON z.lang = t.lang AND z.a = t.c
  JOIN f2 ab ON ab.lang = t.lang AND ab.a = t.a AND ab.b = t.b JOIN f2 bc ON bc.lang = t.lang AND bc.a = t.b AND bc.b = t.c),
candidates AS (
  SELECT p.lang, p.a || ' ' || p.b AS phrase, p.f AS a, l, r, score FROM pairs p
  LEFT JOIN longest g ON g.lang = p.lang AND g.a = p.a AND g.b = p.b WHERE g.f IS NULL OR 100 * g.f < 50 * p.f
  UNION ALL
  SELECT lang, a || ' ' || b || ' ' || c, f, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END,
    least(s1, s2) FROM triples)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
  CAST(score AS BIGINT) AS score
FROM candidates JOIN totals USING (lang) QUALIFY rank <= 2000
"""

HARD_NEGATIVES = """
WITH whole AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scores AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, anchor_id, rid AS positive, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, positive ORDER BY score DESC, vec_id, rid) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": WARC, "op2_line_dedup": LINE_DEDUP, "op8_topk": TOPK, "op10_quality_rules": _rules_sql(),
        "op11_collocations": COLLOCATIONS, "op12_mixing": MIXING, "op13_hard_negatives": HARD_NEGATIVES,
    }
