"""SQL for the results of the queries that SQL can express."""

from __future__ import annotations

from tabledocs.llm.quality import BOILERPLATE, QualityOptions
from tabledocs.llm.secrets import RULES

_O = QualityOptions()
_WORDS = r"[w FOR w IN string_split_regex({x}, '[\x20\x09-\x0D]+') IF w <> '']"
_NOTICE = " OR ".join(f"contains(lower(line), '{x}')" for x in BOILERPLATE)


def _count(text: str, characters: str) -> str:
    quoted = characters.replace("'", "''")
    return f"(length({text}) - length(translate({text}, '{quoted}', '')))"


QUALITY = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {_WORDS.format(x='text')} AS words FROM d),
g AS (SELECT doc_id, unnest(range(len(words) - 2)) AS i, words FROM w WHERE len(words) > 2),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i + 1], words[i + 2], words[i + 3]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM h WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
v AS (SELECT doc_id, line, {_WORDS.format(x='line')} AS words FROM l),
j AS (SELECT doc_id, line, length(array_to_string(words, '')) AS chars,
   {_count('line', '|»›·•>')} * 100 > {_O.separator_percent} * len(words)
   OR {_count('line', '#*$%&|<>')} * 100 > {_O.symbol_percent} * len(words)
   OR {_count('line', '!¡')} * 100 > {_O.emphasis_percent} * len(words)
   OR len(words) < {_O.boilerplate_words} AND ({_NOTICE})
   OR len(words) >= {_O.unended_words} AND NOT contains('.!?…:;,"'')]}}»”’。！？', right(rtrim(line, ' '), 1))
   OR len(words) >= 10 AND (len(words) - len(list_distinct(words))) * 100 > {_O.line_repeat_percent} * len(words) AS fails
  FROM v WHERE len(words) > 0),
s AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE fails) AS lines_removed, coalesce(sum(chars) FILTER (WHERE fails), 0) AS chars_lost
  FROM j GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
   CAST({_count('text', '#*$%&|<>')} AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
   CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lines_removed, 0) AS BIGINT) AS lines_removed, CAST(coalesce(chars_lost, 0) AS BIGINT) AS chars_lost
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN s USING (doc_id)),
b AS (SELECT *, n_words < {_O.least_words} OR 100 * n_repeat_words > {_O.repeat_percent} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * chars_lost <= {_O.lost_percent} * word_chars AS kept FROM b"""


def _secrets() -> str:
    parts = []
    for k, rule in enumerate(RULES):
        pattern = rule.pattern.replace("'", "''")
        passes = f"length(regexp_extract(m, '{pattern}', {rule.group})) >= {rule.least}" if rule.least else "true"
        parts.append(
            f"""SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, i, m, {passes} AS passes,
  list_sum([length(x) FOR x IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0) AS a
FROM (SELECT doc_id, ms, gaps, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m FROM (
  SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gaps FROM documents))"""
        )
    return "WITH found AS (" + "\nUNION ALL\n".join(parts) + """),
good AS (SELECT doc_id, k, kind, CAST(a AS BIGINT) AS a, kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + length(m) AS BIGINT) AS span FROM found WHERE passes),
each_doc AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
  string_agg(span, ',' ORDER BY a, k) FILTER (WHERE k < 3) AS base, string_agg(span, ',' ORDER BY a, k) AS spans FROM good GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN each_doc e USING (doc_id)"""


SECRETS = _secrets()

# what a formatted conversation adds to its texts: marks, and one character for each that is escaped
CHAT = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)),
f AS (SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS begins,
  length(text) + length(text) - length(translate(text, '\<#', '')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN begins THEN 4 + length(role) + 2 + 8 ELSE 3 END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""

# every term of every pair of sources, those without an occurrence included
DIVERGENCE = r"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM v),
e AS (SELECT lang, term, sum(n) AS n FROM v GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM e),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS place FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM o WHERE part = 'pair' OR place <= 10"""

# all scores of all anchors; the inner products are whole numbers that a double holds
HARD_NEGATIVES = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.*, other AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS place
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 10"""
