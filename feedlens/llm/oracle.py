"""DuckDB SQL of the queries that SQL can express over whole tables.

Not here, and tested against brute force instead: op1 (template automata),
op2 and op12 (learned models), op5 (a tokenizer), op7 and op11 (no CRC-32 in
that SQL), op10 (no positions of matches in that SQL), and the pipeline, which ends in op5.
"""

from __future__ import annotations

from . import warc
from .decontaminate import SPAN
from .urlfilter import LOWER, REPEATS, RULES, UPPER

_WORDS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN text IS NULL THEN [] ELSE {_WORDS} END AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
),
places AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
found AS (SELECT p.r, p.n, p.i, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.g = x.g),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS at FROM found) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
),
g AS (SELECT row_number() OVER () AS p, g FROM (SELECT DISTINCT g FROM windows)),
terms AS (SELECT p, term, count(*) OVER (PARTITION BY p) AS m FROM (SELECT DISTINCT p, unnest(string_split(g, ' ')) AS term FROM g)),
tokens AS (SELECT r, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS i FROM d),
whole AS (
  SELECT r, p FROM (SELECT DISTINCT r, term FROM tokens) JOIN terms USING (term) GROUP BY r, p HAVING count(*) = any_value(m)
),
term_places AS (SELECT whole.r, whole.p, term, m, i FROM whole JOIN terms USING (p) JOIN tokens USING (r, term)),
-- From every place of a term, the first place of each term of the phrase within the span.
nexts AS (
  SELECT a.r, a.p, a.m, a.i, b.term, min(b.i) AS e FROM term_places a JOIN term_places b ON a.r = b.r AND a.p = b.p AND b.i BETWEEN a.i AND a.i + {SPAN}
  GROUP BY a.r, a.p, a.m, a.i, b.term
),
stretches AS (SELECT r, p, i, max(e) AS e FROM nexts GROUP BY r, p, m, i HAVING count(*) = m),
near AS (SELECT r, p, max(i) AS i, e FROM stretches GROUP BY r, p, e),
near_words AS (SELECT r, count(*) AS n_near_words FROM (SELECT DISTINCT r, unnest(range(i, e + 1)) AS at FROM near) GROUP BY r),
near_items AS (
  SELECT r, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near
  FROM (
    SELECT DISTINCT n.r, CAST(x.item_id AS VARCHAR) AS item
    FROM (SELECT DISTINCT r, p FROM near) n JOIN g USING (p) JOIN windows x USING (g) WHERE x.item_id IS NOT NULL
  ) GROUP BY r
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near_words, 0) AS BIGINT) AS n_near_words, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, sha256(coalesce(near, '')) AS near_sha256
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r) LEFT JOIN near_words USING (r) LEFT JOIN near_items USING (r)
"""

OP6 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum([coalesce(p[1], 0) * coalesce(p[2], 0) FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""

OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') END AS w
  FROM documents
),
g AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 2], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS i FROM d WHERE len(w) > 0)
),
s AS (SELECT d.r, any_value(d.doc_id) AS doc_id, count(g.g) AS n FROM d LEFT JOIN g USING (r) GROUP BY d.r),
e AS (SELECT g.r, g.g, s.n FROM g JOIN s USING (r)),
links AS (
  SELECT a.r AS x, b.r AS y FROM e a JOIN e b ON a.g = b.g AND a.r <> b.r AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
degree AS (SELECT x, count(*) AS n_links FROM links GROUP BY x),
reach AS (SELECT r AS x, r AS y FROM s UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT any_value(s.doc_id) AS doc_id, CAST(any_value(s.n) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id,
  CAST(coalesce(any_value(degree.n_links), 0) AS BIGINT) AS n_links
FROM s JOIN reach ON s.r = reach.x JOIN s t ON t.r = reach.y LEFT JOIN degree ON degree.x = s.r GROUP BY s.r
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
OP9 = f"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
fits AS (
  SELECT p.r, max_by(x.host || x.path, length(x.host || x.path)) AS rule, max_by(x.verdict, length(x.host || x.path)) AS verdict
  FROM p JOIN (VALUES {_RULES}) x(host, path, verdict) ON (p.host = x.host OR ends_with(p.host, '.' || x.host)) AND starts_with(p.path, x.path)
  GROUP BY p.r
),
repeated AS (SELECT host, path FROM p WHERE host <> '' GROUP BY host, path HAVING count(*) >= {REPEATS})
SELECT p.page_id, p.host, p.path, fits.rule,
  coalesce(fits.verdict, CASE WHEN repeated.host IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN fits USING (r) LEFT JOIN repeated ON p.host = repeated.host AND p.path = repeated.path
"""


OP13 = rf"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
places AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS g
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) x(m) WHERE len(w) >= m)
),
f AS (SELECT lang, m, g, count(*) AS f FROM places GROUP BY lang, m, g HAVING count(*) >= 30),
c AS (SELECT lang, m, g, f, string_split(g, ' ') AS w FROM f WHERE m > 1),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, c.k, l.f AS l, r.f AS r, CAST((CAST(c.f AS HUGEINT) * 2000000) // (l.f + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.m = c.k AND l.g = array_to_string(c.w[1 : c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.m = c.m - c.k AND r.g = array_to_string(c.w[c.k + 1 : c.m], ' ')
),
weakest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
inner_phrases AS (
  SELECT lang, f, array_to_string(w[i : i + s - 1], ' ') AS g
  FROM (SELECT lang, f, w, s, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c))
),
dropped AS (SELECT DISTINCT c.lang, c.g FROM c JOIN inner_phrases x ON x.lang = c.lang AND x.g = c.g WHERE 100 * x.f >= 80 * c.f),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.g) AS rank
  FROM weakest w ANTI JOIN dropped d ON d.lang = w.lang AND d.g = w.g
),
ends AS (
  SELECT lang, g, sum(is_left) AS n_left, sum(1 - is_left) AS n_right
  FROM (SELECT lang, array_to_string(w[2 : m], ' ') AS g, 1 AS is_left FROM c UNION ALL SELECT lang, array_to_string(w[1 : m - 1], ' ') AS g, 0 AS is_left FROM c)
  GROUP BY lang, g
)
SELECT r.lang, CAST(r.rank AS BIGINT) AS rank, r.g AS phrase, CAST(r.a AS BIGINT) AS a, CAST(r.l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r, n.n, r.score,
  CAST(coalesce(e.n_left, 0) AS BIGINT) AS n_left, CAST(coalesce(e.n_right, 0) AS BIGINT) AS n_right
FROM ranked r JOIN n ON n.lang = r.lang LEFT JOIN ends e ON e.lang = r.lang AND e.g = r.g WHERE r.rank <= 2000
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replaced(text: str, rules) -> str:
    for pattern, put in rules:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(put)}, 'g')"
    return text


def _resolved(text: str) -> str:
    """``text`` with its character references resolved."""
    named = "MAP {" + ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in warc.NAMED.items()) + "}"
    numbered = "MAP {" + ", ".join(f"{k}: {_quoted(v)}" for k, v in warc.NUMBERED.items()) + "}"

    def code(pattern: str, prefix: str) -> str:
        digits = f"regexp_extract(p, '{pattern}', 1)"
        return f"CASE WHEN {digits} = '' THEN NULL WHEN length({digits}) > {warc.MOST_DIGITS} THEN 0 ELSE CAST('{prefix}' || {digits} AS INTEGER) END"

    number = f"coalesce({code('^#0*([0-9]+);', '')}, {code('^#[xX]0*([0-9a-fA-F]+);', '0x')})"
    char = (
        f"CASE WHEN {number} = 0 OR {number} BETWEEN 55296 AND 57343 OR {number} > 1114111 THEN chr(65533)"
        f" ELSE coalesce({numbered}[{number}], chr({number})) END"
    )
    found = f"CASE WHEN p[1] = '#' THEN CASE WHEN {number} IS NOT NULL THEN {char} END ELSE {named}[regexp_extract(p, '^([a-zA-Z][a-zA-Z0-9]*);', 1)] END"
    pieces = f"string_split({text}, '&')"
    return f"({pieces}[1] || array_to_string([coalesce({found} || substring(p, strpos(p, ';') + 1), '&' || p) FOR p IN {pieces}[2:]], ''))"


def _op3() -> str:
    urn = "'<urn:uuid:' || {h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20] || '-' || {h}[21:32] || '>'"
    end = "chr(13) || chr(10)"
    gone = "'[' || chr(13) || chr(10) || ']'"
    return f"""
WITH source AS (
  SELECT page_id, url AS target_uri, coalesce(html, '') AS payload,
    md5('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '') || '|' || md5(coalesce(html, ''))) AS h
  FROM pages
),
base AS (
  SELECT page_id, target_uri, payload, {urn.format(h='h')} AS refers_to, 'sha256:' || sha256(payload) AS source_digest,
    {_replaced('payload', warc.MARKUP)} AS unmarked, regexp_extract(payload, {_quoted(warc.TITLE)}, 1) AS title
  FROM source
),
derived AS (
  SELECT page_id, target_uri, refers_to, source_digest, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type, trim({_replaced(_resolved('unmarked'), warc.BLANKS)}, ' ' || chr(10)) AS block FROM base
  UNION ALL
  SELECT page_id, target_uri, refers_to, source_digest, 'metadata', 'application/warc-fields',
    'title: ' || trim(regexp_replace({_resolved('title')}, '[ \\t\\r\\n\\f]+', ' ', 'g')) || {end} || 'language: '
    || regexp_replace(regexp_extract(payload, {_quoted(warc.LANGUAGE)}, 1), {gone}, '', 'g') || {end} || 'source-digest: ' || source_digest || {end}
    || coalesce(array_to_string(['outlink: ' || regexp_replace({_resolved('x')}, {gone}, '', 'g') || {end}
         FOR x IN regexp_extract_all(payload, {_quoted(warc.LINK)}, 1)], ''), '')
  FROM base
),
named AS (SELECT *, md5(warc_type || '|' || refers_to) AS h FROM derived)
SELECT page_id, warc_type, {urn.format(h='h')} AS record_id, refers_to, target_uri, '{warc.DATE}' AS date, content_type,
  '{warc.PAYLOAD_TYPE}' AS source_content_type, source_digest, 'sha256:' || sha256(block) AS block_digest, CAST(strlen(block) AS BIGINT) AS content_length, block
FROM named
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_derivatives": _op3(),
        "op4_decontamination": OP4,
        "op6_top_k": OP6,
        "op8_ngram_join": OP8,
        "op9_url_filter": OP9,
        "op13_phrase_collocations": OP13,
    }
