"""DuckDB SQL for the queries that SQL can express.

Operators 2, 3, 4, 6 and 8 rest on a tokenizer file, a learned model or sampled
signatures; they are tested against the libraries, held-out labels and
brute-force versions instead. Operator 10 could be put in SQL, but a row a byte
takes DuckDB 26 GB of memory at sf0.01, so it is tested against a brute-force
version too.
"""

from __future__ import annotations

from . import collocations, mixing
from .decontam import WINDOW
from .substring_dedup import CUT_WINDOW, LONG_WORDS, MIN_SENTENCES, MIN_WORDS
from .url_filter import CANONICAL, GOTO, HREF, LOWER, REFRESH, SPLIT, UPPER

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLANK = r"[ \t\n\v\f\r]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def low(col: str) -> str:
    return f"translate({col}, '{UPPER}', '{LOWER}')"


def op9() -> str:
    return f"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS i, regexp_extract_all({low("coalesce(text, '')")}, '{WORD}') AS w FROM benchmark
), phrases AS (
  SELECT DISTINCT i, array_to_string(w[s : least(s + {WINDOW - 1}, len(w))], ' ') AS phrase, least(len(w), {WINDOW}) AS n
  FROM items, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS r(s) WHERE len(w) > 0
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low("coalesce(text, '')")}, '{WORD}') AS w FROM documents
), hits AS (
  SELECT d.r, d.s, p.i, p.n
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM docs) d, (SELECT DISTINCT n FROM phrases) l, phrases p
  WHERE d.s + l.n - 1 <= len(d.w) AND p.n = l.n AND p.phrase = array_to_string(d.w[d.s : d.s + l.n - 1], ' ')
), n_hit AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS at FROM hits) GROUP BY r
), n_items AS (
  SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT r, i FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN n_hit h USING (r) LEFT JOIN n_items t USING (r)
"""


def op11() -> str:
    weights = ", ".join(str(w) for w in mixing.WEIGHTS)
    quality = " ".join(f"WHEN {v} THEN {w}" for v, w in mixing.QUALITY.items())
    most = mixing.MAX_EPOCHS
    return f"""
WITH quality AS (
  SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), docs AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '{mixing.WORD}')), 0)::BIGINT AS size, d.text,
         -ln((('0x' || substr(md5('{mixing.SEED}' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / {1 << 52}.0)
           / coalesce(CASE q.q {quality} ELSE 1.0 END, 1.0)::DOUBLE AS late
  FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id
), sources AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         [{weights}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1]::HUGEINT AS weight
  FROM docs GROUP BY source
), ratios AS (  -- the limits are reached in the order of size a unit of weight
  SELECT *, {most} * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum({most} * source_size) OVER w, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS rest
  FROM sources
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), reached AS (
  SELECT *, (total - capped) * weight >= cap * rest AS full_up FROM ratios
), shares AS (
  SELECT max(total) - coalesce(sum(cap) FILTER (full_up), 0) AS words, sum(weight) FILTER (NOT full_up) AS units FROM reached
), targets AS (
  SELECT source, source_size::BIGINT AS source_size,
         CASE WHEN full_up THEN cap::DOUBLE ELSE (weight * words)::DOUBLE / units::DOUBLE END AS target
  FROM reached, shares
), placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.late, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, (epochs + (target - epochs * source_size > 0 AND 2 * before + size <= 2 * (target - epochs * source_size))::INT)::BIGINT AS copies
  FROM placed
)
SELECT doc_id, source, size, source_size, target, copies, (size * copies)::BIGINT AS taken FROM taken
"""


def op12() -> str:
    c = collocations
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{c.UND}') AS lang, unnest(string_split_regex({low("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), occurrences AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda s: array_to_string(w[s : s + m - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3]) AS m)
), f AS (
  SELECT lang, m, phrase, count(*)::HUGEINT AS a, string_split(phrase, ' ') AS w FROM occurrences GROUP BY ALL
), n AS (
  SELECT lang, sum(a) AS n FROM f WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM f WHERE m > 1 AND a >= {c.MIN_COUNT}
), cuts AS (
  SELECT c.lang, c.phrase, c.m, c.a, k, l.a AS l, r.a AS r, (1000000 * c.a * c.a) // (l.a * r.a) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[: c.k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1 :], ' ')
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[s : s + 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (SELECT unnest([1, 2]) AS s) WHERE m = 3 GROUP BY ALL
), ranked AS (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, score
  FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE longer IS NULL OR 100 * longer < {c.SHARE} * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {c.TOP}
"""


def op7(rules: list[tuple[str, str, str]]) -> str:
    values = ", ".join(f"({q(v)}, {q(h)}, {q(p)})" for v, h, p in rules)

    def host(u: str) -> str:
        return low(f"coalesce(regexp_extract({u}, {q(SPLIT)}, 1), '')")

    def path(u: str) -> str:
        return f"coalesce(regexp_extract({u}, {q(SPLIT)}, 2), '')"

    def address(u: str) -> str:
        return f"CASE WHEN {host(u)} <> '' THEN {host(u)} || {path(u)} || regexp_extract({u}, {q(SPLIT)}, 3) END"

    return f"""
WITH RECURSIVE rules(verdict, rh, rp) AS (VALUES {values}),
targets AS (
  SELECT url, regexp_extract(regexp_extract(html, {q(CANONICAL)}), {q(HREF)}, 1) AS t FROM pages
  UNION ALL SELECT url, regexp_extract(regexp_extract(html, {q(REFRESH)}), {q(GOTO)}, 1) FROM pages
), links AS (
  SELECT url, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN 'x:' || t
                   WHEN starts_with(t, '/') THEN 'x://' || {host("url")} || t END AS to_url FROM targets
), edges AS (
  SELECT DISTINCT {address("url")} AS a, {address("to_url")} AS b, to_url FROM links
), real AS (SELECT * FROM edges WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b),
sym AS (SELECT a, b FROM real UNION SELECT b, a FROM real),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT r.a, s.b FROM reach r JOIN sym s ON r.b = s.a),
classes AS (SELECT a AS id, least(a, min(b)) AS component FROM reach GROUP BY a),
own AS (SELECT page_id, {host("url")} AS host, {path("url")} AS path, {address("url")} AS address FROM pages),
known AS (SELECT DISTINCT host, path, address FROM own
          UNION SELECT {host("to_url")}, {path("to_url")}, b FROM real),
ruled AS (
  SELECT host, path, arg_max(rh || rp, [length(rh || rp), (verdict = 'allow')::INT]) AS rule,
         arg_max(verdict, [length(rh || rp), (verdict = 'allow')::INT]) AS verdict
  FROM (SELECT DISTINCT host, path FROM known), rules
  WHERE host <> '' AND (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path
), decided AS (
  SELECT component, bool_or(coalesce(verdict = 'allow', false)) AS allowed, bool_or(coalesce(verdict = 'block', false)) AS blocked,
         count(DISTINCT id) - 1 AS aliases
  FROM classes JOIN known ON address = id LEFT JOIN ruled USING (host, path) GROUP BY component
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN NOT allowed AND blocked THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(aliases, 0) AS aliases
FROM own LEFT JOIN ruled USING (host, path) LEFT JOIN classes ON id = address LEFT JOIN decided USING (component)
"""


OP5 = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS x FROM embeddings
), fit AS (
  SELECT r, vec_id, x FROM v
  WHERE x IS NOT NULL AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(x, lambda y: y <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM fit a, fit b
  WHERE a.r <> b.r AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT t.a, l.b FROM reach t JOIN links l ON t.b = l.a),
least_id AS (SELECT a AS r, min(v.vec_id) AS c FROM reach JOIN v ON v.r = reach.b GROUP BY a),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(least(c, vec_id), vec_id) AS component_id,
       vec_id IS NOT DISTINCT FROM coalesce(least(c, vec_id), vec_id) AS kept
FROM v LEFT JOIN n USING (r) LEFT JOIN least_id USING (r)
"""

OP1 = f"""
WITH docs AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS r, doc_id, text FROM documents
), pieces AS (
  SELECT r, pos, p[pos] AS piece, len(regexp_extract_all({low("p[pos]")}, '{WORD}')) AS n,
         array_to_string(regexp_extract_all({low("p[pos]")}, '{WORD}'), ' ') AS content
  FROM (SELECT r, string_split(regexp_replace(text, '([.!?]{BLANK}+|\\n{BLANK}*|[。！？])', '\\1' || chr(1) || chr(2), 'g'),
                               chr(1) || chr(2)) AS p
        FROM docs WHERE text IS NOT NULL), unnest(range(1, len(p) + 1)) AS u(pos)
), numbered AS (
  SELECT *, greatest(1, sum((n > 0)::INT) OVER (PARTITION BY r ORDER BY pos))::BIGINT AS s FROM pieces
), whole AS (
  SELECT r, s, string_agg(piece, '' ORDER BY pos) AS body, sum(n) AS n FROM numbered GROUP BY r, s HAVING sum(n) > 0
), tokens AS (  -- each word with what follows it; the first also with what stands before
  SELECT r, s, n, t[1] AS lead, t[2:] AS t
  FROM (SELECT r, s, n, string_split(regexp_replace(body, '({ANY_WORD})', chr(1) || '\\1', 'g'), chr(1)) AS t FROM whole)
), heads AS (
  SELECT *, list_transform(t, lambda x: left(hex(encode(regexp_extract({low("x")}, '^{WORD}'))), 16)) AS h FROM tokens
), cuts AS (
  SELECT r, s, 1 AS c FROM tokens
  UNION
  SELECT r, s, i + {CUT_WINDOW} - list_position(list_reverse(h[i : i + {CUT_WINDOW - 1}]), list_min(h[i : i + {CUT_WINDOW - 1}])) AS c
  FROM heads, unnest(range(1, len(t) - {CUT_WINDOW - 2})) AS u(i) WHERE n > {LONG_WORDS}
), parts AS (
  SELECT r, s, c, coalesce(lead(c) OVER (PARTITION BY r, s ORDER BY c), n + 1) AS e, lead, t
  FROM cuts JOIN tokens USING (r, s)
), sentences AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY s, c) AS s, (e - c)::BIGINT AS n,
         CASE WHEN c = 1 THEN lead ELSE '' END || array_to_string(t[c : e - 1], '') AS body,
         array_to_string(list_transform(t[c : e - 1], lambda x: regexp_extract({low("x")}, '^{WORD}')), ' ') AS content
  FROM parts
), lists AS (
  SELECT r, list(n ORDER BY s) AS ns, list(content ORDER BY s) AS cs, count(*) AS m FROM sentences GROUP BY r
), forward AS (
  SELECT r, i AS a, min(e) AS b FROM lists, unnest(range(1, m + 1)) AS x(i), unnest(range(i + {MIN_SENTENCES} - 1, least(m, i + 40) + 1)) AS y(e)
  WHERE list_sum(ns[i : e]) >= {MIN_WORDS} GROUP BY r, i
), backward AS (
  SELECT r, max(i) AS a, e AS b FROM lists, unnest(range(1, m + 1)) AS y(e), unnest(range(greatest(1, e - 40), e - {MIN_SENTENCES} + 2)) AS x(i)
  WHERE list_sum(ns[i : e]) >= {MIN_WORDS} GROUP BY r, e
), runs AS (
  SELECT r, a, b, cs[a : b] AS content
  FROM (SELECT * FROM forward UNION SELECT * FROM backward UNION SELECT r, s, s FROM sentences WHERE n >= {LONG_WORDS}) JOIN lists USING (r)
), repeats AS (
  SELECT r, a, b FROM runs QUALIFY row_number() OVER (PARTITION BY content ORDER BY r, a) > 1
), gone AS (SELECT DISTINCT r, unnest(range(a, b + 1)) AS s FROM repeats),
per AS (
  SELECT r, count(*) AS n_sentences, count(g.s) AS n_removed,
         coalesce(string_agg(CASE WHEN g.s IS NULL THEN body END, '' ORDER BY t.s), '') AS body
  FROM sentences t LEFT JOIN gone g USING (r, s) GROUP BY r
)
SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN n_sentences IS NULL THEN text ELSE body END AS text
FROM docs LEFT JOIN per USING (r)
"""
