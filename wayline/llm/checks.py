"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from wayline.llm.license_scan import BLOCK, NOTICES, PHRASES, STRIDE

ORACLES: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEMPLATES = ", ".join(
    [f"('{label}', string_split('{text}', ' '), 1.0, true)" for label, text in PHRASES]
    + [f"('{label}', string_split('{text}', ' '), 0.8, false)" for label, text in NOTICES]
)

ORACLES["op4_license_scan"] = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), templates(label, t, threshold, phrase) AS (VALUES {_TEMPLATES}),
blocks AS (
  SELECT doc_id, s, w[s + 1 : s + {BLOCK}] AS b
  FROM docs, LATERAL (SELECT unnest(range(0, greatest(len(w), 1), {STRIDE})) AS s)
), shared AS (
  SELECT doc_id, s, b, label, t, phrase, len(list_distinct(t)) AS size, len(list_intersect(t, b)) AS n_both, threshold
  FROM blocks, templates
  WHERE len(list_intersect(t, b)) >= ceil(threshold * len(list_distinct(t)) - 1e-9)
), placed AS (
  SELECT *, CASE WHEN phrase THEN list_filter(
      range(0, greatest(least({STRIDE}, len(b) - len(t) + 1), 0)), lambda i: b[i + 1 : i + len(t)] = t) END AS places
  FROM shared
), matched AS (
  SELECT doc_id, label, phrase, n_both / size AS containment, list_transform(places, lambda i: i + s) AS places
  FROM placed WHERE NOT phrase OR len(places) > 0
), folded AS (
  SELECT doc_id, sum(CASE WHEN phrase THEN len(places) ELSE 0 END) AS n_base,
    min(list_min(places)) AS first_word, max(list_max(places)) AS last_word, max(containment) AS score,
    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE phrase)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
  FROM matched GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN folded USING (doc_id)
"""

ORACLES["op6_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), rules(h, p, says) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(says, length(h || p)) AS says
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
), listed AS (
  SELECT DISTINCT host || path AS url FROM split
  WHERE list_has_any(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN url IS NULL THEN 'allow' ELSE 'block' END) AS verdict, url IS NOT NULL AS listed
FROM split LEFT JOIN best USING (page_id) LEFT JOIN listed ON listed.url = host || path
"""

ORACLES["op10_source_mixing"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS draw
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM docs GROUP BY source
), weighted AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][(k - 1) % 3 + 1] AS weight, 2.0 * source_size AS cap,
    1.5 * sum(source_size) OVER () AS total FROM sources
), filled(step, source, source_size, weight, cap, target, fixed, more) AS (
  SELECT 0, source, source_size, weight, cap, total * weight / sum(weight) OVER (), false, true FROM weighted
  UNION ALL
  SELECT step + 1, source, source_size, weight, cap,
    CASE WHEN full_now THEN cap ELSE target + excess * weight / NULLIF(sum(CASE WHEN full_now THEN 0 ELSE weight END) OVER (), 0) END,
    full_now, excess > 1e-9
  FROM (SELECT *, fixed OR target >= cap AS full_now,
      sum(CASE WHEN target > cap THEN target - cap ELSE 0 END) OVER () AS excess FROM filled WHERE more)
), targets AS (
  SELECT source, source_size, arg_max(least(coalesce(target, cap), cap), step) AS target FROM filled GROUP BY source, source_size
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target / source_size, 9)) AS BIGINT) ELSE 0 END AS whole FROM targets
), summed AS (
  SELECT source, draw, sum(size) AS n FROM docs GROUP BY source, draw
), running AS (
  SELECT source, draw, n, sum(n) OVER (PARTITION BY source ORDER BY draw) AS after,
    lead(draw) OVER (PARTITION BY source ORDER BY draw) IS NULL AS final FROM summed
), ends AS (
  SELECT p.source, min_by(draw, draw) AS end_draw, min_by((target - whole * source_size - (after - n)) * 2 >= n, draw) AS with_end
  FROM planned p JOIN running r ON p.source IS NOT DISTINCT FROM r.source
  WHERE target - whole * source_size > 1e-6 AND (after > target - whole * source_size OR final) GROUP BY p.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN end_draw IS NOT NULL AND (draw < end_draw OR (draw = end_draw AND with_end)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN ends e ON d.source IS NOT DISTINCT FROM e.source
"""

# DuckDB has no CRC-32: the sum is taken over the decimal digits, eight shifts to each.
_CRC32 = """xor(list_reduce([4294967295] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda r, d: list_reduce([xor(r, d), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""

ORACLES["op13_prefix_trie"] = rf"""
WITH turns AS (
  SELECT conv_id AS c, turn, length(coalesce(text, '')) AS size,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list(token ORDER BY turn NULLS FIRST, token) AS tokens, list(size ORDER BY turn NULLS FIRST, token) AS sizes FROM turns GROUP BY c
), cut AS (SELECT *, {_CRC32} % 6 AS h FROM own),
rebuilt AS (
  SELECT o.c, coalesce(b.tokens[1 : o.h], []) || o.tokens[o.h + 1 :] AS tokens, coalesce(b.sizes[1 : o.h], []) || o.sizes[o.h + 1 :] AS sizes
  FROM cut o LEFT JOIN own b ON b.c = o.c - o.c % 100
), steps AS (
  SELECT c, d, array_to_string(tokens[1 : d], ',') AS node, array_to_string(tokens[1 : d - 1], ',') AS up,
    CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(tokens) AS ends
  FROM rebuilt, LATERAL (SELECT unnest(range(0, len(tokens) + 1)) AS d)
), nodes AS (
  SELECT node, d, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY node, d
), children AS (SELECT up, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up, d),
joined AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.d = n.d AND k.up = n.node),
above AS (
  SELECT DISTINCT s.node, s.d, t.node AS top, t.d AS top_d FROM steps s JOIN steps t ON s.c = t.c AND t.d <= s.d
), summed AS (
  SELECT top, top_d, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM above JOIN joined USING (node, d) GROUP BY top, top_d
)
SELECT j.conv_id, j.d AS depth, p.conv_id AS parent_conv_id, j.n_convs, j.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, j.ends_sha256
FROM joined j JOIN summed ON top = j.node AND top_d = j.d LEFT JOIN nodes p ON j.d > 0 AND p.node = j.up AND p.d = j.d - 1
"""

ORACLES["op11_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, lang || chr(10) || phrase AS key, count(*) AS f
  FROM words, LATERAL (SELECT unnest([1, 2, 3]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i) GROUP BY ALL
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, k, phrase, a, c, lang || chr(10) || array_to_string(w[1 : c], ' ') AS head, lang || chr(10) || array_to_string(w[c + 1 :], ' ') AS rest
  FROM candidates, LATERAL (SELECT unnest(range(1, k)) AS c)
), scored AS (
  SELECT s.*, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts s JOIN grams x ON x.key = head JOIN grams y ON y.key = rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), longer AS (
  SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS f
  FROM candidates, LATERAL (SELECT unnest([1, 2]) AS i) WHERE k = 3 GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN longer g ON k = 2 AND g.lang = s.lang AND g.phrase = s.phrase WHERE g.f IS NULL OR 100 * g.f < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
