"""DuckDB SQL that says the same as the registered queries."""

WORD = r"[^\x20\x09-\x0D]+"

JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS w FROM documents),
sets AS (
  SELECT r, doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
shingles AS (SELECT r, len(s) AS n, unnest(s) AS sh FROM sets),
links AS (
  SELECT x.r AS a, y.r AS b FROM shingles x JOIN shingles y USING (sh)
  GROUP BY x.r, y.r, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, len(any_value(s.s))::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM sets s JOIN reach ON s.r = reach.a JOIN sets o ON o.r = reach.b GROUP BY s.r, s.doc_id"""

MIX = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    CAST(concat('0x', substr(md5(concat('17:', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 15)) AS BIGINT) AS draw
  FROM documents),
total AS (SELECT coalesce(sum(size), 0)::BIGINT AS total FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source),
-- by cap over weight the clamped sources come first; the first one not over its cap ends them
lined AS (
  SELECT *, coalesce(sum(3 * source_size) OVER before, 0)::HUGEINT AS taken, sum(weight) OVER rest AS weights
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (
  SELECT total - taken AS left_, weights FROM lined, total WHERE (total - taken) * weight <= 3 * source_size * weights
  ORDER BY 3 * source_size / weight, source NULLS LAST LIMIT 1),
share AS (
  SELECT source, source_size, coalesce(CASE WHEN left_ * weight > 3 * source_size::HUGEINT * weights THEN 3.0::DOUBLE * source_size
    ELSE (left_::DOUBLE * weight) / weights::DOUBLE END, 3.0::DOUBLE * source_size) AS target
  FROM sources LEFT JOIN level ON true),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM share),
drawn AS (
  SELECT d.doc_id, d.size, c.source_size, c.target, c.whole, c.target - c.whole * c.source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS before
  FROM docs d JOIN cut c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN 2 * before + size < 2 * rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM drawn"""

LINES = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT r, doc_id, pos, line, coalesce(doc_id <> keeper, false) AS drop FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (drop) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id"""


def _url_levels() -> str:
    """The grams of each length with their probabilities in both models, each from those one shorter."""
    parts = []
    for n in range(1, 5):
        source = "" if n == 1 else f" JOIN level{n - 1} s ON s.gram = substr(c.gram, 2)"
        sa, sr = ("(1.0::DOUBLE / 256)",) * 2 if n == 1 else ("s.pa", "s.pr")
        parts.append(
            f"level{n} AS (SELECT c.gram, {sa} AS sa, {sr} AS sr, (c.a + 2.0::DOUBLE * {sa}) / (t.a + 2.0::DOUBLE) AS pa,"
            f" (c.r + 2.0::DOUBLE * {sr}) / (t.r + 2.0::DOUBLE) AS pr"
            f" FROM counts c JOIN totals t USING (context){source} WHERE length(c.gram) = {n} AND c.a + c.r >= 2)"
        )
    return ",\n".join(parts)


URLS = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules AS (
  SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')) r (rule_host, rule_path, rule_verdict)),
fits AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) AS by_rule
  FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n),
ruled AS (SELECT named.*, host || path AS line, rule, by_rule FROM named LEFT JOIN fits USING (n)),
lines AS (
  SELECT line, count(*) FILTER (by_rule = 'allow') AS accepted, count(*) FILTER (by_rule = 'block') AS rejected FROM ruled GROUP BY line),
places AS (
  SELECT line, accepted, rejected, '^' || line || '$' AS s, unnest(range(2, length(line) + 3)) AS i FROM lines),
grams AS (
  SELECT line, accepted, rejected, substr(s, i - o, o + 1) AS gram FROM places CROSS JOIN (VALUES (0), (1), (2), (3)) t (o) WHERE i - o >= 1),
counts AS (
  SELECT gram, substr(gram, 1, length(gram) - 1) AS context, sum(accepted) AS a, sum(rejected) AS r FROM grams
  WHERE accepted + rejected > 0 GROUP BY gram),
totals AS (SELECT context, sum(a) AS a, sum(r) AS r FROM counts GROUP BY context),
{_url_levels()},
deltas AS (
  SELECT gram, (ln(pa) - ln(pr)) - (ln(sa) - ln(sr)) AS delta
  FROM (FROM level1 UNION ALL FROM level2 UNION ALL FROM level3 UNION ALL FROM level4)),
scores AS (
  SELECT line, accepted, rejected, round(coalesce(sum(delta), 0) / (length(line) + 1), 9) AS score FROM grams LEFT JOIN deltas USING (gram)
  GROUP BY line, accepted, rejected),
bins AS (SELECT floor(score * 64) AS bin, sum(accepted) AS a, sum(rejected) AS r FROM scores WHERE accepted + rejected > 0 GROUP BY bin),
sums AS (SELECT sum(a) AS a, sum(r) AS r FROM bins),
rights AS (
  SELECT bin, round(sum(b.a) OVER up / s.a + 1 - sum(b.r) OVER up / s.r, 9) AS good FROM bins b, sums s WINDOW up AS (ORDER BY bin DESC)),
least AS (
  SELECT CASE WHEN s.r = 0 THEN '-inf'::DOUBLE WHEN s.a = 0 THEN 'inf'::DOUBLE
    ELSE (SELECT bin / 64 FROM rights ORDER BY good DESC, abs(bin), bin LIMIT 1) END AS least FROM sums s)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled JOIN scores USING (line), least"""


# crc32 of a text of code points below U+0800, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({text}, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 | (unicode(c) >> 6)::BIGINT, 128 | (unicode(c) & 63)::BIGINT] END))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

SPELLING = f"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), hashed AS (
    SELECT run, {_CRC.format(text="id || ':' || run")} AS h FROM runs WHERE length(run) >= 7
), words AS MATERIALIZED (
    SELECT word, count(*) AS n
    FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), gaps AS (
    SELECT word, n, left(word, i) AS head, substr(word, i + 2) AS tail FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS MATERIALIZED (
    SELECT x.word, y.word AS other, y.n AS other_n FROM gaps x JOIN gaps y ON x.head = y.head AND x.tail = y.tail AND x.word <> y.word
    UNION SELECT x.word, y.word, y.n FROM gaps x JOIN words y ON y.word = x.head || x.tail
    UNION SELECT y.word, x.word, x.n FROM gaps x JOIN words y ON y.word = x.head || x.tail
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, other)) AS best FROM near GROUP BY word
), forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form, CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), steps AS (
    SELECT word, word AS at, form AS next FROM forms
    UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON s.next = f.word
)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON f.word = s.word WHERE s.next IS NULL
"""

TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
    SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {_CRC.format(text="conv_id::VARCHAR")} % 9 AS h FROM turns
), parts AS (
    SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM conv c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM conv c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), paths AS (
    SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS path
    FROM conv c LEFT JOIN parts p ON c.conv_id = p.conv_id GROUP BY c.conv_id
), steps AS (
    SELECT conv_id, d, path[1:d] AS node, d = len(path) AS ends FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)
), nodes AS MATERIALIZED (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
           (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(node[d].text)) END AS saved
    FROM steps GROUP BY node, d
), children AS (
    SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.node = c.node AND n.d = c.d
), sums AS (
    SELECT node[1:a] AS node, a AS d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(d + 1)) AS a FROM counted) GROUP BY ALL
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON n.node = s.node AND n.d = s.d LEFT JOIN nodes p ON n.d = p.d + 1 AND n.node[1:n.d - 1] = p.node
"""
