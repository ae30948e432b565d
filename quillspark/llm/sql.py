"""SQL for DuckDB whose rows are those of the queries, where SQL can express them.

op1's decoded layers, op2's byte ranges, op5's and op6's models and op9's
connected classes are held against brute force in the tests instead.
"""

from __future__ import annotations

from quillspark.llm import urls

_HEX = lambda text, at, n: f"CAST('0x' || substr({text}, {at}, {n}) AS BIGINT)"

_HOST = r"lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*[^/?#:@.])', 1))"
_SEGMENT = r"regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1)"

URLS = f"""
WITH c AS (
    SELECT page_id, {_HOST} AS host, {_SEGMENT} AS segment, epoch(TIMESTAMP '{urls.EPOCH}') + (coalesce(page_id, 0) * 7919 * 3600) % (366 * 86400) AS t FROM pages),
seen AS (SELECT DISTINCT host, segment FROM c WHERE host <> ''),
named AS (
    SELECT host AS pattern, 3 AS one_in FROM seen UNION ALL SELECT regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1), 4 FROM seen
    UNION ALL SELECT host || '/' || segment, 8 FROM seen WHERE segment <> ''),
listed AS (SELECT pattern, min(one_in) AS one_in FROM named WHERE pattern <> '' GROUP BY pattern),
dated AS (
    SELECT pattern, epoch(TIMESTAMP '{urls.EPOCH}') + ({_HEX("md5(pattern)", 5, 4)} % 300) * 86400 AS on_at, on_at + (1 + {_HEX("md5(pattern)", 9, 4)} % 90) * 86400 AS off_at
    FROM listed WHERE {_HEX("md5(pattern)", 1, 4)} % one_in = 0),
valid AS (SELECT pattern, on_at AS since, off_at AS until, true AS blocked FROM dated UNION ALL SELECT pattern, off_at, NULL, false FROM dated),
parts AS (SELECT *, string_split(host, '.') AS labels FROM c),
asked AS (
    SELECT page_id, t, k AS depth, array_to_string(labels[len(labels) - k + 1:], '.') AS pattern FROM parts, unnest(generate_series(2, len(labels))) AS g(k) WHERE host <> '' AND len(labels) >= 2
    UNION ALL SELECT page_id, t, 1, host FROM parts WHERE host <> '' AND len(labels) < 2
    UNION ALL SELECT page_id, t, len(labels) + 1, host || '/' || segment FROM parts WHERE host <> '' AND segment <> ''),
met AS (
    SELECT page_id, v.* FROM asked a JOIN valid v ON a.pattern = v.pattern AND v.since <= a.t AND (v.until IS NULL OR a.t < v.until)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY depth DESC) = 1)
SELECT c.page_id, CAST(t AS BIGINT) AS fetched, host, coalesce(blocked, false) AS blocked, coalesce(pattern, '') AS pattern, CAST(coalesce(since, -1) AS BIGINT) AS since, CAST(coalesce(until, -1) AS BIGINT) AS until
FROM c LEFT JOIN met USING (page_id)
"""

MIX = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 3 AS cap, CAST(cap AS DOUBLE) / weight AS ratio FROM s),
l AS (
    SELECT *, coalesce(sum(cap) OVER b, 0) AS held, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS left_weight, sum(source_size) OVER () - held AS pool, cap * left_weight >= weight * pool AS free
    FROM w WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT ratio AS first_ratio, pool AS first_pool, left_weight AS first_weight FROM l WHERE free ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(CASE WHEN ratio >= first_ratio THEN CAST(weight * first_pool AS DOUBLE) / first_weight ELSE CAST(cap AS DOUBLE) END, CAST(cap AS DOUBLE)) AS target FROM l, f),
p AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) AS place FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
u AS (SELECT *, CAST({_HEX("sha256('mix:' || coalesce(source, '\\N'))", 1, 8)} AS DOUBLE) / 4294967296.0 AS u FROM p)
SELECT doc_id, size, source_size, target, CAST(floor(rate * CAST(place AS DOUBLE) + u) - floor(rate * CAST(place - 1 AS DOUBLE) + u) AS BIGINT) * size AS taken FROM u
""".replace(r"'\\N'", r"'\N'")

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
w AS (
    SELECT DISTINCT item, 10 AS n, array_to_string(ws[i:i + 9], ' ') AS win FROM b, unnest(generate_series(1, len(ws) - 9)) AS g(i)
    UNION SELECT item, len(ws), array_to_string(ws, ' ') FROM b WHERE len(ws) BETWEEN 1 AND 9),
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
p AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win FROM d, (SELECT DISTINCT n FROM w) AS ns, unnest(generate_series(1, len(ws) - n + 1)) AS g(i)),
h AS (SELECT doc_id, p.n, i, item FROM p JOIN w ON p.n = w.n AND p.win = w.win),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM h, unnest(generate_series(i, i + n - 1)) AS g(j) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

TOP = """
WITH r AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM r q JOIN r c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 10
"""

CHATS = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'),
e AS (
    SELECT *, CASE WHEN contains(text, '<|im_end|>') OR contains(text, '<|im_start|>') OR regexp_matches(text, '<\\+\|') THEN len(regexp_extract_all(text, '<\\*\|')) ELSE 0 END AS escapes FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
    CAST(sum(length('<|im_start|>') + length(role) + 1 + length(text) + escapes + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM w, unnest(generate_series(1, greatest(1, len(ws) - 2))) AS t(i) WHERE len(ws) > 0),
s AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM g GROUP BY doc_id),
k AS (SELECT k, min(n) AS n, min(doc_id) AS d FROM s GROUP BY k),
e AS (SELECT d, n, g FROM k JOIN g ON g.doc_id = k.d),
l AS (SELECT x.d AS a, y.d AS b FROM e x JOIN e y ON x.g = y.g AND x.d <> y.d GROUP BY x.d, y.d, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
r AS (SELECT d AS a, d AS b FROM k UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(least, doc_id) AS component_id FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN k USING (k) LEFT JOIN c ON c.a = k.d
"""

# The CRC-32 of a text of ASCII characters, byte by byte and bit by bit.
_CRC = (
    "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({0}, ''), lambda s: CAST(ascii(s) AS BIGINT))), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), CAST(4294967295 AS BIGINT))"
)

TRIE = f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
s AS (SELECT n.c, n.n, n.c - n.c % 100 AS base, {_CRC.format("CAST(n.c AS VARCHAR)")} % 6 AS h FROM n),
p AS (SELECT s.*, least(h, coalesce(b.n, 0)) AS m FROM s LEFT JOIN n b ON b.c = s.base),
r AS (
    SELECT p.c, pos, role, text FROM p JOIN t ON t.c = p.base AND pos <= m
    UNION ALL SELECT p.c, pos - h + m, role, text FROM p JOIN t USING (c) WHERE pos > h),
k AS (
    SELECT c, pos AS d, length(text) AS chars, string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path FROM r
    UNION ALL SELECT c, 0, 0, '' FROM n),
last AS (SELECT c, max(d) AS l FROM k GROUP BY c),
node AS (SELECT path, min(c) AS conv_id, min(d) AS d, count(*) AS n_convs, min(chars) AS chars FROM k GROUP BY path),
kids AS (SELECT left(path, len(path) - 64) AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
ends AS (SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM k JOIN last USING (c) WHERE d = l GROUP BY path),
sums AS (
    SELECT k.path, count(*) FILTER (WHERE kids.path IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved
    FROM node x JOIN k ON k.c = x.conv_id AND k.d <= x.d LEFT JOIN kids ON kids.path = x.path GROUP BY k.path)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node x JOIN sums USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path) LEFT JOIN node up ON x.d > 0 AND up.path = left(x.path, len(x.path) - 64)
"""

FILL_IN_MIDDLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents),
k AS (SELECT *, {_HEX("h", 1, 8)} % (n + 1) AS x, {_HEX("h", 9, 8)} % (n + 1) AS y, least(x, y) AS a, greatest(x, y) AS b FROM d),
f AS (
    SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_HEX("h", 17, 8)} % 100 >= 90 THEN 'plain' WHEN {_HEX("h", 25, 8)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256 FROM f
"""

ORACLE_SQL: dict[str, str] = {
    "op3_url_filter": URLS,
    "op4_source_mix": MIX,
    "op7_benchmark_decontamination": LEAKS,
    "op8_exact_top_k": TOP,
    "op10_chat_format": CHATS,
    "op11_jaccard_join": JACCARD,
    "op12_prefix_trie": TRIE,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
