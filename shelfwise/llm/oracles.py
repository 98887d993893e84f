"""DuckDB counterparts of the queries that SQL can express."""

from shelfwise.llm import credentials

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = rf"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP2 = f"""
WITH line AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
holder AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
    SELECT doc_id, i, line, first IS NOT NULL AND first <> doc_id AS gone
    FROM keyed LEFT JOIN holder USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP4 = """
WITH RECURSIVE unit AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit AS a JOIN unit AS b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, component_id,
    vec_id = component_id AS kept
FROM embeddings JOIN component ON vec_id = a
"""

OP5 = """
WITH RECURSIVE calls AS (
    SELECT conv_id, turn AS seq, md5(conv_id || ':' || turn) AS call_id, text,
        ['search', 'summarise', 'translate'][(turn // 2) % 3 + 1] AS tool,
        length(text) AS chars, length(text) - length(replace(text, '.', '')) AS sentences
    FROM conversations WHERE role = 'user'),
needs AS (
    SELECT a.conv_id, a.call_id, b.call_id AS needed FROM calls AS a JOIN calls AS b
    ON a.conv_id = b.conv_id AND b.seq IN (a.seq - 2, a.seq - 4)),
walk AS (
    SELECT conv_id, call_id, 0 AS level FROM calls
    UNION SELECT needs.conv_id, needs.call_id, level + 1 FROM walk JOIN needs
    ON needs.conv_id = walk.conv_id AND needs.needed = walk.call_id),
levels AS (SELECT conv_id, call_id, max(level) AS level FROM walk GROUP BY conv_id, call_id),
depends AS (
    SELECT conv_id, call_id, string_agg('"' || needed || '"', ',' ORDER BY needed) AS ids
    FROM needs GROUP BY conv_id, call_id),
results AS (
    SELECT md5(conv_id || ':' || (turn - 1)) AS call_id, min(text) AS result
    FROM conversations WHERE role <> 'user' GROUP BY 1),
checked AS (
    SELECT *, CASE WHEN tool = 'search' AND chars > 400 THEN '"limit: above maximum"'
        WHEN tool = 'summarise' AND sentences < 1 THEN '"sentences: below minimum"'
        WHEN tool = 'translate' AND chars % 2 <> 0 AND chars % 3 = 0 THEN '"target: not allowed"'
        WHEN tool = 'translate' AND chars % 2 <> 0 THEN '"target: missing"'
        ELSE '' END AS errors,
        to_json(text)::VARCHAR AS quoted
    FROM calls)
SELECT c.conv_id, c.call_id, c.seq, CAST(levels.level AS INTEGER) AS level, errors = '' AS valid,
    '{"arguments":{' || CASE tool
        WHEN 'search' THEN '"limit":' || chars || ',"query":' || quoted
        WHEN 'summarise' THEN '"sentences":' || sentences || ',"text":' || quoted
        ELSE CASE WHEN chars % 2 = 0 THEN '"target":"en",'
            WHEN chars % 3 = 0 THEN '"target":"xx",' ELSE '' END || '"text":' || quoted END
    || '},"call_id":"' || c.call_id || '","conv_id":' || c.conv_id || ',"depends_on":['
    || coalesce(ids, '') || '],"errors":[' || errors || '],"level":' || levels.level
    || ',"result":' || coalesce(to_json(result)::VARCHAR, 'null') || ',"tool":"' || tool || '"}'
    AS json
FROM checked AS c JOIN levels USING (conv_id, call_id) LEFT JOIN depends USING (conv_id, call_id)
    LEFT JOIN results USING (call_id)
"""

OP6 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source
    FROM documents),
split AS (SELECT r, {WORDS} AS w, string_split(text, chr(10)) AS l FROM docs),
word AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
win AS (
    SELECT r, i, word AS a, lead(word) OVER v AS b, lead(word, 2) OVER v AS c
    FROM word WINDOW v AS (PARTITION BY r ORDER BY i)),
again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n
                      FROM win WHERE c IS NOT NULL) WHERE n > 1),
covered AS (
    SELECT r, count(*) AS n FROM (
        SELECT DISTINCT r, i + d AS i FROM again, (VALUES (0), (1), (2)) AS t(d)) GROUP BY r),
line AS (
    SELECT docs.r, doc_id, source, docs.text, unnest(l) AS line, generate_subscripts(l, 1) AS i
    FROM split JOIN docs USING (r)),
keyed AS (
    SELECT *, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz') AS key FROM line
    WHERE trim(line, {BLANKS}) <> ''),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM keyed GROUP BY r),
held AS (
    SELECT source, key, count(DISTINCT text) AS held_by FROM keyed GROUP BY source, key),
size AS (SELECT source, count(DISTINCT text) AS size FROM docs GROUP BY source),
often AS (
    SELECT held.source, key FROM held JOIN size ON held.source IS NOT DISTINCT FROM size.source
    WHERE held_by > 20 AND 100 * held_by > 5 * size),
gone AS (
    SELECT r, sum(length(line)) AS n FROM keyed JOIN often
    ON keyed.source IS NOT DISTINCT FROM often.source AND keyed.key = often.key GROUP BY r),
base AS (
    SELECT docs.r, doc_id, length(text) AS chars, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(translate(text, {BLANKS}, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_chars
    FROM docs JOIN split USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)
        LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND NOT 100 * (chars - removed_chars) < 30 * chars AS kept,
    removed_chars
FROM base
"""

OP9 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
        END) AS s FROM words),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle AS a JOIN shingle AS b
    USING (s) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
    SELECT a, b FROM shared JOIN size AS x ON x.doc_id = a JOIN size AS y ON y.doc_id = b
    WHERE 100 * shared.n >= 90 * (x.n + y.n - shared.n)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT documents.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(b) AS component_id
FROM documents JOIN reach ON documents.doc_id = a
    LEFT JOIN size ON size.doc_id = documents.doc_id
GROUP BY documents.doc_id
"""

OP10 = """
WITH rules(rhost, rpath, verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (
    SELECT row_number() OVER () AS r, page_id,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
page AS (
    SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(verdict, 'allow') AS verdict
FROM page LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
    AND starts_with(path, rpath)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC) = 1
"""

K, ROUNDS = 40, 5


def _assigned(number):
    """Each vector's nearest centroid of a round; of equal ones the smaller number."""
    return f"""
a{number} AS (
    SELECT r, min(distance) AS distance, arg_min(c, (distance, c)) AS c FROM (
        SELECT r, c, list_sum(list_transform(list_zip(v.x, c{number}.x),
            lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
        FROM v CROSS JOIN c{number}) GROUP BY r)"""


def _moved(number):
    """The floors of the means of a round's clusters; empty ones stay."""
    return f"""
s{number} AS (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT a{number}.c, unnest(v.x) AS x, generate_subscripts(v.x, 1) AS i
        FROM v JOIN a{number} USING (r)) GROUP BY c, i),
c{number + 1} AS (
    SELECT c{number}.c, coalesce(moved.x, c{number}.x) AS x FROM c{number} LEFT JOIN (
        SELECT c, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY i) AS x
        FROM s{number} GROUP BY c) AS moved USING (c))"""


OP12 = f"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding,
        lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x
    FROM embeddings WHERE len(embedding) = 64
        AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x FROM v
    WHERE vec_id IS NOT NULL QUALIFY c < {K}),
{",".join(f"{_assigned(i)},{_moved(i)}" for i in range(ROUNDS))},{_assigned(ROUNDS)}
SELECT vec_id, a{ROUNDS}.c::INTEGER AS cluster, distance,
    (sum(distance) OVER (PARTITION BY a{ROUNDS}.c))::BIGINT AS cluster_inertia,
    (sum(distance) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c{ROUNDS}.x, ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} USING (r) JOIN c{ROUNDS} ON c{ROUNDS}.c = a{ROUNDS}.c
"""


def _secret_hits(pattern, kind):
    """Places of a pattern's matches from the pieces between them."""
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT r, gap + size AS step, size, kind, sum(gap + size) OVER (
        PARTITION BY r ORDER BY i) AS stop FROM (
        SELECT r, i, len(pieces[i]) AS gap, len(found[i]) AS size, {kind} AS kind FROM (
            SELECT r, unnest(range(1, len(found) + 1)) AS i, * FROM (
                SELECT r, string_split_regex(t, '{pattern}') AS pieces,
                    regexp_extract_all(t, '{pattern}') AS found,
                    {", ".join(f"regexp_extract_all(t, '{pattern}', {g}) AS g{g}"
                               if f"g{g}[" in kind else f"NULL AS g{g}" for g in (1, 2, 3))}
                FROM doc)))"""


_WEAK_KIND = """CASE WHEN g1[i] <> '' THEN 3 WHEN g2[i] <> '' THEN 4 WHEN g3[i] = '' THEN 5
    WHEN regexp_matches(g3[i], '[a-z]') AND regexp_matches(g3[i], '[A-Z]')
        AND regexp_matches(g3[i], '[0-9]') THEN 4 END"""

OP13 = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
hit AS MATERIALIZED (
    SELECT r, stop - size AS start, stop, kind FROM (
        {_secret_hits(credentials.ASSIGN, "CASE WHEN len(g1[i]) >= 8 THEN 0 END")} UNION ALL
        {_secret_hits(credentials.ACCESS, "1")} UNION ALL
        {_secret_hits(credentials.HEX, "2")} UNION ALL
        {_secret_hits(credentials.WEAK, _WEAK_KIND)} UNION ALL
        {_secret_hits(credentials.BLANK_LINE, "-1")}) WHERE kind IS NOT NULL),
part AS MATERIALIZED (
    SELECT h.*, (SELECT count(*) FROM hit AS b WHERE b.r = h.r AND b.kind = -1
                 AND b.start < h.start) AS scope
    FROM hit AS h WHERE kind >= 0 AND (kind < 3 OR NOT EXISTS (
        FROM hit AS b WHERE b.r = h.r AND b.kind IN (0, 1, 2) AND b.start < h.stop
        AND b.stop > h.start))),
near AS (
    SELECT a.r, a.start, a.kind, bool_or(b.kind IN (0, 2)) AS strong,
        bool_or(b.kind IN (1, 3)) AS who, bool_or(b.kind = 4) AS what
    FROM part AS a JOIN part AS b ON a.r = b.r AND a.scope = b.scope AND a.kind >= 3
        AND (b.stop BETWEEN a.start - {credentials.REACH} AND a.start
             OR b.start BETWEEN a.stop AND a.stop + {credentials.REACH})
    GROUP BY a.r, a.start, a.kind),
span AS (
    SELECT part.*, ['assign', 'access', 'hex', 'identifier', 'secret', 'endpoint'][kind + 1]
        || ':' || start || ':' || stop AS name
    FROM part LEFT JOIN near USING (r, start, kind)
    WHERE kind < 3 OR kind = 3 AND (strong OR what) OR kind = 4 AND who
        OR kind = 5 AND (strong OR what AND who))
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (kind = 0) AS n_assign,
    count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    sha256(coalesce(string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3), ''))
        AS base_sha256,
    coalesce(string_agg(name, ',' ORDER BY start, kind), '') AS spans
FROM doc LEFT JOIN span USING (r) GROUP BY r
"""

ORACLES = {
    "op10_url_filters": OP10,
    "op12_clusters": OP12,
    "op13_secrets": OP13,
    "op2_line_dedup": OP2,
    "op4_vectors": OP4,
    "op5_tool_calls": OP5,
    "op6_quality_rules": OP6,
    "op9_jaccard": OP9,
}
