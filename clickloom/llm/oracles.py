"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
    FROM d GROUP BY source),
r AS (
    SELECT 0 AS i, 0::DOUBLE AS share
    UNION ALL
    SELECT i + 1, (SELECT (sum(source_size)::DOUBLE
                           - coalesce(sum(CASE WHEN w * r.share > 3 * source_size THEN 3.0 * source_size END), 0)::DOUBLE)
                          / sum(CASE WHEN w * r.share > 3 * source_size THEN 0 ELSE w END) FROM s)
    FROM r WHERE i < (SELECT count(*) + 1 FROM s)),
p AS (
    SELECT source, source_size, least(3.0 * source_size, w * (SELECT max(share) FROM r))::DOUBLE AS target FROM s),
q AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM p),
g AS (
    SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
c AS (
    SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
e AS (
    SELECT c.source, min(struct_pack(h := c.h, n := c.n, upto := c.upto)) AS e
    FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source
    WHERE c.upto > q.target - q.whole * q.source_size GROUP BY c.source),
l AS (
    SELECT q.*, CASE WHEN source_size = 0 THEN -1
                     WHEN e.e IS NULL THEN 1152921504606846975
                     WHEN abs(target - whole * source_size - e.e.upto) < abs(target - whole * source_size - (e.e.upto - e.e.n))
                     THEN e.e.h ELSE e.e.h - 1 END AS last
    FROM q LEFT JOIN e ON q.source IS NOT DISTINCT FROM e.source)
SELECT d.doc_id, d.size, l.source_size, l.target, (d.size * (l.whole + CASE WHEN d.h <= l.last THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source
"""

OP3 = rf"""
WITH RECURSIVE t AS (
    SELECT coalesce(text, '') AS text, min(doc_id) AS id, count(*) AS copies,
           regexp_extract_all(coalesce(text, ''), '{WORD}') AS w
    FROM documents GROUP BY 1),
s AS (
    SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g
    FROM t),
n AS (SELECT id, count(*) AS size FROM s GROUP BY id),
o AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY 1, 2),
l AS (
    SELECT a, b FROM o JOIN n x ON x.id = a JOIN n y ON y.id = b
    WHERE 10 * common >= 8 * (x.size + y.size - common)),
reach AS (
    SELECT id AS a, id AS b FROM t
    UNION
    SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a AS id, min(b) AS class_id FROM reach GROUP BY a),
k AS (SELECT a AS id, sum(copies)::BIGINT AS more FROM l JOIN t ON t.id = l.b GROUP BY a)
SELECT d.doc_id, c.class_id, (t.copies - 1 + coalesce(k.more, 0))::BIGINT AS links
FROM documents d JOIN t ON coalesce(d.text, '') = t.text JOIN c ON c.id = t.id LEFT JOIN k ON k.id = t.id
"""

OP4 = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
m AS (SELECT html, max(page_id) AS lead FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN lead <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN lead <> page_id THEN lead END AS refers_to
FROM p LEFT JOIN m ON p.html = m.html AND payload_bytes >= 1000
"""

OP6 = rf"""
WITH a AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(coalesce(text, ''))) AS doc, doc_id,
           string_split(coalesce(text, ''), chr(10)) AS ls
    FROM documents),
b AS (
    SELECT doc, doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS line FROM a),
c AS (
    SELECT *, len(regexp_extract_all(l, '{WORD}')) AS words FROM b),
d AS (
    SELECT *, row_number() OVER (PARTITION BY doc ORDER BY line) AS pos FROM c WHERE words > 0),
e AS (
    SELECT x.doc, x.pos, x.words, y.doc AS earlier, x.pos - y.pos AS apart
    FROM d x JOIN d y ON x.l = y.l AND (x.doc > y.doc OR (x.doc = y.doc AND x.pos > y.pos))),
f AS (
    SELECT *, pos - row_number() OVER (PARTITION BY doc, earlier, apart ORDER BY pos) AS run FROM e),
r AS (
    SELECT doc, min(pos) AS first, max(pos) AS last FROM f GROUP BY doc, earlier, apart, run HAVING sum(words) >= 50),
g AS (
    SELECT DISTINCT d.doc, d.line, d.words FROM r JOIN d ON d.doc = r.doc AND d.pos BETWEEN r.first AND r.last),
h AS (
    SELECT c.doc, c.doc_id, count(*) AS n_lines, count(g.line) AS n_deleted, coalesce(sum(g.words), 0) AS deleted_words,
           md5(coalesce(string_agg(CASE WHEN g.line IS NULL THEN md5(c.l) END, '' ORDER BY c.line), '')) AS kept_digest
    FROM c LEFT JOIN g ON c.doc = g.doc AND c.line = g.line GROUP BY c.doc, c.doc_id)
SELECT doc_id, n_lines, n_deleted, deleted_words::BIGINT AS deleted_words, kept_digest FROM h
"""

OP7 = """
WITH t AS (
    SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS ordinal
    FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS participant FROM t WHERE speaker <> 'system'),
s AS (
    SELECT t.conv_id, participant, ordinal, speaker = participant AS train,
           '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = participant THEN 'assistant'
                ELSE 'user name=' || regexp_replace(replace(speaker, '<|im_', '<| im_'), '[\\r\\n]+', ' ', 'g') END || chr(10) AS header,
           replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS body
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id)
SELECT conv_id, participant, count(*) AS n_turns, count_if(train)::BIGINT AS n_own_turns,
       sum(length(header) + length(body))::BIGINT AS n_chars,
       sum(CASE WHEN train THEN length(body) ELSE 0 END)::BIGINT AS n_train_chars,
       sum(('0x' || substr(md5(ordinal::VARCHAR || ':' || train::INT::VARCHAR || ':' || header || body), 1, 8))::BIGINT)::BIGINT AS digest
FROM s GROUP BY conv_id, participant
"""

OP13_FIRST = """
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = 64),
x AS (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
s AS (
    SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM kept
    QUALIFY c < 16),
c0 AS (SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM s),"""

OP13_ASSIGN = """
d{n} AS (SELECT r, c, sum((x - y) * (x - y))::BIGINT AS distance FROM x JOIN c{n} USING (i) GROUP BY r, c),
a{n} AS (SELECT r, c, distance FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1),"""

OP13_MOVE = """
m{n} AS (SELECT c, i, sum(x)::HUGEINT AS total, count(*)::HUGEINT AS n FROM a{n} JOIN x USING (r) GROUP BY c, i),
c{next} AS (
    SELECT c, i, coalesce((total - ((total % n) + n) % n) // n, y)::BIGINT AS y FROM c{n} LEFT JOIN m{n} USING (c, i)),"""

OP13_LAST = """
z AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a3 JOIN kept USING (r) JOIN z USING (c)
"""

OP13 = (OP13_FIRST + "".join(OP13_ASSIGN.format(n=n) + OP13_MOVE.format(n=n, next=n + 1) for n in range(3))
        + OP13_ASSIGN.format(n=3) + OP13_LAST)

ORACLES: dict[str, str] = {
    "op1_mixing": OP1, "op3_jaccard_join": OP3, "op4_warc": OP4, "op6_line_dedup": OP6, "op7_chat_perspectives": OP7,
    "op13_bisector": OP13}
