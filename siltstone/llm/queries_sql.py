"""DuckDB SQL for the queries that SQL can state."""

OP8_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + 9], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM item_words WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT n FROM windows
), places AS (
    SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc_words, sizes WHERE len(w) >= n)
), found AS (
    SELECT doc_id, item_id, k, n FROM places JOIN windows USING (n, win)
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""

OP9_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source,
           CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT 0 AS step, sum(source_size)::DOUBLE / sum(weight) AS level, 0::BIGINT AS n FROM sources
    UNION ALL
    SELECT step + 1,
           ((SELECT sum(source_size) FROM sources)::DOUBLE
             - (SELECT coalesce(sum(CASE WHEN level * weight > 3.0 * source_size THEN 3.0 * source_size END), 0) FROM sources))
           / (SELECT sum(CASE WHEN level * weight > 3.0 * source_size THEN NULL ELSE weight END) FROM sources),
           (SELECT count(*) FROM sources WHERE level * weight > 3.0 * source_size)
    FROM levels
    WHERE (SELECT count(*) FROM sources WHERE level * weight > 3.0 * source_size) > n
), final AS (
    SELECT level FROM levels ORDER BY step DESC LIMIT 1
), targets AS (
    SELECT source, source_size, least(level * weight, 3.0 * source_size) AS target,
           CASE WHEN source_size > 0 THEN least(level * weight, 3.0 * source_size) / source_size ELSE 0.0 END AS rate
    FROM sources, final
), placed AS (
    SELECT doc_id, s.source, size, source_size, target, floor(rate)::BIGINT AS whole, rate - floor(rate) AS p,
           (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':mix'), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), ordered AS (
    SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds FROM placed
), summed AS (
    SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS open,
           sum(size) OVER (PARTITION BY source, p > 0 ORDER BY odds, doc_id::VARCHAR, size) AS upto
    FROM ordered
), decided AS (
    SELECT *, whole + CASE WHEN p > 0 AND upto - size / 2.0 <= open THEN 1 ELSE 0 END AS copies FROM summed
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM decided
"""

OP11_SQL = r"""
WITH doc_terms AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), sized AS (
    SELECT d, doc_id, len(w)::BIGINT AS n FROM doc_terms WHERE len(w) > 0
), totals AS (
    SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS length FROM sized
), counts AS (
    SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(w) AS term FROM doc_terms) GROUP BY d, term
), terms AS (
    SELECT term, floor(1000 * ln((2 * any_value(total) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, totals GROUP BY term
), impacts AS (
    SELECT d, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * total) // length))) AS impact
    FROM counts JOIN sized USING (d) JOIN terms USING (term), totals
), item_terms AS (
    SELECT DISTINCT item, item_id, term FROM (
        SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
), scores AS (
    SELECT item, item_id, d, sum(impact)::BIGINT AS score FROM item_terms JOIN impacts USING (term) GROUP BY item, item_id, d
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
    FROM scores JOIN sized USING (d) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

OP12_SQL = r"""
WITH RECURSIVE doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents WHERE text IS NOT NULL
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[k : k + 3], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM doc_words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), edges AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT a AS doc_id, b AS other FROM edges
    UNION
    SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
), least AS (
    SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(d.doc_id, other), d.doc_id) AS component_id,
       coalesce(least(d.doc_id, other), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""

OP13_SQL = r"""
WITH RECURSIVE rows AS (
    SELECT doc_id, lang, text,
           CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
           || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
           || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
           list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT)),
               lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))
           ) AS crc
    FROM documents
), leaves AS (
    SELECT doc_id, lang, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
           sha256(head || CASE WHEN seen IS NULL THEN '-' ELSE strlen(seen) || ':' || seen END) AS altered
    FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 3 = 0
                         THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS seen
          FROM rows)
), placed AS (
    SELECT doc_id, leaf, altered, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY lang) AS n
    FROM leaves
), low AS (
    SELECT 0 AS level, tree, pos, n, leaf AS h FROM placed
    UNION ALL
    SELECT level + 1, tree, pos // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos))
    FROM low WHERE n > 1 GROUP BY level, tree, pos // 8
), subroots AS (
    SELECT tree, h AS subroot FROM low WHERE n = 1
), high AS (
    SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, subroot AS h FROM subroots
    UNION ALL
    SELECT level + 1, pos // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY pos))
    FROM high WHERE n > 1 GROUP BY level, pos // 8
), siblings AS (
    SELECT level, tree, pos,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, tree, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, tree, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM low WHERE n > 1
), high_siblings AS (
    SELECT level, pos,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM high WHERE n > 1
), steps AS (
    SELECT p.tree, p.pos, s.level, s.l, s.r
    FROM placed p JOIN siblings s ON s.tree = p.tree AND s.pos = p.pos // (8 ** s.level)::BIGINT
    UNION ALL
    SELECT p.tree, p.pos, 100 + s.level, s.l, s.r
    FROM placed p JOIN high_siblings s ON s.pos = p.tree // (8 ** s.level)::BIGINT
), proofs AS (
    SELECT tree, pos, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs, string_agg(l || r, '' ORDER BY level) AS path
    FROM steps GROUP BY tree, pos
), folded AS (
    SELECT p.tree, p.pos, 0 AS k, p.altered AS h FROM placed p
    UNION ALL
    SELECT f.tree, f.pos, k + 1, sha256(ls[k + 1] || h || rs[k + 1])
    FROM folded f JOIN proofs q ON f.tree = q.tree AND f.pos = q.pos WHERE k < len(ls)
)
SELECT p.doc_id, p.leaf, s.subroot, t.h AS root, sha256(coalesce(q.path, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed p
JOIN subroots s ON s.tree = p.tree
JOIN (SELECT h FROM high WHERE n = 1) t ON true
LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos
JOIN folded f ON f.tree = p.tree AND f.pos = p.pos AND f.k = coalesce(len(q.ls), 0)
"""
