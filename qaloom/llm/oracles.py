"""The same results in DuckDB SQL, where SQL can express them."""

ORACLES = {
    "op1_mix": r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        CAST(list_value(5, 2, 1)[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight
    FROM sized GROUP BY source
), caps AS (
    SELECT *, CAST(source_size AS DOUBLE) * 3 AS cap, CAST(source_size AS DOUBLE) * 3 / weight AS need FROM per
), levels AS (
    SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
            - coalesce(sum(cap) OVER (ORDER BY need, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (ORDER BY need, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM caps
), shares AS (
    SELECT *, max(CASE WHEN need > level THEN level END) OVER () AS share FROM levels
), targets AS (
    SELECT source, source_size, least(cap, coalesce(weight * share, cap)) AS target FROM shares
), expected AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / CAST(source_size AS DOUBLE) * 16777216) AS BIGINT) END AS expected,
        CAST('0x' || substr(md5('mix 7 ' || coalesce(source, '')), 1, 6) AS BIGINT) AS u
    FROM targets
), places AS (
    SELECT doc_id, size, source_size, target, expected, u,
        sum(expected) OVER (
            PARTITION BY s.source
            ORDER BY length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0)),
                CAST('0x' || substr(md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR))), 1, 8) AS BIGINT),
                doc_id NULLS FIRST, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
        ) + u AS upto
    FROM sized s JOIN expected e ON s.source IS NOT DISTINCT FROM e.source
), taken AS (
    SELECT *, (CAST(upto AS BIGINT) >> 24) - (CAST(upto - expected AS BIGINT) >> 24) AS copies FROM places
)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM taken
""",
    "op2_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op7_url_filter": r"""
WITH parts AS (
    SELECT page_id,
        CASE WHEN url LIKE '%://%' THEN lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)) ELSE '' END AS host,
        CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM pages
), lab AS (
    SELECT p.host, CAST(l.quality = 0 OR l.toxic = 1 AS INT) AS bad FROM parts p LEFT JOIN labels l ON p.page_id = l.doc_id
), h AS (
    SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS b
    FROM lab GROUP BY host
), h2 AS (
    SELECT host, n, bad, regexp_matches(b, '^[0-9.]+$|^\[') AS num, b, string_split(b, '.') AS l FROM h
), h3 AS (
    SELECT host, n, bad, array_to_string(l[-2:], '.') IN ('ac.uk', 'co.in', 'co.jp', 'co.kr', 'co.nz', 'co.uk', 'co.za', 'com.ar', 'com.au', 'com.br', 'com.cn', 'com.mx', 'com.tr', 'org.uk') AS wide, num, b, l FROM h2
), hosts AS (
    SELECT host, n, bad, CASE WHEN num THEN b WHEN wide THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix,
        CASE WHEN num THEN b WHEN wide THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain FROM h3
), s0 AS (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) FROM hosts) AS m FROM hosts GROUP BY suffix
), s1 AS (
    SELECT sum(power(bad - n * m, 2) - n * m * (1 - m)) AS a, sum(n * (n - 1) * m * (1 - m)) AS c FROM s0
), s2 AS (
    SELECT round(1.0 / CASE WHEN c = 0 THEN 0.5 ELSE least(0.999, greatest(0.001, a / c)) END - 1, 6) AS k FROM s1
), s AS (
    SELECT suffix, (bad + k * m) / (n + k) AS m FROM s0, s2 WHERE n > 0
), d0 AS (
    SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM hosts JOIN s USING (suffix) GROUP BY suffix, domain
), d1 AS (
    SELECT sum(power(bad - n * m, 2) - n * m * (1 - m)) AS a, sum(n * (n - 1) * m * (1 - m)) AS c FROM d0
), d2 AS (
    SELECT round(1.0 / CASE WHEN c = 0 THEN 0.5 ELSE least(0.999, greatest(0.001, a / c)) END - 1, 6) AS k FROM d1
), d AS (
    SELECT suffix, domain, (bad + k * m) / (n + k) AS m FROM d0, d2
), t0 AS (
    SELECT host, n, bad, m FROM hosts JOIN d USING (suffix, domain)
), t1 AS (
    SELECT sum(power(bad - n * m, 2) - n * m * (1 - m)) AS a, sum(n * (n - 1) * m * (1 - m)) AS c FROM t0
), t2 AS (
    SELECT round(1.0 / CASE WHEN c = 0 THEN 0.5 ELSE least(0.999, greatest(0.001, a / c)) END - 1, 6) AS k FROM t1
), t AS (
    SELECT host, n, k, (bad + k * m) / (n + k) AS m FROM t0, t2
), blocked AS (
    SELECT host FROM t WHERE m - 1.645 * sqrt(m * (1 - m) / (n + k + 1)) > 0.5
), fit AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM fit
""",
    "op8_warc": """
WITH p AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""",
    "op11_exact_dedup": r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
""",
    "op13_merkle": """
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree, n_chars,
        [coalesce(octet_length(encode(CAST(x AS VARCHAR))) || ':' || x, '-') FOR x IN [CAST(doc_id AS VARCHAR), source, lang]] AS a,
        coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS c,
        coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') AS c1,
        coalesce(octet_length(encode(text)) || ':' || text, '-') AS t FROM documents
), crc AS (
    SELECT doc_id, list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(range(0, 8 * len(CAST(doc_id AS VARCHAR))), lambda i: CAST(
        CASE WHEN i % 8 = 0 THEN 256 + ascii(CAST(doc_id AS VARCHAR)[CAST(i // 8 + 1 AS INT)]) ELSE 0 END AS UBIGINT)),
        lambda s, x: CASE WHEN (xor(s, x & 255) & 1) = 1 THEN xor(xor(s, x & 255) >> 1, 3988292384) ELSE xor(s, x & 255) >> 1 END) AS crc FROM documents
), leaves AS (
    SELECT doc_id, tree, sha256(array_to_string(a, '') || c || t) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(array_to_string(a, '') || c1 || t) ELSE sha256(array_to_string(a, '') || c || t) END AS used,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS total FROM d JOIN crc USING (doc_id)
), nodes AS (
    SELECT tree, 0 AS level, pos, total, leaf AS digest FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 2, (any_value(total) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE total > 1
    GROUP BY tree, level, pos // 2
), subroots AS (
    SELECT tree, level AS height, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total FROM nodes WHERE total = 1
), tops AS (
    SELECT 0 AS level, pos, total, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (any_value(total) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE total > 1 GROUP BY level, pos // 2
), path AS (
    SELECT doc_id, level, l.pos >> level AS at, digest FROM leaves l JOIN nodes n ON n.tree = l.tree AND n.pos = xor(l.pos >> level, 1)
    UNION ALL
    SELECT doc_id, height + level, s.pos >> level, digest FROM leaves l JOIN subroots s USING (tree) JOIN tops n ON n.pos = xor(s.pos >> level, 1)
), proof AS (
    SELECT doc_id, sha256(string_agg(digest, '' ORDER BY level)) AS proof_sha256 FROM path GROUP BY doc_id
), folded AS (
    SELECT doc_id, 0 AS level, height + (SELECT max(level) FROM tops) AS height, tree, l.pos, s.pos AS top, s.height AS turn, used AS digest FROM leaves l JOIN subroots s USING (tree)
    UNION ALL
    SELECT f.doc_id, f.level + 1, height, tree, pos, top, turn, sha256(CASE WHEN p.digest IS NULL THEN f.digest WHEN p.at % 2 = 1 THEN p.digest || f.digest ELSE f.digest || p.digest END)
    FROM folded f LEFT JOIN path p ON p.doc_id = f.doc_id AND p.level = f.level WHERE f.level < height
)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN folded f USING (doc_id) LEFT JOIN proof USING (doc_id), (SELECT digest AS root FROM tops WHERE total = 1)
WHERE f.level = f.height
""",
    "op12_repair": r"""
WITH RECURSIVE named AS (
    SELECT *, coalesce('=' || conv_id, '') AS conv, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), crc AS (
    SELECT *, xor(list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(range(0, 8 * len(name)), lambda i: CAST(
        CASE WHEN i % 8 = 0 THEN 256 + ascii(name[CAST(i // 8 + 1 AS INT)]) ELSE 0 END AS UBIGINT)),
        lambda s, x: CASE WHEN (xor(s, x & 255) & 1) = 1 THEN xor(xor(s, x & 255) >> 1, 3988292384) ELSE xor(s, x & 255) >> 1 END), 4294967295) % 20 AS kind FROM named
), damaged AS (
    SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
    FROM crc, range(2) AS r(n) WHERE n < CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos, role[1] AS c,
        regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM damaged
), flags AS (
    SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS duplicate,
        lag(c) OVER (PARTITION BY conv ORDER BY pos) || c AS pair, count(*) OVER (PARTITION BY conv) AS n FROM ordered
), rows_ AS (
    SELECT *, NOT blank AND NOT duplicate AND bare[-1] NOT IN ('.', '!', '?') AS truncated FROM flags
), counts AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
        count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv
), start AS (
    SELECT DISTINCT conv, n FROM rows_
), best AS (
    SELECT conv, n AS i, [{'c': 0, 'a': '', 'r': ''}, {'c': 10, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}, {'c': 5, 'a': 'I', 'r': chr(10) || 'assistant:'}, {'c': 0, 'a': '', 'r': ''}] AS v FROM start
    UNION ALL
    SELECT conv, i - 1, list_transform([1, 2, 3, 4], lambda x: list_min([w[x], {'c': w[[3, 3, 4, 3][x]].c + 5, 'a': 'I' || w[[3, 3, 4, 3][x]].a, 'r': chr(10) || ['user:', 'user:', 'assistant:', 'user:'][x] || w[[3, 3, 4, 3][x]].r}]))
    FROM (
        SELECT conv, i, list_transform([1, 2, 3, 4], lambda x: list_min([u[x], {'c': u[[3, 3, 4, 3][x]].c + 5, 'a': 'I' || u[[3, 3, 4, 3][x]].a, 'r': chr(10) || ['user:', 'user:', 'assistant:', 'user:'][x] || u[[3, 3, 4, 3][x]].r}])) AS w
        FROM (
            SELECT b.conv, i, list_transform([1, 2, 3, 4], lambda x: list_min(list_concat([{'c': v[x].c + 2, 'a': 'D' || v[x].a, 'r': v[x].r}],
                CASE WHEN blank OR duplicate THEN [] ELSE [{'c': v[[3, 3, 4, 3][x]].c + CASE WHEN truncated THEN 6 ELSE 1 END, 'a': 'R' || v[[3, 3, 4, 3][x]].a,
                    'r': chr(10) || ['user:', 'user:', 'assistant:', 'user:'][x] || text || v[[3, 3, 4, 3][x]].r}] END,
                CASE WHEN blank OR duplicate THEN [] WHEN c = 's' AND x = 1 THEN [{'c': v[2].c + CASE WHEN truncated THEN 5 ELSE 0 END, 'a': 'K' || v[2].a, 'r': chr(10) || role || ':' || text || v[2].r}]
                    WHEN c = 'u' AND x <> 3 THEN [{'c': v[3].c + CASE WHEN truncated THEN 5 ELSE 0 END, 'a': 'K' || v[3].a, 'r': chr(10) || role || ':' || text || v[3].r}]
                    WHEN c = 'a' AND x = 3 THEN [{'c': v[4].c + CASE WHEN truncated THEN 5 ELSE 0 END, 'a': 'K' || v[4].a, 'r': chr(10) || role || ':' || text || v[4].r}] ELSE [] END))) AS u
            FROM best b JOIN rows_ r ON r.conv = b.conv AND r.pos = b.i
        )
    )
), done AS (
    SELECT conv, v[1].c AS cost, v[1].a AS audit, sha256(v[1].r[2:]) AS repaired_sha256 FROM best WHERE i = 0
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM named) LEFT JOIN counts USING (conv) LEFT JOIN done USING (conv)
""",
}
