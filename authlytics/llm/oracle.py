"""DuckDB SQL for the corpus queries that SQL can express."""


def _distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, 65), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))"


def _round(k: int) -> str:
    """Vectors with their nearest centroid of step k, and the centroids of the step after it."""
    return f"""
        near{k} AS (
            SELECT r, any_value(x) AS x, min([{_distance("x", "c")}, cluster]::BIGINT[]) AS best
            FROM v, c{k} GROUP BY r),
        sum{k} AS (
            SELECT best[2] AS cluster, i, count(*) AS n, sum(x[i])::BIGINT AS s
            FROM near{k}, (SELECT unnest(range(1, 65)) AS i) GROUP BY ALL),
        mean{k} AS (
            SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS mean
            FROM sum{k} GROUP BY cluster),
        c{k + 1} AS (
            SELECT cluster, coalesce(mean, c) AS c FROM c{k} LEFT JOIN mean{k} USING (cluster))"""


STATEMENTS: dict[str, str] = {
    "op1_decontaminate": r"""
        WITH words AS (
            SELECT true AS doc, doc_id AS id, text FROM documents
            UNION ALL SELECT false, item_id, text FROM benchmark),
        split AS (
            SELECT doc, id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM words),
        windows AS (
            SELECT DISTINCT id AS item_id, least(len(w), 10) AS width,
                   array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
            FROM (SELECT id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
                  FROM split WHERE NOT doc AND len(w) > 0)),
        places AS (
            SELECT id AS doc_id, width, i, array_to_string(w[i:i + width - 1], ' ') AS phrase
            FROM (SELECT id, w, width, unnest(generate_series(1, len(w) - width + 1)) AS i
                  FROM split, (SELECT DISTINCT width FROM windows)
                  WHERE doc AND len(w) >= width)),
        hits AS (SELECT doc_id, item_id, i, p.width FROM places p JOIN windows USING (width, phrase)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + width - 1)) AS place FROM hits)
            GROUP BY doc_id),
        hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
        SELECT s.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM split s LEFT JOIN hit_words h ON h.doc_id = s.id
        LEFT JOIN hit_items t ON t.doc_id = s.id
        WHERE doc""",
    "op2_urls": r"""
        WITH p AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        n AS (SELECT *, regexp_replace(split_part(host, '@', -1), ':[0-9]*$', '') AS name FROM p),
        l AS (SELECT *, regexp_full_match(name, '[0-9.]+') OR starts_with(name, '[') AS address,
                     string_split(name, '.') AS labels FROM n),
        two AS (SELECT *, array_to_string(labels[-2:], '.') AS last_two,
                       array_to_string(labels[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au',
                           'co.jp', 'co.nz', 'com.br', 'co.in', 'co.za') AS long FROM l),
        named AS (
            SELECT page_id, host, path,
                   CASE WHEN address THEN name
                        WHEN long THEN array_to_string(labels[-3:], '.') ELSE last_two END AS domain,
                   CASE WHEN address THEN '' WHEN long THEN last_two ELSE labels[-1] END AS suffix
            FROM two),
        hosts AS (
            SELECT host, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad
            FROM named LEFT JOIN (
                SELECT doc_id AS page_id, (quality = 0 OR toxic = 1)::INT AS bad FROM labels)
            USING (page_id) GROUP BY ALL),
        domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
        suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
        level AS (
            SELECT 'host' AS level, n, bad FROM hosts WHERE n > 0
            UNION ALL SELECT 'domain', n, bad FROM domains WHERE n > 0
            UNION ALL SELECT 'suffix', n, bad FROM suffixes WHERE n > 0),
        moments AS (
            SELECT level, count(*) AS k, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad,
                   sum(n * n)::DOUBLE AS squares, sum(bad * bad / n) AS spread
            FROM level GROUP BY level),
        chances AS (SELECT *, bad / n * (1 - bad / n) AS chance FROM moments),
        rooms AS (
            SELECT *, spread - n * (bad / n) * (bad / n) - (k - 1) * chance AS excess,
                   (n - squares / n - (k - 1)) * chance AS room FROM chances),
        correlations AS (
            SELECT level, CASE WHEN k > 1 AND 0 < bad AND bad < n AND room > 0
                               THEN least(greatest(excess / room, 0.001), 1.0 / 3)
                               ELSE 0.001 END AS r FROM rooms),
        strengths AS (
            SELECT coalesce(max((1 - r) / r) FILTER (level = 'host'), 999) AS host,
                   coalesce(max((1 - r) / r) FILTER (level = 'domain'), 999) AS domain,
                   coalesce(max((1 - r) / r) FILTER (level = 'suffix'), 999) AS suffix
            FROM correlations),
        overall AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS rate FROM suffixes),
        suffix_rates AS (
            SELECT x.suffix, (bad + s.suffix * o.rate) / (n + s.suffix) AS rate
            FROM suffixes x, strengths s, overall o),
        domain_rates AS (
            SELECT d.domain, d.suffix, (bad + s.domain * x.rate) / (n + s.domain) AS rate
            FROM domains d JOIN suffix_rates x USING (suffix), strengths s),
        posteriors AS (
            SELECT h.host, bad + s.host * rate AS a, n - bad + s.host * (1 - rate) AS b
            FROM hosts h JOIN domain_rates USING (domain, suffix), strengths s),
        reputed AS (
            SELECT host, CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
                                   > 0.5 THEN 'block' ELSE 'allow' END AS verdict
            FROM posteriors),
        rules(rule, name, start, verdict) AS (
            VALUES ('org/', 'org', '/', 'allow'),
                   ('example.org/es/', 'example.org', '/es/', 'block'),
                   ('example.org/en/1', 'example.org', '/en/1', 'block'),
                   ('com/fr/', 'com', '/fr/', 'allow'),
                   ('com/de/', 'com', '/de/', 'block')),
        fitting AS (
            SELECT host, path, arg_max(rule, length(rule)) AS rule,
                   arg_max(verdict, length(rule)) AS verdict
            FROM (SELECT DISTINCT host, path FROM named) JOIN rules
              ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
            GROUP BY host, path)
        SELECT page_id, host, path, f.rule, coalesce(f.verdict, r.verdict) AS verdict
        FROM named JOIN reputed r USING (host) LEFT JOIN fitting f USING (host, path)""",
    "op3_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                             (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
        sized AS (
            SELECT *, length(regexp_replace(regexp_replace(regexp_replace(text,
                       '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)turn/>', '<\\\1turn/>', 'g'),
                       '<(\\*)/turn>', '<\\\1/turn>', 'g')) AS chars,
                   role IS DISTINCT FROM lag(role) OVER (
                       PARTITION BY conv_id ORDER BY turn, role, text) AS opens
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), ''
                                 ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                               FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars + CASE WHEN opens THEN length(role) + 14 ELSE 7 END)::BIGINT
                   AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op5_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare
            FROM documents),
        ranked AS (
            SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
                   first_value(doc_id) OVER best AS keep_id,
                   row_number() OVER best = 1 AS kept
            FROM d
            WINDOW best AS (PARTITION BY bare ORDER BY length(text) DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, kept, sha256(bare) AS text_sha256 FROM ranked""",
    "op9_warc": r"""
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
            FROM pages),
        r AS (SELECT *, octet_length(payload) >= 100
                        AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL AS revisit
              FROM p)
        SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN revisit THEN first_id END AS refers_to, true AS complete
        FROM r""",
    "op10_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE
                       WHEN len(words) = 1 THEN words
                       ELSE [words[i] || ' ' || words[i + 1]
                             for i in generate_series(1, len(words) - 1)] END) AS shingle
            FROM w WHERE len(words) > 0),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
            GROUP BY ALL),
        links AS (
            SELECT a, b FROM common c
            JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
            WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reached AS (
            SELECT doc_id AS node, doc_id AS id FROM documents
            UNION
            SELECT e.b, r.id FROM reached r JOIN edges e ON e.a = r.node),
        components AS (SELECT node, min(id) AS component_id FROM reached GROUP BY node)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents JOIN components ON node = doc_id LEFT JOIN sizes USING (doc_id)""",
    "op11_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   sha256(coalesce(role, '') || chr(0) || coalesce(text, '')) AS said, row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                       sha256(coalesce(role, '') || chr(0) || coalesce(text, ''))) - 1 AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        c AS (
            SELECT conv_id, xor(4294967295, list_reduce(
                       list_prepend(4294967295::BIGINT, list_transform(
                           string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                       lambda c, b: list_reduce(
                           list_prepend(xor(c, b), [0::BIGINT for _ in range(8)]),
                           lambda k, z: xor(k >> 1, (k & 1) * 3988292384)))) % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM t)),
        starts AS (
            SELECT c.conv_id, place, said, text FROM c
            JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place < h),
        steps AS (
            SELECT * FROM starts
            UNION ALL SELECT conv_id, place - h + coalesce(n, 0), said, text
            FROM t JOIN c USING (conv_id)
            LEFT JOIN (SELECT conv_id, count(*) AS n FROM starts GROUP BY conv_id) USING (conv_id)
            WHERE place >= h),
        named AS (
            SELECT conv_id, place, text, count(*) OVER (PARTITION BY conv_id) AS n,
                   sha256(string_agg(said, ',') OVER (PARTITION BY conv_id ORDER BY place)) AS node
            FROM steps),
        members AS (
            SELECT conv_id, place + 1 AS depth, node, length(text) AS chars, n = place + 1 AS ending,
                   lag(node, 1, '') OVER (PARTITION BY conv_id ORDER BY place) AS parent
            FROM named
            UNION ALL SELECT conv_id, 0, '', 0,
                             conv_id NOT IN (SELECT conv_id FROM steps), NULL FROM c),
        nodes AS (
            SELECT node, depth, any_value(parent) AS parent, any_value(chars) AS chars,
                   min(conv_id) AS conv_id, count(*) AS n_convs,
                   string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ending) AS ends
            FROM members GROUP BY node, depth),
        grown AS (
            SELECT u.*, p.conv_id AS parent_conv_id,
                   (SELECT count(*) FROM nodes k WHERE k.parent = u.node) AS n_children
            FROM nodes u LEFT JOIN nodes p ON p.node = u.parent),
        totals AS (
            SELECT m.node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
                   sum((n_convs - 1) * g.chars)::BIGINT AS saved_tokens
            FROM grown g JOIN members m ON m.conv_id = g.conv_id AND m.depth <= g.depth
            GROUP BY m.node)
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
               sha256(coalesce(ends, '')) AS ends_sha256
        FROM grown JOIN totals USING (node)""",
    "op12_centroids": rf"""
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: greatest(
                       least(floor(64 * e::DOUBLE), 134217728), -134217728)::BIGINT) AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding,
                lambda e: e IS NOT NULL AND isfinite(e))) = 64),
        c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, x AS c
            FROM v ORDER BY sha256('1:' || vec_id) LIMIT 16),{_round(0)},{_round(1)},{_round(2)},
        last AS (
            SELECT r, min([{_distance("x", "c")}, cluster]::BIGINT[]) AS best FROM v, c3 GROUP BY r)
        SELECT vec_id, cluster::INT AS cluster, best[1] AS distance,
               sum(best[1]) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
               sum(best[1]) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM last JOIN v USING (r) JOIN c3 ON cluster = best[2]""",
}
