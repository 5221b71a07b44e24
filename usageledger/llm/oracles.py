"""SQL for the queries that SQL can express; the others are held against plain versions in tests."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = {
    "op3_minhash_components": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, list_distinct(CASE
                WHEN len(w) = 0 THEN []::VARCHAR[]
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words
        ), entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS u, b.doc_id AS v
            FROM entries a JOIN entries b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reach(u, v) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
        ), smallest AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u)
        SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN smallest ON doc_id = u
    """,
    "op5_warc_round_trip": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), firsts AS (
            SELECT payload_digest AS d, max(page_id) AS f FROM payloads WHERE payload_bytes >= 1000 GROUP BY 1
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f <> page_id THEN f END AS refers_to
        FROM payloads LEFT JOIN firsts ON payload_digest = d
    """,
    "op6_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents
        ), keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS k FROM lines),
        common AS (
            SELECT k, max(doc_id) AS stays FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
        ), marked AS (
            SELECT doc_id, line, pos, coalesce(doc_id <> stays, false) AS gone FROM keyed LEFT JOIN common USING (k)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op9_exact_top_k": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_fill_in_middle": r"""
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS x, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
        ), drawn AS (
            SELECT *, CASE WHEN x = '' THEN []::VARCHAR[] ELSE regexp_extract_all(x, '[^\n]*\n|[^\n]+') END AS l,
                   ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4
            FROM hashed
        ), placed AS (
            SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS c1, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS c2,
                   CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT *, array_to_string(l[1:c1], '') AS p, array_to_string(l[c1 + 1:c2], '') AS m, array_to_string(l[c2 + 1:], '') AS s FROM placed
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(p || m || s) AS restored_sha256
        FROM parts
    """,
    "op13_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), windows AS (
            SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM split)
        ), firsts AS (SELECT g, min(doc_id) AS f FROM windows GROUP BY g),
        covered AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM windows JOIN firsts USING (g) WHERE doc_id > f
        ), words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM split),
        kept AS (
            SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS t
            FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)
    """,
}
