"""The queries that SQL can express, for DuckDB."""

from palimpsest.llm import centroids, licenses, urls


def _clusters() -> str:
    """Rounds of assignment written out one after another."""
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, sha256('{centroids.SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h,
                list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = {centroids.SIZE}
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.SIZE}
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, vec_id NULLS LAST, v) - 1 AS c, v FROM kept
            ORDER BY h, vec_id NULLS LAST, v LIMIT {centroids.CENTROIDS}
        )""",
    ]
    for k in range(centroids.ROUNDS + 1):
        parts.append(
            f"""a{k} AS MATERIALIZED (
            SELECT r, any_value(vec_id) AS vec_id, any_value(kept.v) AS v, min({{'d': d, 'c': c}}) AS best
            FROM (
                SELECT r, vec_id, kept.v AS v, c,
                    list_sum(list_transform(list_zip(kept.v, c{k}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                FROM kept CROSS JOIN c{k}
            ) AS kept GROUP BY r
        )"""
        )
        if k < centroids.ROUNDS:
            parts.append(
                f"""m{k} AS (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
            FROM (
                SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n
                FROM (SELECT best.c AS c, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{k}) GROUP BY c, i
            ) GROUP BY c
        ), c{k + 1} AS MATERIALIZED (SELECT c{k}.c AS c, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} USING (c))"""
            )
    last = centroids.ROUNDS
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
            sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
            sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
        FROM a{last} JOIN c{last} ON best.c = c{last}.c"""


WORDS = r"""regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
    )"""

# crc32 of a number's decimal digits: a table for one byte, then a step per digit.
CRC_TABLE = """(SELECT list(list_reduce(range(8), lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1), n) ORDER BY n)
    FROM range(256) AS t(n))"""
CRC = """xor(list_reduce(
        list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda d: ascii(d)::BIGINT),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295
    ), 4294967295)"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{value}'" for value in row) + ")" for row in rows)


BASE_ORACLE = {  # Of the queries that hold some columns of an operator.
    "base_pii": r"""
        WITH found AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS emails,
                regexp_extract_all(coalesce(text, ''), '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ips,
                list_transform(
                    regexp_extract_all(coalesce(text, ''), '[0-9]([\x20-]?[0-9])+'), lambda m: regexp_replace(m, '[^0-9]', '', 'g')
                ) AS numbers,
                list_transform(
                    regexp_extract_all(coalesce(text, ''), '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: regexp_replace(m, '[^0-9]', '', 'g')
                ) AS phones
            FROM documents
        )
        SELECT doc_id, len(emails) AS n_email,
            len(list_filter(
                ips, lambda m: len(list_filter(string_split(m, '.'), lambda p: coalesce(try_cast(p AS BIGINT), 256) > 255)) = 0
            )) AS n_ip,
            len(list_filter(numbers, lambda m: length(m) BETWEEN 14 AND 19 AND list_sum(list_transform(
                range(length(m)),
                lambda k: if(
                    k % 2 = 0, m[length(m) - k]::INTEGER,
                    m[length(m) - k]::INTEGER * 2 - if(m[length(m) - k]::INTEGER > 4, 9, 0)
                )
            )) % 10 = 0)) AS n_card,
            len(list_filter(phones, lambda m: length(m) BETWEEN 10 AND 15)) AS n_phone
        FROM found
    """,
    "base_licenses": f"""
        WITH phrases AS (
            SELECT string_split(phrase, ' ') AS ps, label FROM (VALUES {_values(licenses.BASE_PHRASES.items())}) AS t(phrase, label)
        ), docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents
        ), places AS (
            SELECT r, i - 1 AS place, label FROM phrases, docs, unnest(range(1, len(ws) - len(ps) + 2)) AS t(i)
            WHERE ws[i] = ps[1] AND ws[i : i + len(ps) - 1] = ps
        ), found AS (
            SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
            FROM places GROUP BY r
        )
        SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels
        FROM docs LEFT JOIN found USING (r)
    """,
    "base_quality": r"""
        WITH docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ), grams AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS times FROM (
                SELECT r, i, array_to_string(ws[i : i + 4], ' ') AS gram FROM docs, unnest(range(1, len(ws) - 3)) AS t(i)
            )
        ), repeated AS (
            SELECT r, count(DISTINCT i + j) AS n FROM grams, range(5) AS s(j) WHERE times > 1 GROUP BY r
        ), lines AS (
            SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
        ), counts AS (
            SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
                coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
            FROM docs LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
        )
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
    """,
    "base_urls": rf"""
        WITH cut AS (
            SELECT row_number() OVER () AS r, page_id,
                CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS MATERIALIZED (
            SELECT r, page_id, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM cut
        ), rules(verdict, name, start) AS (VALUES {_values(urls.RULES)}), fits AS (
            SELECT r, max_by(name || start, length(name || start)) AS rule, max_by(rules.verdict, length(name || start)) AS verdict
            FROM parts JOIN rules ON (host = name OR suffix(host, '.' || name)) AND starts_with(path, start) GROUP BY r
        )
        SELECT page_id, host, path, rule, verdict FROM parts LEFT JOIN fits USING (r)
    """,
    "base_scores": rf"""
        WITH docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, {CRC} % 5 = 1 AND doc_id IS NOT NULL AS held_out,
                list_append(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
                ), ' ') AS ws
            FROM documents, (SELECT {CRC_TABLE} AS crcs)
        ), tokens AS MATERIALIZED (
            SELECT r, held_out, w, count(*) AS k FROM (SELECT r, held_out, unnest(ws) AS w FROM docs) GROUP BY ALL
        ), counts AS MATERIALIZED (
            SELECT w, sum(k)::BIGINT AS c FROM tokens WHERE NOT held_out GROUP BY w
        ), totals AS (
            SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM counts
        ), sums AS (
            SELECT r, sum(k)::BIGINT AS n_tokens, coalesce(sum(k) FILTER (c > 0), 0)::BIGINT AS n_known,
                sum(k * log10((coalesce(c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (v + 1)))) AS s
            FROM tokens LEFT JOIN counts USING (w), totals GROUP BY r
        )
        SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, round(s, 3) AS base_score
        FROM docs JOIN sums USING (r), totals
    """,
}

ORACLE = {  # Of whole results.
    "op2_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
            FROM documents
        ), ranked AS (
            SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                first_value(doc_id) OVER (
                    PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING
                ) AS keep_id
            FROM texts
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
    """,
    "op7_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), groups AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM response THEN response END AS refers_to,
            true AS intact
        FROM groups
    """,
    "op11_centroids": _clusters(),
    "op12_decontaminate": f"""
        WITH items AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item, {WORDS} AS ws FROM benchmark
        ), windows AS (
            SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS gram
            FROM items, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS t(i) WHERE len(ws) > 0
        ), docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents
        ), hits AS (
            SELECT DISTINCT r, i, n, item FROM (
                SELECT r, i, s.n AS n, array_to_string(ws[i : i + s.n - 1], ' ') AS gram
                FROM docs, (SELECT DISTINCT n FROM windows) AS s, unnest(range(1, len(ws) - s.n + 2)) AS t(i)
            ) JOIN windows USING (n, gram)
        ), hit_words AS (
            SELECT r, count(DISTINCT w) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(w) GROUP BY r
        ), hit_items AS (
            SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r
        )
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
    """,
}
