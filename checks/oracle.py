"""The same results in plain SQL over the same tables. Paths in it are those of scale factor 0.01."""

REVDOCS = """
    SELECT conv_id * 1000 + turn AS id,
           printf('2015-01-01T%02d:%02d:00Z', turn // 60, turn % 60) AS timestamp,
           conv_id AS page_id,
           'Conv & <' || conv_id || '>' AS page_title,
           conv_id % 2 AS page_namespace,
           CASE WHEN conv_id % 7 = 0 THEN 'To "' || conv_id || '"' END AS page_redirect,
           CASE WHEN conv_id % 5 = 0 THEN 'edit=sysop' ELSE '' END AS page_restrictions,
           CASE WHEN role <> 'system' THEN turn END AS user_id,
           role AS user_text,
           turn % 3 = 0 AS minor,
           CASE WHEN turn > 0 THEN ' c ' || turn END AS comment,
           CAST(strlen(text) AS BIGINT) AS bytes,
           text,
           sha1(text) AS sha1,
           CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS parent_id,
           'wikitext' AS model,
           'text/x-wiki' AS format
    FROM conversations
"""

METADATA = f"""
    SELECT DISTINCT * EXCLUDE (text, user_text) REPLACE (nullif(page_restrictions, '') AS page_restrictions),
           user_text AS user_user_text
    FROM ({REVDOCS})
"""

FLATTENED = f"SELECT *, CAST(NULL AS VARCHAR) AS malformed FROM ({REVDOCS})"

MANIFEST_LINES = """
    SELECT doc_id AS line_no,
           md5(text) || CASE WHEN doc_id % 17 = 2 THEN ' ' ELSE '  ' END
           || CASE WHEN doc_id % 13 = 5 THEN 'otherwiki' ELSE 'samplewiki' END || '-'
           || CASE WHEN doc_id % 11 = 3 THEN '20240101' ELSE '20240115' END || '-'
           || CASE WHEN doc_id % 24 = 0 THEN 'pages-articles-multistream'
                   WHEN doc_id % 4 = 0 THEN 'pages-articles' ELSE 'pages-meta-history' END
           || CASE WHEN doc_id % 50 < 10 THEN doc_id - doc_id % 10 ELSE doc_id END
           || CASE WHEN doc_id % 19 = 4 THEN '.xml.7z' WHEN doc_id % 23 = 6 THEN '-index.txt.bz2'
                   ELSE '.xml-p1.bz2' END AS line
    FROM documents
"""


def manifest(family: str, condition: str = "true") -> str:
    pattern = rf"(\w{{32}})  (samplewiki-20240115-{family}.*\.xml.*\.bz2)"
    return f"""
        SELECT max_by(md5, line_no) AS md5, filename
        FROM (SELECT line_no, regexp_extract(line, '{pattern}', 1) AS md5,
                     regexp_extract(line, '{pattern}', 2) AS filename
              FROM ({MANIFEST_LINES}))
        WHERE filename <> '' AND {condition}
        GROUP BY filename
    """


EXPECTED = """
    SELECT 'file-' || doc_id AS filename,
           CASE WHEN doc_id % 7 = 1 THEN md5(text || 'x') WHEN doc_id % 29 = 3 THEN NULL ELSE md5(text) END AS md5
    FROM documents WHERE doc_id % 10 <> 9
"""

FILES = """
    SELECT 'file-' || doc_id AS filename, CAST(strlen(text) AS BIGINT) AS length,
           CASE WHEN doc_id % 31 <> 8 THEN md5(text) END AS digest, sha1(text) AS sha1
    FROM documents WHERE doc_id % 5 <> 2
"""

STATUSES = f"""
    SELECT e.filename, e.md5,
           CASE WHEN f.filename IS NULL THEN 'ABSENT'
                WHEN f.digest IS NULL OR e.md5 IS NULL THEN 'ERROR'
                WHEN f.digest <> e.md5 THEN 'CORRUPT' ELSE 'PRESENT' END AS status
    FROM ({EXPECTED}) e LEFT JOIN ({FILES}) f ON e.filename = f.filename
"""

DAYS = """
    SELECT event_id,
           CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y%m%d')
                WHEN event_id % 41 = 1 THEN 'x' || made
                WHEN event_id % 43 = 2 THEN made || 'cd'
                WHEN event_id % 47 = 4 THEN made[1:4]
                WHEN event_id % 53 = 5 THEN NULL
                ELSE made END AS day
    FROM (SELECT event_id, ts, (2005 + event_id % 20) || printf('%02d%02d', event_id % 14, event_id % 33) AS made
          FROM events)
"""


def digests(algorithm: str) -> str:
    return f"""
        SELECT parse_filename(filename) AS filename, CAST(size AS BIGINT) AS length, '{algorithm}' AS algorithm,
               {algorithm}(content) AS digest
        FROM read_blob('/root/testdata/sf0.01/*.parquet')
    """


def verdicts(check: str, expected: str, actual: str) -> str:
    return f"""
        SELECT '{check}' AS "check", e.filename,
               CASE WHEN coalesce(e.expected, '') = '' OR f.actual IS NULL THEN 'ERROR'
                    WHEN e.expected = f.actual THEN 'OK' ELSE 'MISMATCH' END AS verdict
        FROM ({expected}) e
        LEFT JOIN (SELECT filename, CAST({actual} AS VARCHAR) AS actual FROM ({FILES})) f ON e.filename = f.filename
    """


ORACLE = {
    "metadata_load": METADATA,
    "metadata_projection": METADATA.replace("DISTINCT", ""),
    "empty_restrictions_null": """
        SELECT conv_id * 1000 + turn AS id, CAST(len(a) AS INTEGER) AS n_before,
               CASE WHEN len(a) = 0 THEN NULL ELSE a END IS NULL AS is_null,
               array_to_string(CASE WHEN len(a) = 0 THEN NULL ELSE a END, '|') AS restrictions
        FROM (SELECT *, CASE WHEN (conv_id * 1000 + turn) % 4 <> 3 THEN
                             CASE WHEN conv_id % 5 = 0 THEN ['edit=sysop'] ELSE [] END END AS a FROM conversations)
    """,
    "metadata_parquet_roundtrip": METADATA,
    "metadata_table_load": METADATA,
    "revdocs_json_roundtrip": REVDOCS,
    "revdocs_table": REVDOCS,
    "xml_flatten_page": FLATTENED,
    "xml_flatten_revision": FLATTENED,
    "page_order": """
        SELECT CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id END AS page_id, count(*) AS n, true AS contiguous,
               true AS sorted_in_files, true AS files_in_time_order,
               CASE WHEN conv_id % 3 = 0 THEN 0 ELSE conv_id END = 0 AS cut
        FROM conversations GROUP BY ALL
    """,
    "manifest_scan": manifest("pages-meta-history"),
    "dump_types": f"""
        SELECT 'history' AS dump_type, filename, md5 FROM ({manifest("pages-meta-history")})
        UNION ALL SELECT 'current', filename, md5 FROM ({manifest("pages-articles")})
        UNION ALL SELECT 'current_single_stream', filename, md5
        FROM ({manifest("pages-articles", "NOT contains(filename, '-multistream')")})
    """,
    "status_ready": """
        SELECT lang || 'wiki' AS wiki, source AS day FROM documents GROUP BY lang, source HAVING count(*) % 3 <> 0
    """,
    "file_inventory": """
        SELECT parse_filename(filename) AS filename, CAST(size AS BIGINT) AS length
        FROM read_blob('/root/testdata/sf0.01/*.parquet')
    """,
    "file_digest": digests("md5") + " UNION ALL " + digests("sha1"),
    "file_digest_chunked": digests("md5") + " UNION ALL " + digests("sha1"),
    "content_digest": """
        SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, CAST(strlen(text) AS BIGINT) AS length FROM documents
    """,
    "file_status": f"""
        SELECT true AS checked, *, CASE status WHEN 'PRESENT' THEN 0 WHEN 'ABSENT' THEN 1
                                               WHEN 'CORRUPT' THEN 2 ELSE 3 END AS code
        FROM ({STATUSES})
        UNION ALL
        SELECT false, e.filename, e.md5, CASE WHEN f.filename IS NULL THEN 'ABSENT' ELSE 'PRESENT' END,
               CASE WHEN f.filename IS NULL THEN 1 ELSE 0 END
        FROM ({EXPECTED}) e LEFT JOIN ({FILES}) f ON e.filename = f.filename
    """,
    "pending_files": f"SELECT * FROM ({STATUSES}) WHERE status <> 'PRESENT'",
    "unexpected_files": f"""
        SELECT filename, length FROM ({FILES}) WHERE filename NOT IN (SELECT filename FROM ({EXPECTED}))
    """,
    "unverified_files": f"SELECT filename, md5 FROM ({STATUSES}) WHERE status <> 'PRESENT'",
    "status_guard": f"""
        SELECT 'all' AS files, bool_or(status = 'ERROR') AS any_error FROM ({STATUSES})
        UNION ALL SELECT 'clean', bool_or(status = 'ERROR') FROM ({STATUSES}) WHERE status <> 'ERROR'
    """,
    "verify_files": f"""
        SELECT 'none' AS "check", filename, 'OK' AS verdict FROM ({EXPECTED})
        UNION ALL {verdicts("md5", f"SELECT filename, md5 AS expected FROM ({EXPECTED})", "digest")}
        UNION ALL {verdicts("sha1", f"SELECT filename, sha1(filename) AS expected FROM ({EXPECTED})", "sha1")}
        UNION ALL {verdicts(
            "size",
            "SELECT 'file-' || doc_id AS filename, CAST(strlen(text) AS VARCHAR) AS expected FROM documents",
            "length - length % 2",
        )}
    """,
    "valid_day": rf"""
        SELECT event_id, day, coalesce(lenient, false) AS valid,
               coalesce(lenient AND regexp_full_match(day, '\d{{8}}') AND try_strptime(day, '%Y%m%d') IS NOT NULL,
                        false) AS valid_strictly
        FROM (SELECT *, y > 2010 AND m BETWEEN 1 AND 12 AND d BETWEEN 1 AND 31
                        AND NOT (m = 2 AND d > 29) AND NOT (m IN (4, 6, 9, 11) AND d > 30) AS lenient
              FROM (SELECT *, TRY_CAST(regexp_extract(day, '(\d{{4}})(\d\d)(\d\d)', 1) AS INTEGER) AS y,
                           TRY_CAST(regexp_extract(day, '(\d{{4}})(\d\d)(\d\d)', 2) AS INTEGER) AS m,
                           TRY_CAST(regexp_extract(day, '(\d{{4}})(\d\d)(\d\d)', 3) AS INTEGER) AS d
                    FROM ({DAYS})))
    """,
    "dump_naming": """
        SELECT DISTINCT wiki, day, '/dumps/' || wiki || '-' || day AS path,
               '/dumps/' || wiki || '-' || day || '/xmlbz2' AS xml_path,
               '/dumps/' || wiki || '-' || day || '/jsonbz2' AS json_path,
               '/dumps/' || wiki || '-' || day || '/meta_parquet' AS metadata_path,
               wiki || '_' || day AS metadata_table, wiki || '_' || day || '_fulltext' AS fulltext_table
        FROM (SELECT event_type || 'wiki' AS wiki, strftime(ts, '%Y%m%d') AS day FROM events)
    """,
    "sql_step": """
        SELECT conv_id AS page_id, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS bytes, 'a=b; --c' AS label
        FROM conversations WHERE role = 'user' GROUP BY conv_id
    """,
    "guarded_write": """
        SELECT CAST(attempt AS INTEGER) AS attempt, CASE attempt WHEN 2 THEN 'skipped' ELSE 'written' END AS outcome,
               conv_id * 1000 + turn AS id,
               'attempt ' || CASE attempt WHEN 3 THEN 3 ELSE 1 END || ' of ' || (conv_id * 1000 + turn) AS comment
        FROM conversations, range(1, 4) r(attempt)
    """,
    "custom_converter": """
        SELECT conv_id * 1000 + turn AS id, conv_id AS page_id, CASE WHEN turn > 0 THEN 'C ' || turn END AS comment,
               text
        FROM conversations
    """,
    "full_run": METADATA,
    "full_run_with_strays": f"SELECT id, page_id, bytes, text, true AS strays_counted FROM ({REVDOCS})",
    "full_run_both_types": """
        SELECT 'history' AS dump_type, conv_id * 1000 + turn AS id, conv_id AS page_id, CAST(strlen(text) AS BIGINT) AS bytes
        FROM conversations
        UNION ALL
        SELECT 'current', conv_id * 1000 + turn, conv_id + 1000000, CAST(strlen(text) + 1 AS BIGINT) FROM conversations
    """,
    "missing_report": """
        SELECT 'samplewiki-20240115-pages-meta-history' || doc_id || '.xml-doc.bz2' AS filename, md5(text) AS md5,
               'ABSENT' AS status
        FROM documents
    """,
}
