"""SQL for the queries that SQL can express, run by DuckDB on the same tables."""

from __future__ import annotations

from tidewright.llm.feistel import KEYS, MULTIPLIER, PRIME


def _rounds() -> str:
    inner = "SELECT doc_id, n, a, b, step, x // b AS l, x % b AS r FROM walk JOIN side ON true WHERE step = 0 OR x >= n"
    for i, key in enumerate(KEYS):
        mixed = f"((r * {MULTIPLIER} + {key}) % {PRIME})"
        side = "b" if i % 2 else "a"
        inner = (f"SELECT doc_id, n, a, b, step, r AS l, (l + {mixed} * {mixed} % {PRIME}) % {side} AS r"
                 f" FROM ({inner})")
    return f"SELECT doc_id, step + 1, l * b + r FROM ({inner})"


# Fixed values of the CRC-32 polynomial, by nibble.
_CRC_TABLE = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,"
    " 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)
_CRC = f"""
    CASE WHEN coalesce(text, '') = '' THEN 0::BIGINT ELSE xor(4294967295::BIGINT, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(0, 2 * octet_length(encode(text))),
            lambda i: (instr('0123456789ABCDEF', nibbles[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END]) - 1)::BIGINT)),
        lambda c, d: xor(c >> 4, ({_CRC_TABLE}::BIGINT[])[(xor(c, d) & 15) + 1]))) END"""

ORACLES = {
    "op3_feistel_shards": f"""
        WITH RECURSIVE side AS (
            SELECT n, a, greatest(1, (n + a - 1) // a) AS b
            FROM (SELECT n, CASE WHEN n = 0 THEN 1 ELSE floor(sqrt(n - 1))::BIGINT + 1 END AS a
                  FROM (SELECT count(*) AS n FROM documents))
        ),
        walk(doc_id, step, x) AS (
            SELECT doc_id, 0, row_number() OVER (ORDER BY doc_id) - 1 FROM documents
            UNION ALL
            {_rounds()}
        ),
        place AS (SELECT doc_id, arg_max(x, step) AS p FROM walk GROUP BY doc_id)
        SELECT doc_id, (coalesce(octet_length(encode(text)), 0) + 8)::BIGINT AS size,
               {_CRC} AS text_crc32, 'rows' AS law,
               (p % 24)::INTEGER AS shard, p // 24 AS slot, NULL::INTEGER AS grown_shard
        FROM (SELECT *, string_split(hex(encode(coalesce(text, ''))), '') AS nibbles FROM documents)
        JOIN place USING (doc_id)
    """,
    "op5_lsh_forest_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0b\f\r]+'),
                                       lambda w: w <> '') AS w FROM documents
        ),
        gram AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            END) AS g FROM worded
        ),
        size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
            FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        link AS (
            SELECT x, y, k = s.n AND k = t.n AS equal
            FROM common JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y
            WHERE 5 * k >= 4 * (s.n + t.n - k)
        ),
        reach(doc_id, root) AS (
            SELECT x, x FROM link UNION SELECT y, y FROM link
            UNION
            SELECT link.y, reach.root FROM reach JOIN link ON link.x = reach.doc_id WHERE reach.root < link.y
        ),
        class AS (SELECT doc_id, min(root) AS class_id FROM reach GROUP BY doc_id),
        key AS (SELECT doc_id, min(least(x, y)) AS k FROM (
            SELECT x AS doc_id, x, y FROM link WHERE equal) GROUP BY doc_id),
        number AS (
            SELECT x AS doc_id, count(*) AS n_links,
                   count(DISTINCT CASE WHEN NOT equal THEN coalesce(key.k, y) END) AS n_classes
            FROM link LEFT JOIN key ON key.doc_id = y GROUP BY x
        )
        SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_links, 0) AS n_links,
               coalesce(n_classes, 0) AS n_classes
        FROM documents d LEFT JOIN class USING (doc_id) LEFT JOIN number USING (doc_id)
    """,
    "op7_warc_salvage": """
        WITH page AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h
            FROM pages
        ),
        owned AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS owner FROM page),
        bits AS (
            SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
                right(bin(16 + instr('0123456789abcdef', h[i]) - 1), 4)), '') AS b FROM owned
        )
        SELECT page_id, n::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ('0b' || substr(b, 5 * i + 1, 5))::INTEGER, 1)), '') AS payload_digest,
               CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> owner THEN owner END AS refers_to
        FROM bits
    """,
    "op8_threshold_top_k": """
        WITH vector AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(c::DOUBLE * 1024)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ),
        scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(range(1, len(c.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
            FROM vector q JOIN vector c ON q.r <> c.r WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    "op12_bayes_dedup": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'),
                lambda w: w <> '') AS w FROM documents
        ),
        shingle AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            END) AS g FROM worded
        ),
        size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
        link AS (
            SELECT x, y FROM (
                SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
                FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL)
            JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y
            WHERE 100 * k >= 85 * (s.n + t.n - k)
        ),
        reach(doc_id, root) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT link.y, reach.root FROM reach JOIN link ON link.x = reach.doc_id
            WHERE reach.root < link.y
        ),
        least AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN least USING (doc_id) LEFT JOIN size USING (doc_id)
    """,
}
