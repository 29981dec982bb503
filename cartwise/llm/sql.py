"""The queries of this folder as SQL for DuckDB, where SQL can express them; naive on purpose."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d
), windows AS (SELECT doc_id, i, w[i:i + 19] AS win FROM places),
late AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER same AS first_doc,
        first_value(i) OVER (PARTITION BY win ORDER BY doc_id, i) AS first_i FROM windows WINDOW same AS (PARTITION BY win))
    WHERE (doc_id, i) <> (first_doc, first_i)
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM late),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
kept AS (
    SELECT doc_id, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (gone.pos IS NULL) AS text
    FROM words LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP3 = r"""
WITH raw AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM raw
), marked AS (
    SELECT *, role IS DISTINCT FROM lag(role) OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS first FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + CASE WHEN first
        THEN length('<turn >.</turn>.') + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))
        ELSE length('<next>') END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP5 = rf"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, len(w) AS n, w AS win FROM b WHERE len(w) BETWEEN 1 AND 12
    UNION ALL
    SELECT DISTINCT item_id, 13, w[i:i + 12] FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM b)
), sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes
), found AS (
    SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS win FROM places) p
    JOIN windows USING (n, win)
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY 1
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: Base 32 of a SHA-1: its 160 bits in groups of five.
BASE32 = """array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(
    list_transform(range(0, 5), lambda b: substr(bits, (5 * k + b + 1)::INTEGER, 1)::INTEGER * (16 >> b::INTEGER)))::INTEGER, 1)), '')"""

OP6 = rf"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS hex FROM pages
), b AS (
    SELECT page_id, size, hex, array_to_string(list_transform(string_split(hex, ''), lambda c:
        substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', c) - 1) + 1, 4)
    ), '') AS bits, max(page_id) OVER (PARTITION BY hex) AS last FROM p
)
SELECT page_id, size::BIGINT AS payload_bytes, {BASE32} AS payload_digest,
    CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> last THEN last END AS refers_to
FROM b
"""

OP7 = rf"""
WITH p AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
    SELECT DISTINCT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(verdict, length(rule_host || rule_path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM p) u JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fits USING (host, path)
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}')
        AS key FROM l
), hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hot.key IS NOT NULL) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot USING (key) GROUP BY doc_id
"""


def _op12(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [rf"""
kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, (k // (len(v) // {parts}))::BIGINT AS p, (k % (len(v) // {parts}))::BIGINT AS d, v[k + 1] AS x
    FROM (SELECT *, unnest(range(0, len(v))) AS k FROM kept)
), book0 AS MATERIALIZED (
    SELECT p, e, d, x FROM parts
    JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) USING (vec_id)
)"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
    SELECT vec_id, p, arg_min(e, (distance, e)) AS e, min(distance) AS distance FROM (
        SELECT vec_id, p, e, sum((parts.x - b.x) * (parts.x - b.x))::BIGINT AS distance
        FROM parts JOIN book{r} b USING (p, d) GROUP BY vec_id, p, e
    ) GROUP BY vec_id, p
)""")
        if r < rounds:
            steps.append(f"""moved{r} AS (
    SELECT p, e, d, (s - ((s % n) + n) % n) // n AS x FROM (
        SELECT p, e, d, sum(x)::BIGINT AS s, count(*) AS n FROM near{r} JOIN parts USING (vec_id, p) GROUP BY p, e, d)
), book{r + 1} AS MATERIALIZED (
    SELECT p, e, d, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN moved{r} m USING (p, e, d)
)""")
    return "WITH " + ", ".join(steps) + f""", coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(distance)::BIGINT AS error
    FROM kept JOIN near{rounds} USING (vec_id) GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, d)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


#: CRC-32 of the words, byte by byte from a table that is computed here.
OP13 = rf"""
WITH tab AS (
    SELECT list(list_reduce(range(0, 8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), b) ORDER BY b) AS t
    FROM range(0, 256) r(b)
), d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
    SELECT unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS word FROM benchmark
), places AS (SELECT doc_id, unnest(w) AS word FROM d),
hexes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM places UNION SELECT word FROM b)),
byte_lists AS (
    SELECT word, list_transform(range(0, length(h) // 2), lambda i:
        (16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1)
        + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1)::BIGINT) AS bytes FROM hexes
), buckets AS (
    SELECT word, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000
        AS bucket FROM byte_lists, tab
), s AS (SELECT bucket, count(*) AS s FROM places JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN buckets USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)
), sums AS (
    SELECT doc_id, sum(gain)::BIGINT AS total, count(*) AS n FROM places JOIN buckets USING (word) JOIN gains USING (bucket)
    GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
        substr(sha256('2024:' || d.doc_id), 1, 8) AS h
    FROM d LEFT JOIN sums USING (doc_id)
), noisy AS (
    SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((list_reduce(range(1, 9), lambda x, i:
        16 * x + instr('0123456789abcdef', substr(h, i, 1)) - 1, 0::BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM scored
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () * 10 // 100 AS drawn
    FROM noisy WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank
FROM noisy LEFT JOIN ranked USING (doc_id)
"""


def statements() -> dict[str, str]:
    return {
        "op2_substring_dedup": OP2, "op3_chat_formatting": OP3, "op5_benchmark_decontamination": OP5, "op6_warc": OP6,
        "op7_url_filters": OP7, "op9_line_dedup": OP9, "op12_vector_codes": _op12(), "op13_importance_resampling": OP13,
    }
