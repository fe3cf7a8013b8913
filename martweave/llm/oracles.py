"""SQL for the operators that SQL can say only at length: product codes, conversation repair, set join."""

from __future__ import annotations


def _codes_sql(rounds: int = 6) -> str:
    """Every round is one more pair of tables: assignments to the last codebook, and the codebook they give."""
    nearest = """
a{n} AS MATERIALIZED (
    SELECT r, part, min({{'far': far, 'entry': entry}}) AS best
    FROM (
        SELECT p.r, p.part, b.entry,
            list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
        FROM p JOIN b{n} b ON b.part = p.part
    ) GROUP BY r, part
)"""
    means = """
s{n} AS MATERIALIZED (
    SELECT part, entry, pos, sum(x)::BIGINT AS total, count(*) AS n
    FROM (SELECT p.part, a.best.entry AS entry, unnest(p.v) AS x, unnest(range(1, len(p.v) + 1)) AS pos FROM p JOIN a{n} a ON a.r = p.r AND a.part = p.part)
    GROUP BY part, entry, pos
),
b{m} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(f.v, b.v) AS v
    FROM b{n} b LEFT JOIN (
        SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY pos) AS v FROM s{n} GROUP BY part, entry
    ) f ON f.part = b.part AND f.entry = b.entry
)"""
    steps = [nearest.format(n=0)]
    for n in range(rounds):
        steps += [means.format(n=n, m=n + 1), nearest.format(n=n + 1)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
        list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS MATERIALIZED (
    SELECT r, part, v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)] AS v FROM kept, (SELECT unnest(range(8)) AS part)
),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM p WHERE r <= 16),
{",".join(steps)},
coded AS (
    SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.far)::BIGINT AS error FROM a{rounds} GROUP BY r
),
books AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


CODES_SQL = _codes_sql()

_BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: CRC-32 of a text, bit by bit.
_CRC = """xor(list_reduce(list_transform(range(1, len({key}) + 1), lambda i: ascii(substr({key}, i, 1))::BIGINT),
    lambda c, byte: list_reduce([xor(c, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)),
    4294967295::BIGINT), 4294967295::BIGINT)"""

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a. Between two rows at most three insertions pay; one step of the recursion is one of
# those or the edit of a row, and only the best way into each (place, state) goes on.
REPAIR_SQL = rf"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
),
fate AS (SELECT *, {_CRC.format(key="key")} % 20 AS fate FROM given),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE fate WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS time
    FROM fate
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, {_BLANK}) AS body FROM damaged
),
marked AS MATERIALIZED (
    SELECT conv_id, i, turn, role, text, left(role, 1) AS initial,
        CASE WHEN body = '' THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
            WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
),
sizes AS MATERIALIZED (SELECT conv_id, max(i) AS n FROM marked GROUP BY conv_id),
walk AS (
    SELECT conv_id, 1::BIGINT AS i, 0 AS put, 0 AS s, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM sizes
    UNION ALL
    SELECT conv_id, i, put, s, min(best) AS best FROM (
        -- Insert, up to three times in one place.
        SELECT conv_id, i, put + 1 AS put, CASE s WHEN 2 THEN 3 ELSE 2 END AS s,
            {{'cost': best.cost + 2, 'audit': best.audit || 'I', 'lines': list_append(best.lines, CASE s WHEN 2 THEN 'assistant:' ELSE 'user:' END)}} AS best
        FROM walk WHERE put < 3
        UNION ALL
        -- No more insertions in this place.
        SELECT conv_id, i, 3 + 1 AS put, s, best FROM walk WHERE put = 3
        UNION ALL
        SELECT conv_id, i, put + 1, s, best FROM walk WHERE put < 3
        UNION ALL
        SELECT w.conv_id, w.i + 1, 0 AS put, w.s, {{'cost': best.cost + 3, 'audit': best.audit || 'D', 'lines': best.lines}}
        FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i WHERE w.put = 4
        UNION ALL
        SELECT w.conv_id, w.i + 1, 0, CASE w.s WHEN 2 THEN 3 ELSE 2 END,
            {{'cost': best.cost + 2 + (fault = 'truncated')::BIGINT, 'audit': best.audit || 'R',
            'lines': list_append(best.lines, CASE w.s WHEN 2 THEN 'assistant:' ELSE 'user:' END || text)}}
        FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i WHERE w.put = 4 AND fault IN ('', 'truncated')
        UNION ALL
        SELECT w.conv_id, w.i + 1, 0, CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END,
            {{'cost': best.cost + (fault = 'truncated')::BIGINT, 'audit': best.audit || 'K', 'lines': list_append(best.lines, role || ':' || text)}}
        FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i
        WHERE w.put = 4 AND fault IN ('', 'truncated')
            AND (w.s = 0 AND initial IN ('s', 'u') OR w.s = 1 AND initial = 'u' OR w.s = 2 AND initial = 'a' OR w.s = 3 AND initial = 'u')
    ) GROUP BY conv_id, i, put, s
),
cheapest AS (
    SELECT w.conv_id, min(best) AS best FROM walk w JOIN sizes z ON z.conv_id IS NOT DISTINCT FROM w.conv_id
    WHERE w.i = z.n + 1 AND w.put = 4 AND w.s IN (0, 3) GROUP BY w.conv_id
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM marked) GROUP BY conv_id
),
originals AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
    sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM originals o
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN cheapest c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
"""

# Sets by inverted lists, components by spreading along links between different sets.
SET_JOIN_SQL = r"""
WITH RECURSIVE w AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
d AS MATERIALIZED (
    SELECT r, doc_id, list_sort(list_distinct(list_transform(
        range(1, CASE WHEN len(words) = 0 THEN 1 ELSE greatest(len(words) - 3, 1) + 1 END), lambda p: array_to_string(words[p : p + 3], ' ')))) AS grams
    FROM w
),
sets AS MATERIALIZED (SELECT min(r) AS s, grams FROM d WHERE len(grams) > 0 GROUP BY grams),
member AS MATERIALIZED (SELECT s, len(grams) AS n, unnest(grams) AS gram FROM sets),
linked AS MATERIALIZED (
    SELECT a.s AS a, b.s AS b FROM member a JOIN member b ON a.gram = b.gram AND a.s <> b.s AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.s, a.n, b.s, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach AS (SELECT s AS a, s AS b FROM sets UNION SELECT reach.a, linked.b FROM reach JOIN linked ON linked.a = reach.b),
component AS (SELECT a, min(b) AS label FROM reach GROUP BY a),
named AS (
    SELECT d.doc_id, len(d.grams)::BIGINT AS n_shingles, coalesce(c.label, -d.r) AS label
    FROM d LEFT JOIN sets ON sets.grams = d.grams LEFT JOIN component c ON c.a = sets.s
)
SELECT doc_id, n_shingles, min(doc_id) OVER (PARTITION BY label) AS component_id FROM named
"""
