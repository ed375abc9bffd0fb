"""DuckDB SQL for the rows of the operators that SQL can express."""

from __future__ import annotations

from ionweave.llm import lexical_search, line_dedup, spelling

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')"

OP11 = f"""
WITH doc AS (
    SELECT row_number() OVER () AS d, doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS terms FROM documents
), item AS (
    SELECT row_number() OVER () AS i, item_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS terms FROM benchmark
), size AS (
    SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM doc WHERE len(terms) > 0
), posting AS (
    SELECT d, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT d, doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM doc) GROUP BY ALL
), weight AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM posting, size GROUP BY term, docs
), asked AS (
    SELECT DISTINCT i, item_id, unnest(terms) AS term FROM item
), scored AS (
    SELECT i, item_id, d, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::BIGINT AS score
    FROM asked JOIN weight USING (term) JOIN posting USING (term), size
    GROUP BY i, item_id, d, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {lexical_search.TOP}
"""

_KEY = _LOWER.format(r"trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")

OP12 = f"""
WITH doc AS (
    SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT d, doc_id, line, pos, {_KEY} AS key
    FROM (SELECT d, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM doc)
), repeated AS (
    SELECT key, max(doc_id) AS last FROM line WHERE length(key) >= {line_dedup.SHORTEST}
    GROUP BY key HAVING count(DISTINCT d) >= {line_dedup.LEAST}
), marked AS (
    SELECT line.*, repeated.key IS NOT NULL AND doc_id IS DISTINCT FROM last AS gone FROM line LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY d, doc_id
"""

OP13 = f"""
WITH RECURSIVE crc AS (  -- the table of the usual CRC-32, from its polynomial
    SELECT list(c ORDER BY b) AS crcs FROM (
        SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
        FROM range(256) AS t(b)
    )
), run AS (
    SELECT doc_id, r, count(*) AS k FROM (
        SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS r FROM documents
    ) WHERE length(r) >= {spelling.SHORTEST} GROUP BY ALL
), coded AS (
    SELECT r, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || r)) AS x FROM run
), hashed AS (
    SELECT r, k, xor(4294967295, list_reduce(
        list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295)) AS h
    FROM coded, crc
), word AS (
    SELECT word, sum(k)::BIGINT AS n FROM (
        SELECT k, CASE WHEN h % {spelling.DELETE_EACH} = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word FROM hashed
    ) WHERE length(word) >= {spelling.SHORTEST} GROUP BY word HAVING sum(k) >= {spelling.LEAST}
), less AS (
    SELECT word, n, pos, word[:pos - 1] || word[pos + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM word)
), near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
    UNION SELECT l.word, w.word, w.n FROM less l JOIN word w ON l.rest = w.word
    UNION SELECT w.word, l.word, l.n FROM less l JOIN word w ON l.rest = w.word
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM near GROUP BY word
), form AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN near_n >= {spelling.TIMES} * n THEN near END AS form, CASE WHEN near_n >= {spelling.TIMES} * n THEN near_n END AS form_n
    FROM word LEFT JOIN best USING (word)
), step AS (
    SELECT word, word AS root FROM form
    UNION ALL SELECT step.word, form.form FROM step JOIN form ON step.root = form.word WHERE form.form IS NOT NULL
)
SELECT form.word, form.form, step.root, form.n, form.n_near, form.form_n
FROM form JOIN step USING (word) JOIN form f ON step.root = f.word WHERE f.form IS NULL
"""
