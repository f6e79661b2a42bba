"""DuckDB texts of the queries that SQL can express."""

from __future__ import annotations

from truant.llm import decontaminate, iblt, url_filter

_WORDS = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"

OP1 = rf"""
WITH items AS (
  SELECT item_id, w, least(len(w), {decontaminate.SHINGLE}) AS n FROM (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL)
  WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM item_shingles GROUP BY item_id),
docs AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents WHERE doc_id IS NOT NULL),
doc_shingles AS (
  SELECT DISTINCT doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM items)))
SELECT doc_id, item_id, item_shingles, count(*) AS found, count(*) / item_shingles AS containment
FROM doc_shingles JOIN item_shingles USING (n, s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, item_shingles
HAVING count(*) >= {decontaminate.THRESHOLD} * item_shingles - 1e-9
"""


def url_sql(rules: list[tuple[str, str]]) -> str:
    """The whole of url_filter.verdicts, its levels written out."""
    u = url_filter
    rule = verdict = "NULL"
    for v, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{v}' ELSE {verdict} END"
    out = f"""
WITH raw AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM raw),
parsed AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosts),
ruled AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled FROM parsed),
labelled AS (
  SELECT *, CASE WHEN ruled IS NOT NULL THEN (ruled = 'block')::INT END AS bad, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM ruled),
level0 AS (
  SELECT page_id, host, path, rule, ruled, bad, '' AS template, '' AS parent,
         parts AS segments FROM labelled),"""
    for d in range(u.DEPTH):  # the tables' paths have no more segments
        out += f"""
counts{d} AS (
  SELECT host, template, segments[{d + 1}] AS segment, count(*) AS n FROM level{d} WHERE len(segments) > {d} GROUP BY ALL),
literal{d} AS (
  SELECT host, template, segment FROM counts{d} WHERE n >= {u.MIN_ROWS}),
level{d + 1} AS (
  SELECT page_id, l.host, path, rule, ruled, bad, segments,
         CASE WHEN len(segments) > {d} THEN l.template ELSE parent END AS parent,
         CASE WHEN len(segments) > {d} THEN l.template || '/' || CASE WHEN t.segment IS NOT NULL THEN segments[{d + 1}]
              ELSE '*' || regexp_extract(segments[{d + 1}], '\\.({u.ENDINGS})$') END ELSE l.template END AS template
  FROM level{d} l LEFT JOIN literal{d} t ON l.host = t.host AND l.template = t.template AND l.segments[{d + 1}] = t.segment),"""
    rounds = ""
    for r in range(u.ROUNDS + 1):
        side = "CASE WHEN share < others THEN 'p' ELSE 'w' END" if r < u.ROUNDS else "'/' || template"
        rounds += f"""
pool{r} AS (
  SELECT *, sum(labels) OVER b AS all_labels, sum(bads) OVER b AS all_bads, count(*) OVER b AS members FROM round{r} WINDOW b AS (PARTITION BY host, parent, branch)),
share{r} AS (
  SELECT *, (bads + 1) / (labels + 2) AS share, (all_bads - bads + 1) / (all_labels - labels + 2) AS others, (all_bads + 1) / (all_labels + 2) AS pool FROM pool{r}),
round{r + 1} AS (
  SELECT host, parent, template, n, labels, bads, shape_purity,
         CASE WHEN members > 1 AND all_labels > labels THEN branch || CASE
           WHEN power(share - others, 2) / (pool * (1 - pool) * (1 / labels + 1 / (all_labels - labels))) > {u.DIFFERS} THEN {side} ELSE 's' END
         ELSE branch END AS branch
  FROM share{r}),"""
    return out + f"""
own AS (
  SELECT host, parent, template, count(*) AS n, count(bad) AS labels, coalesce(sum(bad), 0) AS bads FROM level{u.DEPTH} GROUP BY ALL),
prior AS (SELECT (coalesce(sum(bads), 0) + 1) / (coalesce(sum(labels), 0) + 2) AS p FROM own),
shapes AS (SELECT template, (sum(bads) + {u.WEIGHT} * any_value(p)) / (sum(labels) + {u.WEIGHT}) AS shape_purity FROM own, prior GROUP BY template),
round0 AS (SELECT *, CASE WHEN labels >= {u.MIN_LABELS} THEN '' ELSE '/' || template END AS branch FROM own JOIN shapes USING (template)),{rounds}
judged AS (
  SELECT host, parent, template,
         (sum(bads) OVER b + {u.WEIGHT} * (sum(shape_purity * n) OVER b / sum(n) OVER b)) / (sum(labels) OVER b + {u.WEIGHT}) AS purity
  FROM round{u.ROUNDS + 1} WINDOW b AS (PARTITION BY host, parent, branch))
SELECT page_id, l.host, path, rule, coalesce(ruled, CASE WHEN purity >= {u.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
       l.template, round(purity, 6) AS purity
FROM level{u.DEPTH} l JOIN judged j ON l.host = j.host AND l.parent = j.parent AND l.template = j.template
"""


def _base32(sha: str) -> str:
    digits = []
    for i in range(1, 41, 10):
        number = f"('0x' || substr({sha}, {i}, 10))::BIGINT"
        digits += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({number} >> {shift}) & 31)::INT + 1, 1)" for shift in range(35, -1, -5)]
    return " || ".join(digits)


OP5 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_base32('sha1(html)')} AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
"""

OP7 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT doc_id, i, line, owner IS NOT NULL AND owner <> doc_id AS lost FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


_TERMS = r"list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_PARAGRAPHS = iblt.PARAGRAPHS.replace("{", "{{").replace("}", "}}")
_DIGESTS = rf"list_distinct(list_transform(regexp_extract_all({{}}, '{_PARAGRAPHS}'), lambda x: ('0x' || substr(md5(x), 1, {iblt.BITS // 4}))::BIGINT))"

OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_TERMS.format('text')} AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
held AS (SELECT * FROM docs WHERE len(w) > 0),
whole AS (SELECT count(*) AS total_docs, sum(len(w))::BIGINT AS total_terms FROM held),
query_terms AS (
  SELECT item_id, item_text, t, count(*) AS repeats FROM (
    SELECT item_id, text AS item_text, unnest({_TERMS.format('text')}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL))
  GROUP BY ALL),
postings AS (
  SELECT row_no, doc_id, n, t, count(*) AS tf FROM (SELECT row_no, doc_id, len(w) AS n, unnest(w) AS t FROM held)
  WHERE t IN (SELECT t FROM query_terms) GROUP BY ALL),
weights AS (
  SELECT t, floor(1000 * ln((2 * total_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM postings GROUP BY t), whole),
impacts AS (
  SELECT row_no, doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * total_docs) // total_terms)) AS impact FROM postings, whole),
scored AS (
  SELECT item_id, item_text, row_no, doc_id, sum(w * repeats * impact)::BIGINT AS score
  FROM query_terms JOIN weights USING (t) JOIN impacts USING (t) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id, item_text ORDER BY score DESC, doc_id))::INT AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""

OP12 = f"""
WITH docs AS (
  SELECT row_number() OVER (ORDER BY doc_id DESC, coalesce(text, '')) AS nth, doc_id, coalesce(text, '') AS text FROM documents WHERE doc_id IS NOT NULL),
ring AS (
  SELECT d.nth, d.doc_id, d.text, n.text AS next_text, len(d.text) AS n_chars, len(d.text) // 2 AS half
  FROM docs d JOIN docs n ON n.nth = d.nth % (SELECT count(*) FROM docs) + 1),
versions AS (
  SELECT nth, doc_id, n_chars, text, next_text, substr(text, 1, n_chars - half) || substr(next_text, 1, half) AS edited FROM ring),
digested AS (
  SELECT *, {_DIGESTS.format('text')} AS own, {_DIGESTS.format('edited')} AS edited_own, {_DIGESTS.format('next_text')} AS next_own FROM versions),
placed AS (
  SELECT nth, side, k, (k % {iblt.CHECK_PRIME})::BIGINT AS c, r * {iblt.WIDTH} + ((k >> (10 * r)) & {iblt.WIDTH - 1}) AS cell
  FROM (SELECT nth, 0 AS side, unnest(own) AS k FROM digested UNION ALL SELECT nth, 1, unnest(edited_own) FROM digested), (SELECT unnest(range(3)) AS r)),
cells AS (SELECT nth, side, cell, count(*) AS n, bit_xor(k) AS k, bit_xor(c) AS c FROM placed GROUP BY ALL),
grid AS (
  SELECT nth, side, cell, coalesce(n, 0) AS n, coalesce(k, 0) AS k, coalesce(c, 0) AS c
  FROM (SELECT nth, side, cell FROM docs, (SELECT unnest(range(2)) AS side), (SELECT unnest(range({3 * iblt.WIDTH})) AS cell)) LEFT JOIN cells USING (nth, side, cell)),
sketches AS (SELECT nth, side, string_agg(n || ':' || printf('%X', k) || ':' || printf('%X', c), ' ' ORDER BY cell) AS fingerprint FROM grid GROUP BY ALL)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, a.fingerprint, b.fingerprint AS edited_fingerprint,
       CASE WHEN len(own) + len(edited_own) = 0 THEN 1.0 ELSE 2 * len(list_intersect(own, edited_own))::DOUBLE / (len(own) + len(edited_own)) END AS near_edited,
       CASE WHEN len(own) + len(next_own) = 0 THEN 1.0 ELSE 2 * len(list_intersect(own, next_own))::DOUBLE / (len(own) + len(next_own)) END AS near_next,
       len(own)::INT AS paragraphs
FROM digested JOIN sketches a ON a.nth = digested.nth AND a.side = 0 JOIN sketches b ON b.nth = digested.nth AND b.side = 1
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
grams AS (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM split, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size),
phrases AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM phrases WHERE size >= 2),
kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates l WHERE l.lang = c.lang AND l.size > c.size AND 100 * l.a >= 100 * c.a AND contains(' ' || l.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest FROM kept, (SELECT unnest(range(1, 5)) AS k) WHERE k < size),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = c.head JOIN phrases y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored) WHERE nth = 1)
SELECT lang, rank, phrase, size::INT AS words, a, l, r, n, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::INT AS rank FROM least)
WHERE rank <= 2000
"""
