"""DuckDB SQL for the queries that SQL can express whole; the others are tested against brute force."""

from __future__ import annotations

import math

from arenaspark.llm.licenses import PHRASES, TEMPLATES, THRESHOLD, _tokens, block_size

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def licenses_sql() -> str:
    templates = ", ".join(
        f"('{label}', {block_size(t)}, {_list(_tokens(t))}, {len(_tokens(t))}, {math.ceil(THRESHOLD * len(_tokens(t)) - 1e-9)})" for label, t in TEMPLATES)
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    places, labels = [], []
    for phrase, label in PHRASES:
        hit = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(phrase.split()))
        places.append(f"list_filter(range(1, len(w) + 1), lambda i: {hit}) AS at_{label}")
        labels.append(f"CASE WHEN len(at_{label}) > 0 THEN '{label}' END")
    every = " || ".join(f"at_{label}" for _, label in PHRASES)
    return f"""
WITH folded AS (SELECT doc_id, translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
worded AS (SELECT doc_id, regexp_extract_all(t, {word}) AS w FROM folded),
placed AS (SELECT doc_id, w, {", ".join(places)} FROM worded),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, {every} AS places,
                list_filter([{", ".join(labels)}], lambda x: x IS NOT NULL) AS own FROM placed),
templates AS (SELECT * FROM (VALUES {templates}) x(label, size, tokens, n, alpha)),
starts AS (SELECT doc_id, w, size, unnest(range(0, greatest(0, len(w) - size - 1) + 1, size)) AS s
           FROM worded, (SELECT DISTINCT size FROM templates) WHERE len(w) > 0),
blocks AS (SELECT doc_id, size, list_distinct(w[s + 1:s + 2 * size]) AS b FROM starts),
found AS (SELECT doc_id, list(DISTINCT label) AS more, max(common / n) AS best
          FROM (SELECT doc_id, label, n, alpha, len(list_intersect(b, tokens)) AS common FROM blocks JOIN templates USING (size))
          WHERE common >= alpha GROUP BY doc_id)
SELECT base.doc_id, n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) - 1 AS BIGINT) AS first_word,
       CAST(list_max(places) - 1 AS BIGINT) AS last_word, COALESCE(array_to_string(list_sort(own), ','), '') AS base_labels,
       COALESCE(array_to_string(list_sort(list_distinct(own || COALESCE(more, []))), ','), '') AS labels,
       COALESCE(best, 0.0) AS score
FROM base LEFT JOIN found ON base.doc_id = found.doc_id"""


WARC_SQL = """
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN strlen(body) >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM (SELECT page_id, body, digest, min(page_id) OVER (PARTITION BY digest) AS first_id
      FROM (SELECT page_id, COALESCE(html, '') AS body, sha256(COALESCE(html, '')) AS digest FROM pages))"""


JACCARD_SQL = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM worded),
sized AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM items x JOIN items y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, seen) AS (SELECT a, a FROM either UNION SELECT r.node, e.b FROM reach r JOIN either e ON e.a = r.seen)
SELECT z.doc_id, CAST(z.n AS BIGINT) AS n_shingles, COALESCE(min(r.seen), z.doc_id) AS component_id
FROM sized z LEFT JOIN reach r ON r.node = z.doc_id GROUP BY z.doc_id, z.n"""


NEGATIVES_SQL = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                  CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
           FROM used a JOIN used b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
             QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 3"""


# SQL has no crc32: bytes of the decimal id are folded in, eight shifts each (3988292384 is the polynomial, a fixed value)
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR i IN range(8)]),
    lambda v, z: xor(v >> 1, CAST(3988292384 AS BIGINT) * (v & 1)))), CAST(4294967295 AS BIGINT))"""

TRIE_SQL = f"""
WITH placed AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''),
           sha256(concat(length(COALESCE(role, '')), ':', COALESCE(role, ''), ':', COALESCE(text, '')))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM placed)),
turns AS (
  SELECT c.conv_id, 0 AS kind, p.place, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.h
  UNION ALL SELECT c.conv_id, 1, p.place, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h),
seqs AS (SELECT convs.conv_id, COALESCE(s, []) AS s FROM convs LEFT JOIN
           (SELECT conv_id, list(sha256(concat(length(role), ':', role, ':', text)) ORDER BY kind, place) AS s FROM turns GROUP BY conv_id) t
           ON t.conv_id = convs.conv_id),
sizes AS (SELECT conv_id, list(length(text) ORDER BY kind, place) AS sizes FROM turns GROUP BY conv_id),
prefixes AS (SELECT seqs.conv_id, d, s[1:d] AS k, len(s) = d AS is_last, COALESCE(sizes[d], 0) AS chars
             FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM seqs) seqs LEFT JOIN sizes ON sizes.conv_id = seqs.conv_id),
nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
                 sha256(COALESCE(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE is_last), '')) AS ends
          FROM prefixes GROUP BY k, d),
linked AS (SELECT nodes.*, parent.conv_id AS parent_conv_id FROM nodes LEFT JOIN nodes parent ON nodes.d = parent.d + 1 AND nodes.k[1:nodes.d - 1] = parent.k),
kids AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_ AS (SELECT linked.*, COALESCE(n_children, 0) AS n_children FROM linked LEFT JOIN kids ON kids.k = linked.k AND kids.d = linked.d),
gathered AS (SELECT below.up AS k, below.e AS d, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum((n - 1) * chars) AS saved
             FROM (SELECT k[1:e] AS up, e, n, n_children, chars FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM full_)) below GROUP BY 1, 2)
SELECT conv_id, CAST(full_.d AS BIGINT) AS depth, parent_conv_id, CAST(n AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends AS ends_sha256
FROM full_ JOIN gathered ON gathered.k = full_.k AND gathered.d = full_.d"""
