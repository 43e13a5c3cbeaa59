"""DuckDB SQL of the queries that SQL can express."""

from .credentials import RULES

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS place,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM d GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY size / weight, source) AS k, sum(size) OVER () AS total, sum(weight) OVER () AS weights,
         sum(size) OVER w - size AS capped, sum(weight) OVER w - weight AS gone
  FROM s WINDOW w AS (ORDER BY size / weight, source ROWS UNBOUNDED PRECEDING)
), cut AS (
  SELECT min(k) AS k FROM ranked WHERE weight * (3 * total - 4 * capped) <= 4 * size * (weights - gone)
), goal AS (
  SELECT source, size AS source_size,
         CASE WHEN k < (SELECT k FROM cut) THEN 2.0 * size
              ELSE (weight * (SELECT 3 * total - 4 * capped FROM ranked WHERE k = (SELECT k FROM cut)))::DOUBLE
                   / (2 * (SELECT weights - gone FROM ranked WHERE k = (SELECT k FROM cut)))::DOUBLE END::DOUBLE AS target
  FROM ranked
), wanted AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM goal
), placed AS (
  SELECT d.doc_id, d.size, w.source_size, w.target, w.copies, w.target - w.copies * w.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place RANGE UNBOUNDED PRECEDING) AS through,
         sum(d.size) OVER (PARTITION BY d.source, d.place) AS here
  FROM d JOIN wanted w ON d.source IS NOT DISTINCT FROM w.source
)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN rest > 0 AND 2 * (through - here) + here <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

#: CRC-32 of distinct words: a list of the 256 table entries, made by eight rounds each, folded over the bytes.
OP11 = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS entries FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)
  )
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), dw AS (
  SELECT r, unnest(words) AS word FROM d
), tw AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), spelled AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM tw)
), placed AS (
  SELECT word, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda p: ('0x' || substr(h, p, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM spelled, crc
), s AS (
  SELECT bucket, count(*) AS n FROM dw JOIN placed USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM tw JOIN placed USING (word) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
         / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)
), w AS (
  SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN placed USING (word) JOIN gain USING (bucket) GROUP BY r
), scored AS (
  SELECT d.r, doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM d LEFT JOIN w USING (r)
), ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC) AS rank, 10 * count(*) OVER () // 100 AS draws
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= draws THEN rank END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (r)
"""


def _secrets() -> str:
    """A match starts behind the pieces of text between matches and the matches before it."""
    pattern = "'{}'".format
    found = " UNION ALL ".join(
        f"""SELECT r, {k} AS k, '{rule.kind}' AS kind, {rule.least} AS least, {str(rule.base).lower()} AS base,
                   unnest(string_split_regex(text, {(p := pattern(rule.pattern.replace("'", "''")))})) AS gap,
                   unnest(regexp_extract_all(text, {p})) AS m, unnest(regexp_extract_all(text, {p}, {rule.group})) AS part,
                   generate_subscripts(string_split_regex(text, {p}), 1) AS i
            FROM d WHERE regexp_matches(text, {p})"""
        for k, rule in enumerate(RULES)
    )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents
), found AS ({found}), placed AS (
  SELECT *, (sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY r, k ORDER BY i) - coalesce(length(m), 0))::BIGINT AS s FROM found
), spans AS (
  SELECT r, k, kind, base, s, concat_ws(':', kind, s, s + length(m)) AS span FROM placed WHERE m IS NOT NULL AND length(part) >= least
), each AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY s, k) FILTER (base) AS base, string_agg(span, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN each USING (r)
"""


OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), sizes AS (
  SELECT count(*) AS documents, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0
), p AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT documents FROM sizes) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p GROUP BY term
), lengths AS (
  SELECT r, doc_id, 100 - 50 + (50 * len(terms) * documents) // total AS m FROM d, sizes WHERE len(terms) > 0
), scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN weights USING (term) JOIN lengths USING (r) GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

ORACLES = {"op1_mixing": OP1, "op11_resampling": OP11, "op12_search": OP12, "op13_secrets": _secrets()}
