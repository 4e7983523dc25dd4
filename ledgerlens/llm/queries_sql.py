"""DuckDB SQL for the registered queries that SQL can express."""

QUALITY = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
p AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT r, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS n FROM g WHERE w3 IS NOT NULL),
hit AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) AS s(k) WHERE n > 1 GROUP BY r),
per AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
          count(*) FILTER (NOT regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS n_letterless,
          count(*) FILTER (strlen(word) > 40) AS n_long_words, max(strlen(word)) AS longest_word FROM p GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_letterless, 0) AS n_letterless, coalesce(n_long_words, 0) AS n_long_words, coalesce(longest_word, 0) AS longest_word
      FROM t LEFT JOIN per USING (r) LEFT JOIN lines USING (r) LEFT JOIN hit USING (r)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
        + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN 2 * word_chars < 5 * n_words THEN 16 ELSE 0 END
        + CASE WHEN word_chars > 14 * n_words THEN 32 ELSE 0 END
        + CASE WHEN 100 * n_letterless > 40 * n_words THEN 64 ELSE 0 END
        + CASE WHEN 100 * n_long_words > 10 * n_words THEN 128 ELSE 0 END)::BIGINT AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""

MIXING = r"""
WITH base AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM base GROUP BY source),
w AS (SELECT source, source_size, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS weight, [-0.5, 0.0, 0.5][rank % 3 + 1]::DOUBLE AS slope FROM s),
o AS (SELECT *, sum(2 * source_size) OVER a AS capped, sum(weight) OVER () - sum(weight) OVER a AS open,
        coalesce(lead(2 * source_size / weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST), 1e300) AS next_ratio
      FROM w WINDOW a AS (ORDER BY 2 * source_size / weight, source NULLS LAST)),
t AS (SELECT 1.5 * sum(source_size) AS budget, sum(weight) AS weights, min(2 * source_size / weight) AS least FROM w),
levels AS (SELECT budget / weights AS level FROM t WHERE budget / weights <= least
           UNION ALL SELECT (budget - capped) / open FROM o, t WHERE open > 0 AND budget / weights > least
             AND (budget - capped) / open >= 2 * source_size / weight AND (budget - capped) / open <= next_ratio),
targets AS (SELECT source, source_size, slope, least((2 * source_size)::DOUBLE, (SELECT min(level) FROM levels)::DOUBLE * weight) AS target FROM w),
d AS (SELECT b.doc_id, b.source, b.size, source_size, target, slope, round(target)::BIGINT AS wanted,
        CASE WHEN source_size > 0 THEN floor(round(target) / source_size)::BIGINT ELSE 0 END AS passes,
        (sum(size) OVER (PARTITION BY b.source ORDER BY key, b.doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
      FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, (passes * size + greatest(0, least(size, wanted - passes * source_size - start)))::BIGINT AS taken,
        start::DOUBLE / wanted AS u, (start + source_size)::DOUBLE / wanted AS u2 FROM d)
SELECT doc_id, source, size, source_size, target, taken,
  CASE WHEN taken > 0 THEN CASE WHEN slope = 0 THEN u
    ELSE (sqrt((1.0::DOUBLE - slope) * (1.0::DOUBLE - slope) + 4.0::DOUBLE * slope * u) - (1.0::DOUBLE - slope)) / (2.0::DOUBLE * slope) END END AS position,
  CASE WHEN taken > size THEN CASE WHEN slope = 0 THEN u2
    ELSE (sqrt((1.0::DOUBLE - slope) * (1.0::DOUBLE - slope) + 4.0::DOUBLE * slope * u2) - (1.0::DOUBLE - slope)) / (2.0::DOUBLE * slope) END END AS again
FROM k
"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES = {"op2_quality_rules": QUALITY, "op4_mixing": MIXING, "op8_top_k": TOP_K}
